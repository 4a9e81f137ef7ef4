"""Byte-pair encoding and decoding with a public vocabulary, inside Spark tasks.

Method: a pair occurrence index.  The distinct words of a slice of a partition are laid
out as one linked list of token ids, in arrays.  An index maps every pair that has a merge rule
to all positions where it occurs; active ranks are taken in ascending order, a rank's pair is
merged at all its positions at once, and the pairs around the merged positions are put
into the index (pairs that went are passed over).  Texts are then put together from their words' ids, so a
word costs one pass of the merges, however often a slice holds it.  A slice's memory is
let go with it; nothing but the vocabulary outlives it in a worker.

A null text has no tokens, as an empty one.  Texts of any length are encoded
whole.  The strings of added tokens (such as ``<|endoftext|>``) are found in texts
first and give their own ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset.llm.tables import releasing, widened
from gleanset.llm.words import slices

# Fixed value: how byte-level vocabularies of this family cut texts into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for texts of Latin-1 characters only, whose letters and digits are few: a faster test.
_LATIN = {
    r"\s": r"\t-\r \x85\xa0",
    r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ",
    r"\p{N}": "0-9²³¹¼-¾",
}
LATIN_PATTERN = (
    "'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?[{_LATIN[r'\p{L}']}]+| ?[{_LATIN[r'\p{N}']}]+| ?[^{''.join(_LATIN.values())}]+"
    rf"|[{_LATIN[r'\s']}]+(?![^{_LATIN[r'\s']}])|[{_LATIN[r'\s']}]+"
)

# Bytes of text in a slice, whose distinct words share one index; a longer text makes a slice alone.
INDEXED_BYTES = 2 << 20

# A rank at fewer positions is merged one position at a time, which is faster there.
FEW_POSITIONS = 24


def newer_letters() -> str:
    """Ranges of letters and digits of ``regex`` that the tokenizers library does not know yet.

    The two follow different Unicode versions, so characters that were given out
    of late are put to the library one by one.
    """
    from tokenizers import pre_tokenizers  # the driver's alone; workers need not load it

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)

    def apart(first: str, char: str) -> bool:
        return len(library.pre_tokenize_str(first + char)) > 1

    codes = sorted(
        ord(char)
        for kind, first in ((r"\p{L}", "a"), (r"\p{N}", "1"))
        for char in regex.findall(kind, every)
        if unicodedata.category(char) == "Cn" and apart(first, char)
    )
    starts = [c for c, prior in zip(codes, [-2, *codes]) if c != prior + 1]
    ends = [c for c, later in zip(codes, [*codes[1:], -2]) if c != later - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown}
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return letters


class _Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class BytePairVocabulary:
    """Merges by rank, the bytes of each id, and the added tokens of a vocabulary file."""

    def __init__(self, text: str, unknown_letters: str = "") -> None:
        file = json.loads(text)
        model = file["model"]
        step = file["pre_tokenizer"]
        plain = (
            model["type"] == "BPE" and step["type"] == "ByteLevel" and step["use_regex"]
            and not step["add_prefix_space"] and file["normalizer"] is None
            and not model.get("ignore_merges")
        )
        if not plain:
            raise ValueError("only byte-level BPE files without normaliser or prefix space are read")
        letters = byte_letters()
        to_byte = {letter: b for b, letter in letters.items()}
        ids: dict[str, int] = model["vocab"]
        self.pieces = {i: bytes(map(to_byte.__getitem__, s)) for s, i in ids.items()}
        self.byte_ids = [ids[letters[b]] for b in range(256)]
        self.wide = max(self.pieces) + 3  # pairs are numbers: left * wide + right
        self.rules: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        keys = []
        for rank, (left, right) in enumerate(model["merges"]):
            pair = ids[left], ids[right]
            if max(made.get(pair[0], -1), made.get(pair[1], -1)) >= rank:
                raise ValueError("a merge uses a token that only a later rank makes")
            merged = ids[left + right]
            if merged in made:
                raise ValueError("two merges make one token")
            made[merged] = rank
            keys.append(pair[0] * self.wide + pair[1])
            self.rules.append((*pair, merged))
        self.rank_of = {key: rank for rank, key in enumerate(keys)}
        keyed = np.array(keys, np.int64)
        self.key_ranks = np.argsort(keyed).astype(np.int32)
        self.keys = keyed[self.key_ranks]
        self.byte_tokens = np.array(self.byte_ids, np.int32)
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        for content, i in self.added.items():
            self.pieces[i] = content.encode()
        pattern = WORD_PATTERN
        if unknown_letters:
            newer = f"[{unknown_letters}]"
            both = rf"[^\s\p{{L}}\p{{N}}]"
            pattern = pattern.replace(both, rf"(?:{both}|{newer})")
            for kind in (r"\p{L}+", r"\p{N}+"):
                pattern = pattern.replace(f" ?{kind}", f" ?(?:(?!{newer}){kind[:-1]})+")
        self.word = regex.compile(WORD_PATTERN)
        self.newer = regex.compile(f"[{unknown_letters}]") if unknown_letters else None
        self.latin_word = re.compile(LATIN_PATTERN)
        self.careful_word = regex.compile(pattern)
        names = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None

    def words(self, text: str) -> list[str]:
        """The words of a text in order; an added token's string is a word of its own."""
        word = self.word
        if len(text.encode("latin-1", "ignore")) == len(text):
            word = self.latin_word
        elif self.newer is not None and self.newer.search(text):
            word = self.careful_word
        if self.cut is None or not any(name in text for name in self.added):
            return word.findall(text)
        found: list[str] = []
        at = 0
        for hit in self.cut.finditer(text):
            found += word.findall(text[at : hit.start()])
            found.append(hit.group())
            at = hit.end()
        return found + word.findall(text[at:])

    def _ranked(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pair keys have a rule, and its rank."""
        spot = np.searchsorted(self.keys, keys)
        spot[spot == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[spot] == keys)
        return hit, self.key_ranks[spot[hit]]

    def _laid_out(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Byte tokens of all words, a -1 before, between and after them, and each word's first position."""
        raw = "\0".join(["", *words, ""]).encode()
        data = np.frombuffer(raw, np.uint8)
        token = self.byte_tokens[data]
        if any("\0" in word for word in words):  # then blanks are no sure sign of a word's end
            sizes = np.fromiter((len(word.encode()) for word in words), np.int64, len(words))
            ends = np.concatenate([[0], np.cumsum(sizes + 1)])
        else:
            ends = np.flatnonzero(data == 0)
        token[ends] = -1
        return token, ends[:-1] + 1

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and where each word begins and the last one ends."""
        token, first = self._laid_out(words)
        wide = self.wide
        after = np.arange(1, len(token) + 1, dtype=np.int32)
        before = np.arange(-1, len(token) - 1, dtype=np.int32)
        after[-1], before[0] = len(token) - 1, 0
        # The same memory, whose single items Python reaches faster.
        tokens, afters, befores = memoryview(token), memoryview(after), memoryview(before)
        rank_of, rules = self.rank_of.get, self.rules
        places: dict[int, list] = {}
        active: list[int] = []

        def note(spots: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            spots, ranks = spots[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for a, b in zip(cuts, cuts[1:]):
                rank = int(ranks[a])
                held = places.get(rank)
                if held is None:
                    places[rank] = [spots[a:b]]
                    heapq.heappush(active, rank)
                else:
                    held.append(spots[a:b])

        def note_one(spot: int, rank: int) -> None:
            held = places.get(rank)
            if held is None:
                places[rank] = [spot]
                heapq.heappush(active, rank)
            else:
                held.append(spot)

        spots, ranks = self._ranked(token[:-1].astype(np.int64) * wide + token[1:])
        if len(spots):
            note(spots.astype(np.int32), ranks)
        del spots, ranks
        while active:
            rank = heapq.heappop(active)
            left, right, merged = rules[rank]
            held = places.pop(rank)
            if len(held) < FEW_POSITIONS:
                some = []
                for one in held:
                    if isinstance(one, int):
                        some.append(one)
                    elif len(one) < FEW_POSITIONS:
                        some.extend(one.tolist())
                    else:
                        some = None
                        break
                if some is not None and len(some) < FEW_POSITIONS:
                    some.sort()
                    for i in some:
                        j = afters[i]
                        if tokens[i] != left or tokens[j] != right:
                            continue  # the pair has gone from this position since it was noted
                        k, h = afters[j], befores[i]
                        tokens[i], tokens[j] = merged, -2
                        afters[i], befores[k] = k, i
                        fresh = rank_of(tokens[h] * wide + merged)
                        if fresh is not None:
                            note_one(h, fresh)
                        fresh = rank_of(merged * wide + tokens[k])
                        if fresh is not None:
                            note_one(i, fresh)
                    continue
            spots = np.concatenate([np.atleast_1d(np.asarray(one, np.int32)) for one in held])
            spots.sort()
            spots = spots[np.concatenate([[True], spots[1:] != spots[:-1]])]
            nexts = after[spots]
            live = (token[spots] == left) & (token[nexts] == right)
            spots, nexts = spots[live], nexts[live]
            if left == right and len(spots) > 1:
                # In a run of overlapping pairs every second one is merged, from the left.
                opens = np.concatenate([[True], spots[1:] != nexts[:-1]])
                number = np.arange(len(spots))
                keep = (number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 0
                spots, nexts = spots[keep], nexts[keep]
            if not len(spots):
                continue
            beyond = after[nexts]
            token[spots], token[nexts] = merged, -2
            after[spots], before[beyond] = beyond, spots
            round_about = np.concatenate([before[spots], spots])
            hit, ranks = self._ranked(token[round_about].astype(np.int64) * wide + token[after[round_about]])
            if len(hit):
                note(round_about[hit], ranks)
        for content, i in self.added.items():  # added tokens are words that are one token, whatever the merges
            if content in words:
                at = first[words.index(content)]
                token[at : at + len(content.encode())] = -2
                token[at] = i
        held = token >= 0
        reach = np.concatenate([[0], np.cumsum(held)])
        return token[held], np.append(reach[first], reach[-1])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins and the last one ends."""
        numbers = _Numbers()
        cut = []
        for text in texts:
            words = self.words(text) if text else []
            cut.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        ids, bounds = self.encode_words(list(numbers))
        del numbers
        word = np.concatenate([np.zeros(0, np.int32), *cut])
        sizes = np.diff(bounds)[word]
        reach = np.concatenate([[0], np.cumsum(sizes)])
        first = np.concatenate([[0], np.cumsum([len(one) for one in cut], dtype=np.int64)])
        spots = np.repeat(bounds[word] - reach[:-1], sizes)
        spots += np.arange(len(spots))
        return ids[spots], reach[first]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _vocabulary(source: tuple[str, str]) -> BytePairVocabulary:
    return BytePairVocabulary(*source)


def load_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The file's text for all executors.  A vocabulary file has a fixed size of a few MB."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast((file.read(), newer_letters()))


def bpe_encode(
    frame: DataFrame, vocabulary: Broadcast, column: str = "text", ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """The frame with ``ids`` (array of int) beside its columns; a column of that name is replaced.

    ``decoded`` names one more column: the text that the ids decode to, by the worker
    that made them, so that no second worker need hold the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _vocabulary(vocabulary.value)
        for batch in slices(batches, column, INDEXED_BYTES):
            flat, bounds = tool.encode(batch.column(column).to_pylist())
            made = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))]
            if decoded is not None:
                texts = (tool.decode(flat[a:b].tolist()) for a, b in zip(bounds, bounds[1:]))
                made.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    names = [ids] if decoded is None else [ids, decoded]
    frame = frame.drop(*names)
    kinds = f"{ids} array<int>" if decoded is None else f"{ids} array<int>, {decoded} string"
    return frame.mapInArrow(releasing(run), widened(frame, kinds))


def bpe_decode(vocabulary: Broadcast, ids: Column) -> Column:
    """Text of an array of ids, special tokens included; null ids give null."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        tool = _vocabulary(vocabulary.value)
        return pa.array((None if one is None else tool.decode(one) for one in column.to_pylist()), pa.string())

    return decoded(ids)


def text_digest(ids: Column) -> Column:
    """SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)
