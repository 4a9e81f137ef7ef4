"""Substring de-duplication by repeated-phrase automata.

A window is ``window`` consecutive words of one text; every word in a window whose sequence
also starts anywhere else is removed.  All windows are judged on the input.

1. Anchors.  The anchor of a window is its phrase of ``PHRASE`` words with the least hash, so
   equal windows have equal anchors.  A stretch is a run of windows that share one
   anchor occurrence; a text has about one per fourteen words.  Anchors that occur once
   are out: none of their windows repeats.
2. Stretches with a recurring anchor are told apart by a 128-bit digest, counted, and one
   copy of each is cut out of its text and sent to the shard of its anchor.
3. A shard compiles the windows that its counts say recur into an Aho-Corasick automaton
   over words, and streams its stretches, one copy of each, through it.  Windows that the
   automaton finds twice or more, word by word, count; a copy counts as often as its
   stretch occurs.
4. What is covered goes back, by a join on the digest, to every occurrence of a stretch
   and is merged per text.  The automata do not see the other occurrences.

Shards hold a bounded number of stretches.  An anchor with more of its own (one passage in
very many different surroundings) is dealt over several shards; its windows are then counted
beforehand by their 64-bit hashes, by part in every task, and each shard gets those that recur.
These count by that hash alone, not word by word.

Texts are known by a 128-bit digest, so rows without an id, with the same id, or with equal texts need no
care.  Cases: a null text has no words and stays null; texts of fewer words than a window
keep all words, unchanged in order, joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.tables import BROADCAST_ROWS, small_enough, stored, widened
from gleanset.llm.words import (
    Words, batch_words, mix, ngram_hashes, range_hashes, slices, split_words, text_bytes,
)

WINDOW = 35
PHRASE = 8
# Stretches of one shard, about, and of one anchor in one shard.
SHARD_STRETCHES = 20_000
HOT_STRETCHES = 10_000

KEY = ["k1", "k2"]
_SECOND = 0xA24BAED4963EE407


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    reach, least = 1, values
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def stretches(words: Words, window: int, phrase: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, two digests, first and last window (as word places in the text) of each stretch."""
    size = len(words.hashes)
    empty = np.zeros(0, np.int64)
    if size < window:
        return empty, empty, empty, empty, empty, empty
    grams = ngram_hashes(words.hashes, phrase)
    # The least hash wins, of equal ones the first; the low half tells the place.
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_least(ranked, window - phrase + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = np.arange(size - window + 1)
    text_of = words.text_of()
    inside = text_of[begin] == text_of[begin + window - 1]
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text_of[begin[1:]] != text_of[begin[:-1]])
    begin, anchor, fresh = begin[inside], anchor[inside], fresh[inside]
    if not len(begin):
        return empty, empty, empty, empty, empty, empty
    fresh[0] = True
    fresh[1:] |= begin[1:] != begin[:-1] + 1
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(begin)) - 1
    low, high, place = begin[first], begin[last], anchor[first]
    owner = text_of[low]
    one = range_hashes(words.hashes, low, high + window)
    two = range_hashes(mix(words.hashes ^ np.uint64(_SECOND)), low, high + window)
    offset = words.first[owner]
    return (owner, grams[place].view(np.int64), one.view(np.int64), two.view(np.int64),
            low - offset, high - offset)


def _occurrences(texts: DataFrame, window: int, phrase: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, *columns, low, high = stretches(batch_words(batch, "text"), window, phrase)
            keys = [batch.column(k).take(pa.array(owner)) for k in KEY]
            yield pa.RecordBatch.from_arrays(
                [*keys, *map(pa.array, columns), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                [*KEY, "anchor", "s1", "s2", "low", "high"],
            )

    schema = "k1 bigint, k2 bigint, anchor bigint, s1 bigint, s2 bigint, low int, high int"
    return texts.mapInArrow(run, schema)


def _cut_out(texts: DataFrame, window: int) -> DataFrame:
    """The words of chosen stretches; ``wanted`` lists them beside each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = batch_words(batch, "text")
            rows: list[tuple] = []
            for first, wanted in zip(words.first[:-1].tolist(), batch.column("wanted").to_pylist()):
                rows += [
                    (w["anchor"], w["s1"], w["s2"], w["n"], w["shard"], w["part"],
                     words.bytes_of(first + w["low"], first + w["high"] + window).decode())
                    for w in wanted
                ]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["anchor", "s1", "s2", "n", "shard", "part", "words"],
            )

    schema = "anchor bigint, s1 bigint, s2 bigint, n bigint, shard int, part int, words string"
    return texts.select("text", "wanted").mapInArrow(run, schema)


def _windows(texts: pa.Array, window: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of stretches, and word place and hash of every window."""
    words = split_words(*text_bytes(texts))
    counts = words.counts() - window + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + words.first[:-1][owner]
    return words, begin, range_hashes(words.hashes, begin, begin + window)


def _window_counts(cut: DataFrame, window: int) -> DataFrame:
    """Windows of hot anchors that recur, counted by part in every task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            words, begin, hashes = _windows(batch.column("words"), window)
            owner = np.searchsorted(words.first, begin, side="right") - 1
            frame = pd.DataFrame({
                "anchor": batch.column("anchor").to_numpy()[owner],
                "w": hashes.view(np.int64),
                "n": batch.column("n").to_numpy()[owner],
            })
            yield pa.RecordBatch.from_pandas(
                frame.groupby(["anchor", "w"], as_index=False)["n"].sum(), preserve_index=False
            )

    return (
        cut.mapInArrow(run, "anchor bigint, w bigint, n bigint")
        .groupBy("anchor", "w").agg(F.sum("n").alias("n")).where("n > 1")
    )


def locate(
    texts: list[str], counts: np.ndarray, known: np.ndarray, window: int
) -> list[list[tuple[int, int]]]:
    """Word spans of each stretch that repeated windows cover.

    ``counts`` say how often each stretch occurs in all; ``known`` are hashes of windows
    that recur elsewhere too, whatever this shard holds.
    """
    words, begin, hashes = _windows(pa.array(texts, pa.large_string()), window)
    owner = np.searchsorted(words.first, begin, side="right") - 1
    kinds, which = np.unique(hashes, return_inverse=True)
    times = np.bincount(which, weights=counts[owner], minlength=len(kinds))
    recurs = ((times > 1) | np.isin(kinds, known))[which]
    # Exact numbers for words: the automaton compares words, not hashes.
    numbers: dict[bytes, int] = {}
    raw = words.data.tobytes()
    ids = [
        numbers.setdefault(raw[a:b], len(numbers))
        for a, b in zip(words.starts.tolist(), words.ends.tolist())
    ]
    edge = np.ones(len(begin), bool)
    edge[1:] = ~recurs[:-1] | (owner[1:] != owner[:-1])
    back = np.ones(len(begin), bool)
    back[:-1] = ~recurs[1:] | (owner[1:] != owner[:-1])
    # First and last window of a run cover all of it, since a stretch is shorter than two windows.
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    sure: list[bool] = []
    for i in np.flatnonzero(recurs & (edge | back)):
        pattern = tuple(ids[begin[i] : begin[i] + window])
        if not automaton.exists(pattern):
            automaton.add_word(pattern, len(sure))
            sure.append(bool(len(known)) and bool(np.isin(hashes[i], known)))
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not sure:
        return found
    automaton.make_automaton()
    hits: list[tuple[int, int, int]] = []
    seen = [0] * len(sure)
    for i, (a, b) in enumerate(zip(words.first.tolist(), words.first[1:].tolist())):
        for end, pattern in automaton.iter(tuple(ids[a:b])):
            hits.append((i, end - window + 1, pattern))
            seen[pattern] += int(counts[i])
    for i, start, pattern in hits:
        if seen[pattern] > 1 or sure[pattern]:
            spans = found[i]
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], start + window)
            else:
                spans.append((start, start + window))
    return found


def repeated_spans(
    texts: DataFrame, text: str = "text", *, window: int = WINDOW, phrase: int = PHRASE,
    shard_stretches: int = SHARD_STRETCHES, hot_stretches: int = HOT_STRETCHES,
) -> DataFrame:
    """Per text digest ``(k1, k2)`` the covered word spans ``(first, end)``, sorted and apart.

    Texts without a repeated window have no row.
    """
    named = texts.where(F.col(text).isNotNull()).select(*text_key(F.col(text)), F.col(text).alias("text"))
    occurrences = stored(_occurrences(named, window, phrase), "stretches")
    recurring = (
        occurrences.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    )
    # Stored first: Spark splits a join's large key only where both sides come from a shuffle.
    recurring = stored(recurring, "recurring-anchors")
    repeated = stored(occurrences.join(recurring, "anchor"), "recurring-stretches")
    distinct = stored(
        repeated.groupBy("anchor", "s1", "s2").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "low", "high")).alias("at")
        ), "distinct-stretches",
    )
    shards = max(1, distinct.count() // shard_stretches)
    hot = (
        distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot_stretches)
        .select("anchor", F.ceil(F.col("m") / hot_stretches).cast("int").alias("parts"))
    )
    hot = stored(hot, "hot-anchors")
    # There is at most one hot anchor to ``hot_stretches`` stretches.
    placed = distinct.join(small_enough(hot), "anchor", "left").select(
        "anchor", "s1", "s2", "n", "at.*",
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"),
        F.when(F.col("parts").isNull(), -1)
        .otherwise(F.pmod(F.xxhash64("s1"), F.col("parts"))).cast("int").alias("part"),
    )
    wanted = placed.groupBy(*KEY).agg(
        F.collect_list(F.struct("anchor", "s1", "s2", "n", "shard", "part", "low", "high")).alias("wanted")
    )
    wanted = stored(wanted, "wanted-stretches")
    some = named.join(small_enough(wanted.select(*KEY)), KEY, "left_semi").dropDuplicates(KEY)
    cut = stored(_cut_out(some.join(wanted, KEY), window), "cut-stretches")
    is_hot = F.col("part") >= 0
    windows = _window_counts(cut.where(is_hot), window).join(small_enough(hot), "anchor")
    beforehand = windows.select(
        "anchor", F.col("w").alias("s1"), F.lit(0).cast("bigint").alias("s2"), F.col("n"),
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("string").alias("words"),
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        told = group["words"].isna()
        known = group.loc[told, "s1"].to_numpy().view(np.uint64)
        own = group[~told]
        found = locate(own["words"].tolist(), own["n"].to_numpy(), known, window)
        which = np.repeat(np.arange(len(own)), [len(x) for x in found])
        spans = np.array([s for x in found for s in x], np.int64).reshape(-1, 2)
        out = own[["anchor", "s1", "s2"]].iloc[which]
        return out.assign(first=spans[:, 0], end=spans[:, 1])

    # A hot anchor's parts are groups of their own; all other anchors of a shard share one.
    own_group = F.when(is_hot, F.col("anchor")).otherwise(F.lit(0)).alias("own")
    covered = cut.unionByName(beforehand).groupBy("shard", own_group, "part").applyInPandas(
        search, "anchor bigint, s1 bigint, s2 bigint, first bigint, end bigint"
    )
    covered = stored(covered, "covered-stretches")
    spans = repeated.join(covered, ["anchor", "s1", "s2"]).select(
        *KEY, F.struct((F.col("low") + F.col("first")).alias("first"), (F.col("low") + F.col("end")).alias("end")).alias("span")
    )
    gathered = spans.groupBy(*KEY).agg(F.sort_array(F.collect_set("span")).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for found in batch.column("spans").to_pylist():
                apart = [found[0]]
                for span in found[1:]:
                    if span["first"] <= apart[-1]["end"]:
                        apart[-1]["end"] = max(apart[-1]["end"], span["end"])
                    else:
                        apart.append(span)
                merged.append(apart)
            made = pa.array(merged, batch.schema.field("spans").type)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KEY), made], [*KEY, "spans"])

    return gathered.mapInArrow(merge, gathered.schema)


def keep_words(words: Words, spans: list[list[dict] | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each text, one space between them, and removed counts."""
    marks = np.zeros(len(words.hashes) + 1, np.int64)
    for first, own in zip(words.first.tolist(), spans):
        for s in own or ():
            marks[first + s["first"]] += 1
            marks[first + s["end"]] -= 1
    kept = np.cumsum(marks)[:-1] == 0
    places = np.flatnonzero(kept)
    owner = words.text_of()[places]
    more = np.zeros(len(places), bool)
    more[:-1] = owner[1:] == owner[:-1]  # another kept word follows in the text
    taken = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(taken, words.starts[places], 1)
    np.subtract.at(taken, words.ends[places] + more, 1)
    mask = np.cumsum(taken[:-1], dtype=np.int8).astype(bool)
    data = words.data.copy()
    data[words.ends[places[more]]] = 0x20
    lengths = np.bincount(
        owner, weights=words.ends[places] - words.starts[places] + more, minlength=len(words.first) - 1
    ).astype(np.int64)
    removed = words.counts() - np.bincount(owner, minlength=len(words.first) - 1)
    return data[mask], np.concatenate([[0], np.cumsum(lengths)]), removed


def remove_repeats(
    texts: DataFrame, text: str = "text", *, window: int = WINDOW, **how: int
) -> DataFrame:
    """The rows with kept words only in ``text``, and ``n_words`` and ``n_removed`` beside it.

    Columns of these two names are replaced.
    """
    columns = [c for c in texts.columns if c not in ("n_words", "n_removed")]
    spans = stored(repeated_spans(texts, text, window=window, **how), "repeated-spans")
    keyed = texts.select(*columns, *[k.alias(f"_{n}") for n, k in zip(KEY, text_key(F.col(text)))])
    found = spans.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("spans").alias("_spans"))
    many = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    found = F.broadcast(found) if many <= BROADCAST_ROWS else found
    joined = keyed.join(found, [f"_{k}" for k in KEY], "left").select(*columns, "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = batch_words(batch, text)
            data, offsets, removed = keep_words(words, batch.column("_spans").to_pylist())
            made = pa.LargeStringArray.from_buffers(
                batch.num_rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)
            ).cast(pa.string())
            old = batch.column(text)
            made = pa.compute.if_else(old.is_null(), pa.scalar(None, pa.string()), made)
            kept = [made if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64())],
                [*columns, "n_words", "n_removed"],
            )

    schema = widened(texts.select(*columns), "n_words bigint, n_removed bigint")
    return joined.mapInArrow(run, schema)
