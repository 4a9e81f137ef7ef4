"""Token counts under a unigram vocabulary: a Viterbi search that only counts.

Aho-Corasick lists the vocabulary pieces that end at each character of a word; the
search carries, per character, the best score, the number of pieces of that path, and
whether it ends in an unknown character.  Ties go as in the tokenizers library's
unigram model: of paths with equal scores the one whose last piece starts first
stays; an unknown character scores ten below the least piece.  Runs of unknown
characters count as one piece, or as their bytes when the vocabulary has byte pieces.

Texts are cut into words before blanks, each blank standing as ``▁`` at the front of
its word, and one is put before the text.  A word is searched once per worker (a
bounded number is remembered).  A null or empty text has no tokens.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from gleanset.llm.tables import widened
from gleanset.llm.words import slices

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED_WORDS = 400_000
_WORD = re.compile(f"{BLANK}[^{BLANK}]*|[^{BLANK}]+")
_BYTE_PIECE = re.compile(r"<0x[0-9A-F]{2}>")


class UnigramCounter:
    """Counts pieces of words; ``pieces`` are (piece, score) in id order."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.has_bytes = sum(bool(_BYTE_PIECE.fullmatch(p)) for p, _ in pieces) == 256
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        size = len(word)
        best = [-math.inf] * (size + 1)
        count = [0] * (size + 1)
        open_end = [False] * (size + 1)  # the best path ends in an unknown character
        best[0] = 0.0
        found: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        if len(self.automaton):
            for end, piece in self.automaton.iter(word):
                found[end].append(piece)
        for end in range(1, size + 1):
            single = False
            for length, score in sorted(found[end - 1], reverse=True):  # earliest start first
                start = end - length
                single |= length == 1
                if best[start] + score > best[end]:
                    best[end] = best[start] + score
                    count[end] = count[start] + 1
            if not single and best[end - 1] + self.unknown > best[end]:
                best[end] = best[end - 1] + self.unknown
                open_end[end] = True
                if self.has_bytes:
                    count[end] = count[end - 1] + len(word[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not open_end[end - 1])
        return count[size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", BLANK)
        if text[0] != BLANK:
            text = BLANK + text
        total = 0
        known = self.known
        for word in _WORD.findall(text):
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED_WORDS:
                    known.clear()
                n = known[word] = self.count_word(word)
            total += n
        return total


def load_pieces(spark: SparkSession, path: str) -> Broadcast:
    """Pieces and scores of a model file, some tens of thousands, for all executors."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in ids)
    return spark.sparkContext.broadcast(pieces)


@lru_cache(maxsize=2)
def _counter(pieces: tuple[tuple[str, float], ...]) -> UnigramCounter:
    return UnigramCounter(list(pieces))


def count_tokens(
    frame: DataFrame, pieces: Broadcast, column: str = "text", tokens: str = "n_tokens"
) -> DataFrame:
    """The frame with the token count of a text column; a column of that name is replaced."""
    frame = frame.drop(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces.value)
        for batch in slices(batches, column):
            counts = [counter.count(text) for text in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64())], [*batch.schema.names, tokens]
            )

    return frame.mapInArrow(run, widened(frame, f"{tokens} bigint"))
