"""Words of many texts at once, as byte spans and 64-bit hashes in numpy arrays.

A word is a run of bytes that are not separators.  Separators are ASCII bytes, so
a word never cuts a character in two.  Hashes serve to find candidates and to
compare sets; every step here is vectorised over all texts of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLANK_BYTES = bytes([0x20, *range(0x09, 0x0E)])
# Blanks and all ASCII characters that are neither letters nor digits.
PUNCTUATION_BYTES = bytes(b for b in range(128) if not chr(b).isalnum())

# Texts are worked on in slices of about so many bytes; a longer text makes a slice alone.
SLICE_BYTES = 4 << 20
_BLOCK_BYTES = 1 << 20

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_ONE = np.uint64(1)


@dataclass
class Words:
    """``starts``/``ends`` are byte spans in ``data``; text ``i`` has words ``first[i]:first[i+1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def bytes_of(self, begin: int, end: int) -> bytes:
        """Words ``begin`` to ``end`` joined by one space."""
        spans = zip(self.starts[begin:end].tolist(), self.ends[begin:end].tolist(), strict=True)
        return b" ".join([self.data[a:b].tobytes() for a, b in spans])


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers 0, 1, …, modulo 2**64."""
    size = max(1 << 16, 1 << max(0, count - 1).bit_length())
    return _powers(base, size)[:count]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _range_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]``, whatever their place."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(_inverse(base), len(values) + 1)[starts]


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of word sequences ``starts:ends``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix(_range_sums(hashes, _WORD_BASE, starts, ends))


def ngram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every ``size`` consecutive words, texts disregarded."""
    count = max(0, len(hashes) - size + 1)
    begin = np.arange(count)
    return range_hashes(hashes, begin, begin + size)


def split_words(
    data: np.ndarray, offsets: np.ndarray, separators: bytes = BLANK_BYTES, lower: bool = False
) -> Words:
    """Words of texts that lie one after another in ``data``; ``lower`` hashes A-Z as a-z."""
    is_blank = np.zeros(256, bool)
    is_blank[list(separators)] = True
    fold = np.arange(256, dtype=np.uint64)
    if lower:
        fold[65:91] += np.uint64(32)
    fold += _ONE
    blank = is_blank[data]
    edge = np.empty(len(data), bool)
    if len(data):
        edge[0] = True
        edge[1:] = blank[:-1]
        edge[offsets[offsets < len(data)]] = True
    starts = np.flatnonzero(~blank & edge)
    if len(data):
        edge[-1] = True
        edge[:-1] = blank[1:]
        edge[offsets[offsets > 0] - 1] = True
    ends = np.flatnonzero(~blank & edge) + 1
    hashes = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        end = int(np.searchsorted(ends, starts[begin] + _BLOCK_BYTES))
        end = max(end, begin + 1)
        base = starts[begin]
        block = fold[data[base : ends[end - 1]]]
        hashes[begin:end] = _range_sums(
            block, _BYTE_BASE, starts[begin:end] - base, ends[begin:end] - base
        )
        begin = end
    return Words(data, starts, ends, mix(hashes), np.searchsorted(starts, offsets))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its texts; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = texts.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``most_bytes`` at most, or one row."""
    for batch in batches:
        lengths = np.diff(text_bytes(batch.column(column))[1])
        reach = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            done = reach[begin - 1] if begin else 0
            end = max(int(np.searchsorted(reach, done + most_bytes, side="right")), begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def batch_words(batch: pa.RecordBatch, column: str, **how: object) -> Words:
    return split_words(*text_bytes(batch.column(column)), **how)
