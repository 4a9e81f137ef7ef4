"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of lower-cased characters per language in Spark (partial
counts per task, then sums); the matrix of log-probabilities, languages times
``buckets``, has a fixed size and is broadcast.  Scoring takes the n-grams of a batch of texts as one
sparse matrix and multiplies it by that one in numpy.

Cases: a null text, or one without any letter, is ``und`` with score 0.  Rows
without a text or a language take no part in training; a table without any gives a
model under which every text is ``und``.  Texts are read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.tables import releasing, widened
from gleanset.llm.words import mix, slices

UNDETERMINED = "und"
SIZES = (1, 2, 3)
BUCKETS = 1 << 15
# Languages that are told apart at most; more raise an error, so that the matrix stays small.
MOST_LANGUAGES = 500
# Documented bound of the training sample: documents per language, about.
SAMPLE_PER_LANGUAGE = 20_000
# Below this score no language leads the others; a text of some words is far above it.
MIN_SCORE = 0.4
_PIECE_CHARS = 1 << 20
# Numbers gathered at a time, and bytes of texts scored together.
_ENTRIES = 1 << 21
_SCORE_BYTES = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    """``log_p[bucket, language]`` and the log prior of each language."""

    languages: list[str]
    log_p: np.ndarray
    prior: np.ndarray
    sizes: tuple[int, ...]


def gram_buckets(codes: np.ndarray, size: int, buckets: int) -> np.ndarray:
    """The bucket of every ``size`` consecutive characters."""
    count = max(0, len(codes) - size + 1)
    key = np.full(count, size, np.uint64)
    for i in range(size):
        key = key * np.uint64(0x1F123BB5) + codes[i : i + count]
    return (mix(key) % np.uint64(buckets)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _text_counts(text: str, sizes: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, piece by piece; a piece reaches as far as its last n-gram."""
    text = f" {text} ".lower()
    for at in range(0, len(text), _PIECE_CHARS):
        for size in sizes:
            yield gram_buckets(_codes(text[at : at + _PIECE_CHARS + size - 1]), size, buckets)


def train(
    labelled: DataFrame,
    text: str = "text",
    language: str = "lang",
    *,
    key: Column | None = None,
    sizes: tuple[int, ...] = SIZES,
    buckets: int = BUCKETS,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Fit on about ``sample_per_language`` rows of each language, all rows if there are fewer.

    The sample takes rows by a hash of ``key`` (the text by default), so it is the
    same at every run.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(language).alias("lang"),
        F.pmod(F.xxhash64(F.col(text) if key is None else key), F.lit(1 << 30)).alias("draw"),
    )
    totals = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(totals)
    counts = np.zeros((buckets, len(languages)))
    if languages:
        share = F.create_map(*[
            F.lit(v) for k, n in totals.items()
            for v in (k, int((1 << 30) * min(1.0, sample_per_language / n)))
        ])
        drawn = rows.where(F.col("draw") < share[F.col("lang")]).select("text", "lang")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros((len(languages), buckets), np.int64)
            place = {name: i for i, name in enumerate(languages)}
            for batch in slices(batches, "text"):
                pairs = zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True)
                for one, name in pairs:
                    for found in _text_counts(one, sizes, buckets):
                        seen[place[name]] += np.bincount(found, minlength=buckets)
            which, bucket = np.nonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int32()), pa.array(bucket, pa.int32()), pa.array(seen[which, bucket])],
                ["which", "bucket", "n"],
            )

        summed = (
            drawn.mapInArrow(releasing(count), "which int, bucket int, n bigint")
            .groupBy("which", "bucket").agg(F.sum("n").alias("n"))
        )
        table = summed.toPandas()  # languages times buckets rows at most
        counts[table["bucket"], table["which"]] = table["n"]
    smooth = counts + 0.1
    log_p = np.log(smooth / smooth.sum(0, keepdims=True))
    amounts = np.array([totals[k] for k in languages], float)
    prior = np.log(amounts / amounts.sum()) if languages else amounts
    return LanguageModel(languages, log_p, prior, sizes)


def _batch_sums(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-probabilities per text and language, and n-grams per text.

    The n-grams of all texts are the entries of one sparse matrix, texts by buckets, in row order; its
    product with the model's matrix is a gather and a sum per row, a bounded number of entries at a time.
    """
    lowered = [f" {t} ".lower() for t in texts]
    codes = _codes("".join(lowered))
    ends = np.cumsum([len(t) for t in lowered])
    sums, grams = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    step = max(1024, _ENTRIES // len(model.languages))
    for at in range(0, len(codes), step):
        for size in model.sizes:
            found = gram_buckets(codes[at : at + step + size - 1], size, len(model.log_p))
            row = np.searchsorted(ends, np.arange(at, at + len(found)), side="right")
            inside = np.arange(at, at + len(found)) + size <= ends[row]
            found, row = found[inside], row[inside]
            if not len(row):
                continue
            first = np.flatnonzero(np.diff(row, prepend=-1))
            sums[row[first]] += np.add.reduceat(model.log_p[found], first, axis=0)
            grams[row[first]] += np.diff(first, append=len(row))
    return sums, grams


def score_texts(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its posterior, tempered by the root of the n-gram count."""
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    told = [i for i, t in enumerate(texts) if model.languages and t and any(map(str.isalpha, t))]
    if told:
        sums, grams = _batch_sums([texts[i] for i in told], model)
        sums += model.prior
        best = sums.argmax(1)  # of equal ones the first by name
        apart = sums - sums[np.arange(len(told)), best][:, None]
        scores[told] = 1.0 / np.exp(apart / np.maximum(1.0, np.sqrt(grams))[:, None]).sum(1)
        for i, k in zip(told, best, strict=True):
            names[i] = model.languages[k]
    return names, scores


def identify(
    frame: DataFrame,
    model: LanguageModel,
    column: str = "text",
    *,
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """The frame with the predicted language and its score; columns of these names are replaced."""
    frame = frame.drop(language, score)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, _SCORE_BYTES):
            names, scores = score_texts(batch.column(column).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)],
                [*batch.schema.names, language, score],
            )

    return frame.mapInArrow(releasing(run), widened(frame, f"{language} string, {score} double"))
