"""A training corpus in five stages: language, lines, near copies, leaks, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given.  ``run``
writes every stage's rows as Parquet to the cluster's shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset.llm import bpe, decontamination, language_id, line_dedup, minhash
from gleanset.llm.queries import BPE_FILE
from gleanset.llm.tables import spread, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# No SQL form: naive Bayes scores, sketches, alignments and merges are outside it.
ORACLE_SQL = None


def _documents_like(frame: DataFrame) -> DataFrame:
    return frame.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, with the predicted one as ``lang``; others are rejected.

    So are those scored below ``language_id.MIN_SCORE``, where no language leads.
    """
    model = language_id.train(docs, key=F.col("doc_id"))
    told = language_id.identify(spread(docs, "doc_id"), model)
    known = told.where(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= language_id.MIN_SCORE)
    )
    return known.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source."""
    return _documents_like(line_dedup.drop_boilerplate(docs, "source"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id."""
    return minhash.keep_one(spread(docs, "doc_id")).select(*COLUMNS)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return decontamination.drop_leaks(spread(docs, "doc_id"), items).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    vocabulary = bpe.load_vocabulary(spark, public_tokenizers.path(BPE_FILE))
    encoded = bpe.bpe_encode(spread(docs, "doc_id"), vocabulary, decoded="decoded")
    return encoded.select(
        "doc_id", "lang", "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.text_digest(F.col("ids")).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_copies),
    ("benchmark_decontamination", leaks),
    ("bpe_encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
