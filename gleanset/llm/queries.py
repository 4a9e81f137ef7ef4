"""Named queries of the operators for training data, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset.llm import bpe, centroids, chat_format, language_id, line_dedup, merkle, minhash, mixing
from gleanset.llm import substring_dedup, token_counts, vectors, warc
from gleanset.llm.decontamination import find_leaks
from gleanset.llm.tables import spread, table

BPE_FILE = "byte_bpe_50k.json"
UNIGRAM_FILE = "piece_bpe_32k.model"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_boilerplate(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", words), (-7, 1, "assistant", words)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").unionByName(extra)
    made = chat_format.format_chats(turns).withColumn("turns", chat_format.read_turns(F.col("formatted")))
    told = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = chat_format.loss_text(F.col("segments"))
    return made.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = warc.write_archives(pages, warc.archive_folder(pages))
    return warc.read_records(index, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), shingle_words=4)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    learned = documents.where(held_out.isNull() | ~held_out)
    model = language_id.train(learned, key=F.col("doc_id"))
    told = language_id.identify(documents.select("doc_id", "text"), model)
    return told.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_pieces(spark, public_tokenizers.path(UNIGRAM_FILE))
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(documents, pieces).select("doc_id", "n_tokens")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load_vocabulary(spark, public_tokenizers.path(BPE_FILE))
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    encoded = bpe.bpe_encode(documents, vocabulary, decoded="decoded")
    ids = F.col("ids")
    return encoded.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        bpe.text_digest(ids).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = centroids.cluster_vectors(spread(table(spark, sf_dir, "embeddings"), "vec_id"))
    return told.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), F.col("lang").alias("group"), merkle.row_digest([*fields, "text"]).alias("leaf"),
        F.when(tampered, merkle.row_digest([*fields, lowered])).alias("claim"),
    )
    told = merkle.manifest(leaves)
    folded = merkle.folded_root(F.coalesce("claim", "leaf"), F.col("path"))
    return told.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return told.select("doc_id", "size", "source_size", "target", "taken")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_substring_dedup, op2_line_dedup, op3_chat_format, op4_warc, op5_embedding_dedup,
            op6_decontamination, op7_minhash, op8_language_id, op9_token_counts, op10_bpe, op11_centroids,
            op12_merkle, op13_mixing,
        )
    }
