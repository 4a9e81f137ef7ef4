"""Posts derived from the given test tables.

``documents`` gives title (first line), body and community, ``events`` the time,
author and counts of the post with the same number.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset.functions.text import search_text
from gleanset.functions.values import body_digest
from gleanset.plans.parallel import spread
from gleanset.plans.shipping import ship_package
from gleanset.schemas import BATCH_HITS, BODY_DIGEST
from gleanset.sources.raw import raw_flatten

# Terms that do occur in the test tables.
TEST_PAINS = ("it is", "was the", "for the", "in the", "of the", "thon", "er")
TEST_TOOLS = ("thth", "la", "und", "el")
TEST_GROUPS = (("it is", "was the"), ("for the", "in the", "of the"), ("thon",), ("er",))
# Syllables of the test tables; every pair of them is a term of a large vocabulary.
TEST_SYLLABLES = tuple(
    "an en on er th sh re ti in es ou ed st le la de é è ê ç eau aux ment ai oi tre vi pa que elle "
    "ion tion ier ch eux ré the and ing or ly ent nd ha at it is hes wh ble und ung ge be ver ein ich lich "
    "heit keit sch ei ie der die das el os as ado ción mente ar ir".split()
)
TEST_COMMUNITIES = tuple(f"SRC{i}" for i in range(0, 24, 2))


SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
}

# The key that spreads a table of long texts.
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, spread over the cores when its files give too few tasks."""
    return spread(table(spark, sf_dir, name), TEXT_KEYS[name])


def micros(ts: Column) -> Column:
    """Microseconds from the epoch of a zone-less timestamp."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def submissions(
    spark: SparkSession,
    sf_dir: str,
    since: float | None = None,
    matching: bool = False,
    digests: bool = False,
    hits: Callable[[Column], Column] | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Nested submissions; ``since`` bounds their time in the scan of ``events``.

    ``matching`` readies their texts for patterns: see :func:`texts`.  ``digests`` brings digests of the
    bodies, worked out where documents are scanned, so that who needs no more of a body moves none.
    ``hits`` brings the batches that a text hits, likewise.  ``ids`` is one column of a few post ids, which is
    broadcast: texts of other posts are left out where documents are scanned.
    """
    documents = (texts if matching else table)(spark, sf_dir, "documents")
    if ids is not None:
        own = F.concat(F.lit("d"), "doc_id")
        documents = documents.join(F.broadcast(ids.toDF("wanted")), own == F.col("wanted"), "left_semi")
    if digests:
        documents = documents.withColumn(BODY_DIGEST, body_digest(F.coalesce(_body(), F.lit(""))))
    if hits is not None:
        documents = documents.withColumn(BATCH_HITS, hits(search_text(_title(), _body())))
    events = table(spark, sf_dir, "events")
    if since is not None:
        at = datetime.fromtimestamp(since, timezone.utc).replace(tzinfo=None)
        events = events.where(F.col("ts") >= F.lit(at.isoformat(" ")).cast("timestamp_ntz"))
    events = events.select(
        F.col("event_id").alias("doc_id"),
        micros(F.col("ts")).alias("us"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    if since is None:
        # Judged by its packed file, a table of all events seems small enough to be broadcast and
        # then fills each task's memory with every event; merged, a task holds its own share.
        events = events.hint("merge")
    return posts_of(documents.join(events, "doc_id"))


def _title() -> Column:
    cut = F.instr("text", "\n")
    return F.when(cut > 0, F.substring_index("text", "\n", 1)).otherwise(F.col("text"))


def _body() -> Column:
    """What follows the first line, null where there is but one."""
    cut = F.instr("text", "\n")
    return F.when(cut > 0, F.substring("text", cut + 1, F.length("text")))


def posts_of(joined: DataFrame) -> DataFrame:
    """Nested submissions from documents that carry their event's columns."""
    delay_us = F.round(F.col("value") * 60_000_000.0).cast("bigint")
    visible_us = F.col("us") + delay_us
    author = F.when(F.col("event_type") != "error", F.concat(F.lit("u"), "user_id"))
    return joined.select(
        F.concat(F.lit("d"), "doc_id").alias("id"),
        F.struct(F.col("source").alias("display_name")).alias("subreddit"),
        _title().alias("title"),
        _body().alias("selftext"),
        F.struct(author.alias("name")).alias("author"),
        (F.col("us") / 1_000_000.0).alias("created_utc"),
        F.floor("value").alias("score"),
        F.get_json_object("props", "$.k").cast("bigint").alias("num_comments"),
        F.concat(F.lit("/p/"), "doc_id").alias("permalink"),
        (F.col("event_type") == "purchase").alias("stickied"),
        (-visible_us).alias("listing_pos"),
        (visible_us / 1_000_000.0).alias("visible_at"),
        *[c for c in (BODY_DIGEST, BATCH_HITS) if c in joined.columns],
    )


def posts(
    spark: SparkSession,
    sf_dir: str,
    since: float | None = None,
    matching: bool = False,
    digests: bool = False,
    hits: Callable[[Column], Column] | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    return raw_flatten(submissions(spark, sf_dir, since, matching, digests, hits, ids))


def clock(spark: SparkSession, sf_dir: str) -> datetime:
    """The first whole second after the newest post."""
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"))
    events = table(spark, sf_dir, "events").select("event_id", micros(F.col("ts")).alias("us"))
    newest = events.join(ids, "event_id", "left_semi").agg(F.max("us")).first()[0]
    return datetime.fromtimestamp(newest // 1_000_000 + 1, timezone.utc)


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows whose ids and bodies repeat a lot: the hard input of de-duplication."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id").alias("id"),
        F.concat("props", F.lit("|"), "event_type").alias("selftext"),
        micros(F.col("ts")).alias("us"),
        "event_id",
    )
