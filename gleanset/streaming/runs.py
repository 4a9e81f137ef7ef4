"""Continuous collection: exactly-once appends, scheduled windows, late rows, first seen and first copies."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanset.functions.values import body_digest
from gleanset.operators.cleaning import clean_posts
from gleanset.operators.dedup import known_keys, ordered_dedup
from gleanset.operators.sets import check_stream
from gleanset.plans.durable import durable
from gleanset.plans.run import RunSettings, run_batch
from gleanset.schemas import BODY_DIGEST
from gleanset.sinks.stored import current_version, verified_append
from gleanset.sinks.versions import discard
from gleanset.sources.curated import lookback_filter
from gleanset.sources.stored import snapshot_keys

# Cadence, lookback, and offset from midnight of both schedules, in seconds.
GLOBAL_SCHEDULE = (3 * 3600, 6 * 3600, 0)
CURATED_SCHEDULE = (12 * 3600, 13 * 3600, 30 * 60)


def writer_name(store: str) -> str:
    """Query name of a store's only writer; Spark refuses a second active query of that name."""
    return "append-" + hashlib.sha256(store.encode()).hexdigest()[:16]


def _with_digests(posts: DataFrame) -> DataFrame:
    """Posts with digests of their bodies; those that they bring are kept."""
    digest = body_digest(F.coalesce("text", F.lit("")))
    if BODY_DIGEST in posts.columns:
        digest = F.coalesce(BODY_DIGEST, digest)
    return posts.withColumn(BODY_DIGEST, digest)


def lookback_window(batch: DataFrame, state: str, number: int, now: datetime, hours: float) -> DataFrame:
    """Posts of the micro-batch and of earlier ones that are not older than the lookback.

    They are kept as one folder per micro-batch, made of the folder before it, so the state is
    bounded by the posts of one lookback and a replayed micro-batch makes the same folder again.
    Digests of the bodies are kept beside them, so that a run judges posts without reading
    their bodies; a folder without digests, as older states have, gets them on the way.
    """
    spark = batch.sparkSession
    recent = _with_digests(lookback_filter(batch, now, hours))
    schema = recent.schema
    if number:
        earlier = spark.read.schema(schema).parquet(f"{state}/batch={number - 1}")
        recent = _with_digests(lookback_filter(earlier, now, hours)).unionByName(recent)
    recent.write.mode("overwrite").option("compression", "zstd").parquet(f"{state}/batch={number}")
    if number > 1:
        discard(spark, state, f"batch={number - 2}")
    return spark.read.schema(schema).parquet(f"{state}/batch={number}")


def incremental_append(
    posts: DataFrame,
    store: str,
    checkpoint: str,
    *,
    backend: str = "csv",
    order: tuple[str, ...] = ("created_utc", "post_id"),
    settings: RunSettings | None = None,
    now: datetime | Callable[[int], datetime] | None = None,
    stream: str = "both",
    state: str | None = None,
) -> StreamingQuery:
    """Append the new rows of a stream of posts to a store, then stop when it is drained.

    With ``settings`` every micro-batch is a whole run: both streams are collected over the
    posts of the last lookback, whichever micro-batch brought them, so a post competes for the places of a
    search until it is too old.  ``now`` is the time of the run, or tells it for a micro-batch's
    number.  Without ``settings`` every post of the stream is a candidate, in the given order.

    A micro-batch replayed after a failure is judged against the store without
    its own files and replaces them, so it is appended exactly once.  Runs carry
    the query's id, which lives as long as its checkpoint: a query started
    afresh never touches the runs of an earlier one.
    """
    if settings is not None and now is None:
        raise ValueError("a run needs its time: pass now")
    check_stream(stream)
    started = threading.Event()
    query_id: list[str] = []
    folder = state or f"{checkpoint.rstrip('/')}-lookback"

    def collect(batch: DataFrame, number: int, run: str) -> None:
        at = now(number) if callable(now) else now
        hours = max(settings.curated_hours, settings.global_hours)
        window = lookback_window(batch, folder, number, at, hours)
        run_batch(
            batch.sparkSession, window, store, run, settings, at, stream=stream, backend=backend, stored_posts=True
        )

    def take_all(batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        base = current_version(spark, store)
        at = base.number if base.number >= 0 else None
        carried = [f"_{i}" for i in range(len(order))]
        ordered = batch.withColumns({c: F.col(o) for c, o in zip(carried, order, strict=True)})
        # Read once: a second read of a micro-batch would run its source and state again.
        cleaned = durable(clean_posts(ordered, *carried))
        known = known_keys(cleaned, snapshot_keys(spark, store, backend, except_run=run, version=at))

        def fresh(keys: DataFrame) -> DataFrame:
            return durable(ordered_dedup(cleaned, keys, carried).drop(*carried))

        def renew(added: DataFrame) -> DataFrame:
            nonlocal known
            known = known.unionByName(known_keys(cleaned, added))
            return fresh(known)

        verified_append(fresh(known), store, run, backend, since=base, renew=renew)

    def append(batch: DataFrame, number: int) -> None:
        started.wait()
        run = f"{query_id[0]}-{number}"
        if settings is None:
            take_all(batch, run)
        else:
            collect(batch, number, run)

    query = (
        posts.writeStream.queryName(writer_name(store))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append)
        .trigger(availableNow=True)
        .start()
    )
    query_id.append(str(query.id))
    started.set()
    return query


def _tick(at: Column, cadence: int, offset: int, up: bool) -> Column:
    steps = (at - F.lit(float(offset))) / F.lit(float(cadence))
    return (F.ceil(steps) if up else F.floor(steps)).cast("bigint")


def run_time(tick: Column, cadence: int, offset: int) -> Column:
    return tick * F.lit(cadence) + F.lit(offset)


def sliding_runs(posts: DataFrame, cadence: int, lookback: int, offset: int) -> DataFrame:
    """Per scheduled run: posts in its lookback, posts first seen by it, posts seen before.

    A run at ``t`` covers ``[t - lookback, t]``, both ends included, so the runs
    of a post are counted out directly; ``window`` would leave one end open.
    """
    first = _tick(F.col("created_utc"), cadence, offset, up=True)
    last = _tick(F.col("created_utc") + F.lit(float(lookback)), cadence, offset, up=False)
    spans = posts.select("post_id", first.alias("first_tick"), last.alias("last_tick"))
    seen = (
        spans.where("first_tick <= last_tick")
        .select(F.explode(F.sequence("first_tick", "last_tick")).alias("tick"))
        .groupBy("tick")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    new = (
        spans.where("first_tick <= last_tick")
        .groupBy("post_id")
        .agg(F.min("first_tick").alias("tick"))
        .groupBy("tick")
        .agg(F.count(F.lit(1)).alias("first_seen"))
    )
    first_seen = F.coalesce("first_seen", F.lit(0))
    return seen.join(new, "tick", "left").select(
        run_time(F.col("tick"), cadence, offset).alias("run_at"),
        "seen",
        first_seen.alias("first_seen"),
        (F.col("seen") - first_seen).alias("seen_again"),
    )


def late_data(posts: DataFrame, cadence: int, lookback: int, offset: int) -> DataFrame:
    """Posts by hours from creation to visibility: how many a later run still catches.

    A post is caught when the first run at or after ``visible_at`` looks back to
    its creation; that is certain up to a delay of lookback minus cadence.
    """
    first_run = run_time(
        _tick(F.col("visible_at"), cadence, offset, up=True), cadence, offset
    )
    caught = F.col("created_utc") >= first_run - F.lit(lookback)
    delay = F.floor((F.col("visible_at") - F.col("created_utc")) / F.lit(3600.0))
    return (
        posts.select(delay.cast("bigint").alias("delay_hours"), caught.alias("caught"))
        .groupBy("delay_hours")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.count_if("caught").alias("caught"),
            F.count_if(~F.col("caught")).alias("missed"),
        )
    )


def run_windows(posts: DataFrame, cadence: int, lookback: int, offset: int) -> DataFrame:
    """Streaming counts per run window, final once the watermark has passed a window.

    ``ts`` is the event time.  Rows later than the lookback are dropped, as a
    scheduled run would no longer see them.
    """
    # Windows begin one lookback before their run.
    start = (offset - lookback) % cadence
    span = F.window("ts", f"{lookback} seconds", f"{cadence} seconds", f"{start} seconds")
    return (
        posts.withWatermark("ts", f"{lookback} seconds")
        .groupBy(span.alias("span"))
        .agg(F.count(F.lit(1)).alias("seen"))
        .select(F.unix_seconds("span.end").alias("run_at"), "seen")
    )


def stream_first_seen(posts: DataFrame, delay: str) -> DataFrame:
    """One copy of every id within the watermark delay, told at once; state stays bounded.

    Which copy is kept is open; where the first in order must win, use :func:`stream_first_copy`.
    """
    return posts.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["post_id"])


def stream_first_copy(
    posts: DataFrame, apart: str, delay: str, order: Sequence[str] = ("batch", "rank")
) -> DataFrame:
    """The copy of every id that is first in the given order, whatever order the copies come in.

    Copies of an id are a session: each within ``apart`` of the one before, by event time ``ts``.
    The state holds the least copy of every open session, and a session is told once and let go when
    the watermark, ``delay`` behind the newest row, has passed its end.  So the state is bounded by
    the ids of ``apart`` and ``delay`` together.  Rows later than the watermark are dropped, and
    so are rows without a time; rows without an id count as one id.  Of copies that tie in order any may be kept.
    """
    columns = posts.columns
    least = F.min_by(F.struct(*columns), F.struct(*order))
    return (
        posts.withWatermark("ts", delay)
        .groupBy("post_id", F.session_window("ts", apart).alias("session"))
        .agg(least.alias("first"))
        .select(*[F.col("first").getField(c).alias(c) for c in columns])
    )


def late_data_stream(posts: DataFrame, cadence: int, lookback: int, offset: int) -> DataFrame:
    """:func:`late_data` as a stream: per run that first sees a post, and per hours of delay.

    Rows come as they get visible.  The run's own watermark is its time less the lookback: a row
    created behind it is missed, and is counted here instead of being dropped.  A run is told once, when
    a later run's rows have moved the stream's watermark, one cadence behind, past it.
    """
    tick = _tick(F.col("visible_at"), cadence, offset, up=True)
    first_run = run_time(tick, cadence, offset)
    delay = F.floor((F.col("visible_at") - F.col("created_utc")) / F.lit(3600.0))
    return (
        posts.select(
            F.timestamp_seconds(first_run).alias("run"),
            delay.cast("bigint").alias("delay_hours"),
            (F.col("created_utc") >= first_run - F.lit(lookback)).alias("caught"),
        )
        .withWatermark("run", f"{cadence} seconds")
        .groupBy("run", "delay_hours")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.count_if("caught").alias("caught"),
            F.count_if(~F.col("caught")).alias("missed"),
        )
        .select(F.unix_seconds("run").alias("run_at"), "delay_hours", "posts", "caught", "missed")
    )
