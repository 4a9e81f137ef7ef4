"""Scans of recent posts: by age, by community, and along a listing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanset.vocabulary import allow_list_frame


def cutoff_epoch(now: datetime, hours: float) -> float:
    """Epoch seconds of ``now - hours``; ``now`` must carry a time zone."""
    if hours <= 0:
        raise ValueError("lookback hours must be positive")
    if now.tzinfo is None:
        raise ValueError("now must carry a time zone")
    return (now.astimezone(timezone.utc) - timedelta(hours=hours)).timestamp()


def lookback_filter(
    posts: DataFrame,
    now: datetime,
    hours: float,
    column: str = "created_utc",
) -> DataFrame:
    """Posts not older than the lookback; a literal bound, so Parquet row groups are skipped."""
    return posts.where(F.col(column) >= F.lit(cutoff_epoch(now, hours)))


def day_prefilter(
    posts: DataFrame,
    now: datetime,
    max_age_hours: float = 24,
    column: str = "created_utc",
) -> DataFrame:
    """Bound on candidate age in keyword search; it also caps any longer lookback."""
    return lookback_filter(posts, now, max_age_hours, column)


def allow_list(posts: DataFrame, communities: Sequence[str]) -> DataFrame:
    """Posts of the listed communities, once each."""
    listed = allow_list_frame(posts.sparkSession, communities).select("community_key")
    keyed = posts.withColumn("community_key", F.lower("subreddit"))
    # The list is a Python argument, so its size is bounded.
    return keyed.join(F.broadcast(listed), "community_key", "left_semi").drop("community_key")


def prefix_stop(listings: DataFrame, communities: Sequence[str], cutoff: float) -> DataFrame:
    """Read every listing from its top down to the first old post that is not sticky.

    Old sticky posts are passed over.  ``listing_pos`` gives a post's place.  The
    stop of a listing is one minimum, so no listing is sorted or gathered; the
    stops are at most as many as the communities asked for.
    """
    keyed = allow_list(listings, communities).withColumn("_key", F.lower("subreddit"))
    old = keyed.where((F.col("created_utc") < cutoff) & ~F.coalesce("stickied", F.lit(False)))
    stops = old.groupBy("_key").agg(F.min("listing_pos").alias("_stop"))
    recent = keyed.where(F.col("created_utc") >= cutoff)
    return (
        recent.join(F.broadcast(stops), "_key", "left")
        .where(F.col("_stop").isNull() | (F.col("listing_pos") < F.col("_stop")))
        .drop("_key", "_stop")
    )


def multi_scan(
    posts: DataFrame,
    communities: Sequence[str],
    lookback_hours: float,
    now: datetime,
    *,
    newest_first: bool = True,
) -> DataFrame:
    """Recent posts of every listed community; ``list_pos`` is the community's place.

    In listings sorted newest first the scan equals the age filter.  With
    ``newest_first=False`` the stop rule is applied along ``listing_pos``.
    """
    cutoff = cutoff_epoch(now, lookback_hours)
    if newest_first:
        kept = posts.where(F.col("created_utc") >= cutoff)
    else:
        kept = prefix_stop(posts, communities, cutoff)
    listed = allow_list_frame(posts.sparkSession, communities).select("community_key", "list_pos")
    keyed = kept.withColumn("community_key", F.lower("subreddit"))
    return keyed.join(F.broadcast(listed), "community_key").drop("community_key")


def curated_scan(
    posts: DataFrame,
    community: str,
    lookback_hours: float,
    now: datetime,
    *,
    newest_first: bool = True,
) -> DataFrame:
    """Recent posts of one community."""
    scan = multi_scan(posts, [community], lookback_hours, now, newest_first=newest_first)
    return scan.drop("list_pos")


def source_skip(posts: DataFrame, communities: Sequence[str]) -> DataFrame:
    """Listed communities that the data does not hold at all: the skip report.

    Unreadable data is another matter and still fails the job.
    """
    listed = allow_list_frame(posts.sparkSession, communities)
    seen = allow_list(posts, communities).select(F.lower("subreddit").alias("community_key"))
    return listed.join(F.broadcast(seen.distinct()), "community_key", "left_anti").select(
        "list_pos", "community"
    )


def community_counts(kept: DataFrame, communities: Sequence[str]) -> DataFrame:
    """Posts kept per listed community, zeros included."""
    counts = kept.groupBy(F.lower("subreddit").alias("community_key")).agg(
        F.count(F.lit(1)).alias("posts")
    )
    listed = allow_list_frame(kept.sparkSession, communities)
    return listed.join(counts, "community_key", "left").select(
        "list_pos", "community", F.coalesce("posts", F.lit(0)).alias("posts")
    )
