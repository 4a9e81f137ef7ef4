import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gleanset.sources import archive
from gleanset.sources.curated import curated_scan, lookback_filter

NOW = datetime(2026, 3, 9, 5, tzinfo=timezone.utc)
POSTS = "post_id string, subreddit string, stickied boolean, listing_pos bigint, created_utc double, text string"


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(f"p{i}", "abc"[i % 3], i % 7 == 0, i, NOW.timestamp() - i * 900.5, None if i % 5 else "x" * i)
            for i in range(2_000)]
    return spark.createDataFrame([*rows, ("none", "a", False, 1, None, "t"), ("old", "a", False, 2, -5.5, "t")], POSTS)


@pytest.fixture(scope="module")
def path(posts, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("archive") / "posts")
    archive.write_archive(posts.where("listing_pos % 2 = 0 or created_utc is null"), made, file_rows=100)
    archive.write_archive(posts.where("listing_pos % 2 = 1 and created_utc is not null"), made, file_rows=100)
    return made


def files_read(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if s.nodeName().startswith("Scan parquet"))


@pytest.mark.parametrize("hours", [0.5, 13, 24 * 30])
def test_a_scan_gives_the_posts_of_the_lookback(spark, posts, path, hours):
    got = archive.archive_scan(spark, path, posts.schema, NOW, hours)
    assert got.schema == posts.schema
    want = lookback_filter(posts, NOW, hours)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    for first in (True, False):
        one = curated_scan(got, "A", hours, NOW, newest_first=first)
        other = curated_scan(want, "A", hours, NOW, newest_first=first)
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_a_scan_lists_the_files_of_its_days_only(spark, posts, path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        recent = archive.archive_scan(spark, path, posts.schema, NOW, 13)
        everything = spark.read.parquet(path)
        days = {r.day for r in everything.where(F.col("day") >= 20_520).select("day").distinct().collect()}
        assert len(days) == 2  # 13 hours before five in the morning begin the day before
        least, most = files_read(recent), files_read(everything)
        assert 0 < least <= 6 < 20 < most
        plan = recent._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[.*day", plan) and re.search(r"PushedFilters: \[.*created_utc", plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_files_are_ranges_of_time(spark, path):
    spans = [
        (r.a, r.b) for r in spark.read.parquet(path + "/day=20520").groupBy(F.input_file_name())
        .agg(F.min("created_utc").alias("a"), F.max("created_utc").alias("b")).collect()
    ]
    assert spans and all(b - a <= 86_400 for a, b in spans)


def test_archive_cases(spark, posts, tmp_path):
    made = str(tmp_path / "none")
    archive.write_archive(posts.limit(0), made)
    assert archive.archive_scan(spark, made, posts.schema, NOW, 5).count() == 0
    with pytest.raises(ValueError, match="day"):
        archive.write_archive(posts.withColumn("Day", F.lit(1)), made)


def test_long_posts_are_dealt_by_their_bytes(spark, tmp_path):
    """Few rows with much text, all of one time or of none, go to many tasks."""
    rows = [("a" * 3, "c", False, i, None if i % 2 else 5.0, "y" * 1_000) for i in range(400)]
    posts = spark.createDataFrame(rows, POSTS)
    path = str(tmp_path / "posts")
    archive.write_archive(posts, path, file_bytes=40_000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in files) == 400
    assert len(files) >= 8 and max(r["count"] for r in files) <= 100
