"""From nested submissions to flat posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset.functions.values import POST_BASE_URL, author_text, null_to_blank, permalink_url
from gleanset.schemas import BATCH_HITS, BODY_DIGEST, RAW_SUBMISSION


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Submissions as JSON lines, with the schema given; a malformed line fails the job."""
    return spark.read.schema(RAW_SUBMISSION).option("mode", "FAILFAST").json(path)


def raw_flatten(submissions: DataFrame, base_url: str = POST_BASE_URL) -> DataFrame:
    """Nested submission to flat post; scan-only fields are carried along when there."""
    carried = ("stickied", "listing_pos", "visible_at", BODY_DIGEST, BATCH_HITS)
    extra = [c for c in carried if c in submissions.columns]
    return submissions.select(
        F.col("id").alias("post_id"),
        F.col("subreddit.display_name").alias("subreddit"),
        null_to_blank(F.col("title")).alias("title"),
        null_to_blank(F.col("selftext")).alias("text"),
        author_text(F.col("author")).alias("author"),
        F.col("created_utc").cast("double").alias("created_utc"),
        F.col("score").cast("bigint").alias("score"),
        F.col("num_comments").cast("bigint").alias("num_comments"),
        permalink_url(F.col("permalink"), base_url).alias("url"),
        *extra,
    )
