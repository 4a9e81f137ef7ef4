"""Posts to the eight stored source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.functions.values import epoch_micros, epoch_to_iso, null_to_blank, numeric_cast


def _seconds(posts: DataFrame) -> Column:
    if isinstance(posts.schema["created_utc"].dataType, T.StringType):
        return numeric_cast(F.col("created_utc"))
    return F.col("created_utc").cast("double")


def reject_reason(posts: DataFrame) -> Column:
    """The first check a post fails, or null."""
    seconds = _seconds(posts)
    return (
        F.when(null_to_blank(F.col("post_id")) == "", "post_id is required")
        .when(null_to_blank(F.col("subreddit")) == "", "subreddit is required")
        .when(F.col("created_utc").isNull(), "created_utc is required")
        .when(seconds.isNull(), "created_utc must be numeric")
        .when(epoch_micros(seconds).isNull(), "created_utc is no date")
    )


def required_check(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report form: posts that pass, and posts that do not with their ``reject_reason``."""
    reason = reject_reason(posts)
    return posts.where(reason.isNull()), posts.withColumn("reject_reason", reason).where(
        F.col("reject_reason").isNotNull()
    )


def clean_project(posts: DataFrame, *carry: str) -> DataFrame:
    """Rename, fill, and drop what is not stored; the body stays as it is, byte for byte.

    ``carry`` names extra columns kept for ordering; they are no stored columns.
    """
    seconds = _seconds(posts)
    return posts.select(
        null_to_blank(F.col("subreddit")).alias("subreddit"),
        null_to_blank(F.col("post_id")).alias("id"),
        null_to_blank(F.col("title")).alias("title"),
        null_to_blank(F.col("author")).alias("author"),
        seconds.alias("created_utc"),
        epoch_to_iso(seconds).alias("created_iso"),
        null_to_blank(F.col("url")).alias("url"),
        null_to_blank(F.col("text")).alias("selftext"),
        *carry,
    )


def clean_posts(posts: DataFrame, *carry: str) -> DataFrame:
    """Strict form: a post that fails a check fails the whole batch."""
    reason = reject_reason(posts)
    passes = F.when(reason.isNotNull(), F.raise_error(reason).cast("boolean")).otherwise(True)
    return clean_project(posts.where(passes), *carry)
