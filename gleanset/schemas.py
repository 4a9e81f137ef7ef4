"""Row shapes shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Stored column names and their order.
SOURCE_COLUMNS = (
    "subreddit",
    "id",
    "title",
    "author",
    "created_utc",
    "created_iso",
    "url",
    "selftext",
)
LABEL_COLUMNS = ("batch_id", "label1", "label2", "label3", "validated_at")
REVIEW_COLUMNS = ("commentable",)

CSV_COLUMNS = SOURCE_COLUMNS + LABEL_COLUMNS
GRID_COLUMNS = CSV_COLUMNS + REVIEW_COLUMNS

# Kept beside the stored columns of a grid store: digest of the body, "" for an empty one.
BODY_KEY = "body_key"

# A column that posts may bring: digest of the whole body, that of the empty text included.
BODY_DIGEST = "body_digest"

# A column that posts may bring: numbers of the search batches that their texts hit.
BATCH_HITS = "batch_hits"

RAW_COLUMNS = (
    "post_id",
    "subreddit",
    "title",
    "text",
    "author",
    "created_utc",
    "score",
    "num_comments",
    "url",
)

RAW_SUBMISSION = (
    "id string, subreddit struct<display_name:string>, title string, selftext string, "
    "author struct<name:string>, created_utc double, score bigint, num_comments bigint, "
    "permalink string, stickied boolean, listing_pos bigint"
)


def stored_schema(columns: tuple[str, ...]) -> T.StructType:
    """Stored rows hold strings only."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
