"""Unions, orders, and multiset comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanset.functions.values import body_digest
from gleanset.schemas import BODY_DIGEST

STREAMS = ("both", "curated", "global")

# Columns of the source order that stream_union adds.
SOURCE_ORDER = ("stream_no", "part_no", "place", "post_id", "body_key")


def check_stream(stream: str) -> str:
    if stream not in STREAMS:
        raise ValueError(f"stream must be one of {', '.join(STREAMS)}; got {stream!r}")
    return stream


def stream_union(curated: DataFrame | None, searched: DataFrame | None) -> DataFrame:
    """Curated posts, then searched posts, all copies kept, with the source order as columns.

    Curated posts go by community, then newest first (or by listing place);
    searched posts by batch, then rank.  The order is data: no global sort and no
    global numbering takes place.  Posts that bring digests of their bodies are not read for them.
    """
    parts = []
    if curated is not None:
        place = -F.col("created_utc")
        if "listing_pos" in curated.columns:
            place = F.col("listing_pos").cast("double")
        parts.append(
            curated.withColumns(
                {"stream_no": F.lit(0), "part_no": F.col("list_pos"), "place": place}
            ).drop("list_pos")
        )
    if searched is not None:
        parts.append(
            searched.withColumns(
                {
                    "stream_no": F.lit(1),
                    "part_no": F.col("batch"),
                    "place": F.col("rank").cast("double"),
                }
            ).drop("batch", "rank")
        )
    if not parts:
        raise ValueError("a union needs at least one stream")
    parts = [_with_body_key(p) for p in parts]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def _with_body_key(posts: DataFrame) -> DataFrame:
    if BODY_DIGEST in posts.columns:
        return posts.withColumn("body_key", F.col(BODY_DIGEST)).drop(BODY_DIGEST)
    return posts.withColumn("body_key", body_digest(F.coalesce("text", F.lit(""))))


def source_order(rows: DataFrame) -> DataFrame:
    """Rows in source order; meant for the very end."""
    return rows.orderBy(*[c for c in SOURCE_ORDER if c in rows.columns])


def distinct_by_id(rows: DataFrame, order: list[str], id_column: str = "post_id") -> DataFrame:
    """One row per id, the *last* in order; an aggregate, so copies fold before the shuffle."""
    others = [c for c in rows.columns if c != id_column]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("last")
    return rows.groupBy(id_column).agg(last).select(id_column, "last.*").select(rows.columns)


def vocab_partition_check(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of two one-column multisets that are not matched: ``missing`` or ``surplus``.

    Empty when ``held`` splits ``wanted`` exactly.
    """
    (column,) = wanted.columns
    weighed = wanted.withColumn("_weight", F.lit(1)).unionByName(
        held.withColumn("_weight", F.lit(-1))
    )
    excess = weighed.groupBy(column).agg(F.sum("_weight").alias("_excess")).where("_excess <> 0")
    side = F.when(F.col("_excess") > 0, "missing").otherwise("surplus")
    return excess.select(column, side.alias("side"), F.abs("_excess").alias("copies"))
