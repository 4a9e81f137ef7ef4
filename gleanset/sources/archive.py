"""An archive of posts laid out by time, so that a scan opens the files of its lookback only."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.operators.dedup import free_names
from gleanset.plans.durable import durable
from gleanset.sources.curated import cutoff_epoch, lookback_filter

DAY_SECONDS = 86_400
# Folders are named by the day's number since the epoch, so a bound on time is a bound on names.
DAY = "day"
# Posts a file should hold, and bytes of text a task should write, about.
FILE_ROWS = 1_000_000
FILE_BYTES = 128 << 20


def day_number(at: Column) -> Column:
    return F.floor(at / F.lit(float(DAY_SECONDS))).cast("int")


def _text_bytes(rows: DataFrame) -> Column:
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0).cast("bigint"))


def write_archive(
    posts: DataFrame,
    path: str,
    *,
    column: str = "created_utc",
    file_rows: int = FILE_ROWS,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Add posts to the archive, one folder per day, each file a range of time.

    Rows are dealt by ranges of time, so a busy day gets many files and quiet days share a task; within
    a file they lie in order, so the row groups of one file do not overlap either.  Posts of one time,
    and those without a time, may be dealt to several tasks.  The latter lie in a folder of their own, which no
    lookback opens.  The posts are made once and kept in reliable storage, where they are counted,
    sampled for the ranges, and written from.
    """
    if DAY in {c.lower() for c in posts.columns}:
        raise ValueError(f"the archive names its folders by a column {DAY!r} of its own")
    (place,) = free_names([*posts.columns, DAY], "_place")
    kept = durable(posts)
    rows, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(_text_bytes(kept)), F.lit(0))).first()
    files = max(1, -(-rows // file_rows), -(-size // file_bytes))
    placed = kept.withColumn(DAY, day_number(F.col(column))).withColumn(place, F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(files, column, place).drop(place)
    dealt.sortWithinPartitions(DAY, column).write.mode("append").partitionBy(DAY).parquet(path)


def archive_scan(
    spark: SparkSession, path: str, schema: T.StructType, now: datetime, hours: float, *, column: str = "created_utc"
) -> DataFrame:
    """Posts of the lookback, with the columns of the schema.

    The bound on days is a literal on the folder's name, so older days are not even listed as
    files of the scan; within the first day the bound on time reaches the row groups.
    """
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.IntegerType())])).parquet(path)
    first = int(cutoff_epoch(now, hours) // DAY_SECONDS)
    return lookback_filter(whole.where(F.col(DAY) >= F.lit(first)), now, hours, column).drop(DAY)
