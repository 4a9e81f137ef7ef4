"""Small helpers the operators share: inputs, scratch tables, size-checked broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.plans.durable import scratch_path
from gleanset.plans.shipping import ship_package

# A frame is broadcast only when it is counted at or below this many rows of bounded width.
BROADCAST_ROWS = 200_000

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
}


# Rows of a batch between the JVM and Python workers, where the session sets none: whole texts are
# long, and Spark's default of 10,000 of them is a scan task's whole input, held on both sides.
BATCH_ROWS = 1_000
_BATCH_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by ``BATCH_ROWS``, unless the session has a bound of its own."""
    if spark.conf.get(_BATCH_ROWS_SETTING, None) is None:
        spark.conf.set(_BATCH_ROWS_SETTING, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Compute the frame now, as a Parquet table in the cluster's shared folder.

    Unlike a checkpoint the table is columnar and compressed; like one it
    outlives the executors that made it.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _give_back() -> None:
    """Let the system have the memory that Arrow and the C library hold in reserve."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task function ``run``, whose worker gives memory back when its last batch is out.

    Workers serve one task after another, of other stages too, beside an executor's own memory.
    """

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def widened(frame: DataFrame, columns: str) -> T.StructType:
    """The frame's schema with the columns of a DDL string at its end."""
    return T.StructType([*frame.schema.fields, *T.StructType.fromDDL(columns).fields])


def small_enough(frame: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if a count shows that it is small; else as it is."""
    return F.broadcast(frame) if frame.count() <= most else frame


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Deal a scan of too few tasks over the cores; a scan with enough tasks moves nothing."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, key)
