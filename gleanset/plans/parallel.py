"""Task counts for pattern matching over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Repartition a scan by a unique key when it has fewer tasks than there are cores.

    Matching is all processor time, so a few small files would leave most cores
    idle.  A scan with enough tasks is left as it is: no text is moved.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, key)
