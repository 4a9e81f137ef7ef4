"""Places of rows within groups, for groups of any size: no group meets in one task.

Rows are dealt by range of group and order, so a task holds consecutive rows.  A row's
place is its place in its task's stretch of the group plus the rows of that group in
earlier tasks; stretches are as many as tasks and groups together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanset.llm.tables import small_enough, stored
from gleanset.plans.durable import durable

_TASK_BITS = 33  # Spark keeps the task above so many bits of its increasing ids


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    both = F.lit(True)
    for c in columns:
        both = both & left[c].eqNullSafe(right[f"_{c}"])
    return both


def sorted_stretches(
    frame: DataFrame, group: Sequence[str], order: Sequence[str], name: str
) -> tuple[DataFrame, DataFrame]:
    """The frame sorted and stored, with ``_at``; and its stretches ``(group, part, first, before, total)``.

    ``before`` counts the group's rows in earlier stretches, ``total`` all its rows.  Nulls come first.
    Rows alike in group and order are placed in any order.
    """
    keys = [*group, *order, "_tie"]
    told = frame.withColumn("_tie", F.monotonically_increasing_id())
    told = told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = stored(told.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", _TASK_BITS).alias("part")
    runs = rows.groupBy(*group, part).agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, durable(runs.select(
        *group, "part", "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    ))


def placed(rows: DataFrame, stretches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows with ``place`` (from 0) and whatever else the stretches carry in place of their columns."""
    marked = stretches.withColumnsRenamed({c: f"_{c}" for c in group})
    parted = rows.withColumn("_part", F.shiftright("_at", _TASK_BITS))
    met = parted.join(
        small_enough(marked), (F.col("_part") == F.col("part")) & _same(rows, marked, group)
    )
    place = F.col("_at") - F.col("first") + F.col("before")
    return met.withColumn("place", place).drop(
        "_at", "_part", "part", "first", "before", *[f"_{c}" for c in group]
    )
