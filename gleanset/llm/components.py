"""Connected components of an edge list, by alternating stars, in DataFrame operations.

Every round links the larger neighbours of each vertex, then all of its neighbours
that are not larger, to its least neighbour (Kiveris et al., SoCC 2014).  Both steps
are a minimum per vertex and a join back, so a vertex with very many neighbours is
aggregated by part and its join is split by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.plans.durable import durable


# From so many edges on, a vertex may have more than a task should hold.
MANY_EDGES = 100_000


def _star(pairs: DataFrame, own: bool, many: bool) -> DataFrame:
    """Link each ``b`` of a vertex ``a`` to the least of them all.

    With ``own``, ``a`` is linked too; otherwise only those ``b`` that are larger than ``a``.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("k"), F.least("a", "m").alias("m")
    )
    if many:
        # Spark splits a join's large key only where both sides come from a shuffle.
        least = durable(least)
    joined = pairs.join(least, F.col("a") == F.col("k"))
    if own:
        linked = joined.select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(
            least.select(F.col("k").alias("x"), F.col("m").alias("y"))
        )
    else:
        linked = joined.where("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    return linked.where("x <> y").distinct()


def _signature() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("s")]


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of edges ``(a, b)``; the component is its least id.

    Rows with a null end and loops are passed over; an edge may come in either or
    both directions and repeat.
    """
    now = durable(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct()
    )
    seen = now.agg(*_signature()).first()
    while seen["n"]:
        both = now.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(
            now.select(F.col("y").alias("a"), F.col("x").alias("b"))
        )
        many = seen["n"] > MANY_EDGES
        large = _star(both, own=False, many=many)
        down = large.select(F.col("x").alias("a"), F.col("y").alias("b"))
        now = durable(_star(down, own=True, many=many))
        after = now.agg(*_signature()).first()
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("y").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(roots)
