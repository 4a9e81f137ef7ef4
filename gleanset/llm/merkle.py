"""A Merkle manifest of a dataset, with a proof for every row, in DataFrame operations.

Method: slot pivot.  At every level conditional aggregates spread the children of a
parent into ``fanout`` columns; the columns joined together are hashed, and joined
without a child's own column they are its siblings.  Each group of rows has a tree
over its leaves, and one more tree stands over the groups' roots in order of group.

Going up, a level has an eighth of the rows of the one below.  Siblings come down
from the root, so a path is written once per run of children and not once per leaf.
Places in a group come from a sort by range (see ``places``), so one group may hold
most rows; a text never leaves the task that reads it.

Cases: a null field hashes as ``-``, so it differs from an empty one.  Rows with equal or
null keys are leaves of their own, ordered by digest, null keys first; a null group is a group, the
first.  A lone leaf is its group's root and a lone group's root is the root.  An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.places import placed, sorted_stretches
from gleanset.llm.tables import stored

FANOUT = 8


def row_digest(columns: Sequence[str | Column]) -> Column:
    """Lowercase hex SHA-256 of fields: each ``-`` if null, else its UTF-8 length, a colon, and it."""
    fields = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(told, F.lit("-")))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def _hash(parts: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _levels(leaves: int, fanout: int) -> int:
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // fanout)
        levels += 1
    return levels


def _above(fanout: int) -> Column:
    """How many nodes of a group the next level has."""
    return F.floor((F.col("n") + F.lit(fanout - 1)) / F.lit(fanout)).cast("bigint")


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents of ``(g, place, n, node)``: a column of ``node`` per slot, and the digest of all."""
    slot = F.pmod("place", F.lit(fanout))
    spread = [F.max(F.when(slot == i, F.col("node"))).alias(f"s{i}") for i in range(fanout)]
    wide = nodes.groupBy("g", "n", F.floor(F.col("place") / fanout).cast("bigint").alias("place")).agg(*spread)
    children = [F.coalesce(F.col(f"s{i}.digest"), F.lit("")) for i in range(fanout)]
    return wide.withColumn("digest", _hash(children)).withColumn("n", _above(fanout))


def _grow(nodes: DataFrame, most: int, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The parents of every level, and each group's root ``(g, digest)``."""
    levels = []
    roots = nodes.where("n = 1").select("g", "node.digest")
    for _ in range(_levels(most, fanout)):
        wide = stored(_pivot(nodes.where("n > 1"), fanout), name)
        levels.append(wide)
        nodes = wide.select("g", "place", "n", F.struct("digest").alias("node"))
        roots = roots.unionByName(nodes.where("n = 1").select("g", "node.digest"))
    return levels, roots


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """Children ``(g, place, node, carry, path)`` of parents that know their own path."""
    told = [F.coalesce(F.col(f"s{i}.digest"), F.lit("")) for i in range(fanout)]
    nothing = F.lit("")
    kin = [
        F.struct(
            F.lit(i).alias("slot"),
            F.col(f"s{i}").alias("node"),
            F.concat(nothing, *told[:i]).alias("left"),
            F.concat(nothing, *told[i + 1 :]).alias("right"),
        )
        for i in range(fanout)
    ]
    each = parents.select("g", "place", "carry", "path", F.explode(F.array(*kin)).alias("kin"))
    step = F.array(F.struct("kin.left", "kin.right"))
    return each.where("kin.node is not null").select(
        "g",
        (F.col("place") * fanout + F.col("kin.slot")).alias("place"),
        F.col("kin.node").alias("node"),
        "carry",
        F.concat(step, F.col("path")).alias("path"),
    )


def _no_path() -> Column:
    return F.array().cast("array<struct<left string, right string>>")


def _descend(levels: list[DataFrame], tops: DataFrame | None, fanout: int, name: str) -> DataFrame | None:
    """Leaves of the levels with their paths; ``tops`` has ``(g, carry, path)`` of each group's root.

    Without ``tops`` the levels are those of a single group, whose root ends every path.
    """
    below = None
    for depth, wide in reversed(list(enumerate(levels))):
        own = wide.where("n = 1")
        own = own.withColumns({"carry": F.lit(""), "path": _no_path()}) if tops is None else own.join(tops, "g")
        if below is not None:
            known = below.select("g", "place", "carry", "path")
            own = own.unionByName(wide.where("n > 1").join(known, ["g", "place"]).select(own.columns))
        below = _children(own, fanout)
        if depth:
            below = stored(below, name)
    return below


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Proofs of ``leaves``, which have ``(key, group, leaf)`` and may have ``claim``.

    Gives ``key, leaf, claim, subroot, root, path``: ``path`` lists from the leaf up to
    the root what stands left and right of it in each run, as joined digests.  ``claim`` is a digest to
    test in the leaf's place, null where there is none.
    """
    spark = leaves.sparkSession
    if "claim" not in leaves.columns:
        leaves = leaves.withColumn("claim", F.lit(None).cast("string"))
    # A null group sorts before the empty one.
    named = F.coalesce(F.concat(F.lit("+"), F.col("group").cast("string")), F.lit(""))
    # Stored first, since a sort by range reads its input twice, and here that may be whole texts.
    rows = stored(leaves.select(named.alias("g"), "key", "leaf", "claim"), "merkle-digests")
    kind = "key {}, leaf string, claim string, subroot string, root string, path array<struct<left string, right string>>"
    rows, stretches = sorted_stretches(rows, ["g"], ["key", "leaf"], "merkle-leaves")
    most = stretches.agg(F.max("total")).first()[0]
    if most is None:
        return spark.createDataFrame([], kind.format(rows.schema["key"].dataType.simpleString()))
    nodes = placed(rows, stretches, ["g"]).select(
        "g", "place", F.col("total").alias("n"), F.struct(F.col("leaf").alias("digest"), "key", "claim").alias("node")
    )
    levels, roots = _grow(nodes, most, fanout, "merkle-level")

    roots = stored(roots.select(F.col("g").alias("key"), "digest", F.lit("").alias("g")), "merkle-subroots")
    tops, stretches = sorted_stretches(roots, ["g"], ["key"], "merkle-groups")
    groups = stretches.agg(F.max("total")).first()[0]
    heads = placed(tops, stretches, ["g"]).select(
        "g", "place", F.col("total").alias("n"), F.struct("digest", "key").alias("node")
    )
    crown, last = _grow(heads, groups, fanout, "merkle-top")
    root = last.first()["digest"]  # one row
    start = _descend(crown, None, fanout, "merkle-top")
    if start is None:  # a lone group
        start = heads.withColumn("path", _no_path())
    known = stored(
        start.select(F.col("node.key").alias("g"), F.col("node.digest").alias("carry"), "path"), "merkle-paths"
    )
    lone = nodes.where("n = 1").join(known, "g").select("node", "carry", "path")
    below = _descend(levels, known, fanout, "merkle-path")
    found = lone if below is None else lone.unionByName(below.select("node", "carry", "path"))
    return found.select(
        "node.key", F.col("node.digest").alias("leaf"), "node.claim",
        F.col("carry").alias("subroot"), F.lit(root).alias("root"), "path",
    )


def folded_root(digest: Column, path: Column) -> Column:
    """The root that a digest and the siblings of a path give."""
    return F.aggregate(path, digest, lambda own, step: _hash([step["left"], own, step["right"]]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    told = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(told, "").cast("binary"), 256)
