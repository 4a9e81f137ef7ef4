"""Near-duplicate embeddings by a forest of random-projection trees.

Trees split by random directions at medians; vectors in the middle tenth of a split go to
both sides.  The upper levels are fitted on a bounded sample and broadcast; leaves that
are still large are split on in the same way inside their task.  Vectors are compared
within leaves only, in double precision, and pairs found in several trees count once.

Equal vectors are folded into one node with the number of their ids as its weight, so a
hot vector is placed and compared once.  An id with several vectors is a node by itself.

A dense group would fill a leaf in every tree.  So pivots of dense groups are found first:
in a bounded sample of all nodes, drawn by hash, and then in a sample of each leaf of one tree,
which shows groups that hold more of a leaf than can be split or compared.  Members within
half the linking angle of a pivot are linked with each other by
the triangle inequality, and are counted, not compared.  In a leaf they are compared only with
vectors outside their group, in as many parts as their number asks for.  Pivots are so far apart
that members of two groups cannot be linked.

Cases: null or zero vectors, and vectors with null or non-finite components, are linked with
nothing; so are rows without an id, whose component is null.  Vectors of different lengths, of which
there may be any number, are not compared.  Rows that share an id count as one vertex.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanset.llm.components import components
from gleanset.llm.tables import small_enough, stored

MIN_COSINE = 0.95
TREES = 8
LEAF_VECTORS = 400
# Documented bound of the sample that trees are fitted on, and of its part for pivots.
SAMPLE_VECTORS = 65_536
PIVOT_SAMPLE = 8_192
PIVOT_NEIGHBOURS = 12
# Vectors a leaf's sample is cut to, and pivots compared with at a time.
LEAF_SAMPLE = 1_024
PIVOTS_AT_A_TIME = 4_096
OVERLAP = 0.1
# Members of dense groups in one part of a leaf.
PART_VECTORS = 4_000


@dataclass(frozen=True)
class Forest:
    """Directions and the two bounds of every inner node, per tree and level."""

    directions: np.ndarray  # trees, levels, dimensions
    low: list[list[np.ndarray]]
    high: list[list[np.ndarray]]

    def leaves(self, vectors: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and leaves of the vectors; a row has several leaves where splits overlap."""
        rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for level, direction in enumerate(self.directions[tree]):
            at = (vectors @ direction)[rows]
            left = at <= self.high[tree][level][nodes]
            right = at >= self.low[tree][level][nodes]
            rows = np.concatenate([rows[left], rows[right]])
            nodes = np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
        return rows, nodes


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; the largest component is scaled first."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _directions(shape: tuple[int, ...], seed: int) -> np.ndarray:
    drawn = np.random.default_rng(seed).standard_normal(shape)
    return drawn / np.linalg.norm(drawn, axis=-1, keepdims=True)


def _bounds(values: np.ndarray) -> tuple[float, float]:
    low, high = np.quantile(values, [0.5 - OVERLAP / 2, 0.5 + OVERLAP / 2])
    return float(low), float(high)


def fit_forest(sample: np.ndarray, total: int, trees: int, leaf: int, seed: int = 7) -> Forest:
    """Levels until leaves hold about ``leaf`` of ``total`` vectors, or 16 of the sample."""
    levels = 0
    if len(sample):
        levels = max(0, math.ceil(math.log2(max(1, total) / leaf)))
        levels = min(levels, max(0, int(math.log2(len(sample) / 16))))
    directions = _directions((trees, levels, sample.shape[1]), seed)
    forest = Forest(directions, [], [])
    for tree in range(trees):
        nodes = np.zeros(len(sample), np.int64)
        low, high = [], []
        for level in range(levels):
            at = sample @ directions[tree, level]
            lows, highs, middles = (np.zeros(1 << level) for _ in range(3))
            for node in range(1 << level):
                inside = at[nodes == node]
                if len(inside):
                    lows[node], highs[node] = _bounds(inside)
                    middles[node] = np.median(inside)
            low.append(lows)
            high.append(highs)
            nodes = 2 * nodes + (at > middles[nodes])
        forest.low.append(low)
        forest.high.append(high)
    return forest


def find_pivots(sample: np.ndarray, min_cosine: float, least: int = PIVOT_NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample with many others within half the linking angle, far from each other, and how many."""
    reach = _half(min_cosine)
    many = np.zeros(len(sample), np.int64)
    for at in range(0, len(sample), 1024):
        many[at : at + 1024] = (sample[at : at + 1024] @ sample.T >= reach).sum(1) - 1
    crowded = np.flatnonzero(many >= least)
    crowded = crowded[np.argsort(-many[crowded], kind="stable")]
    chosen = crowded[far_apart(sample[crowded], sample[:0], min_cosine)]
    return sample[chosen], many[chosen]


def far_apart(candidates: np.ndarray, pivots: np.ndarray, min_cosine: float) -> list[int]:
    """The candidates, first come first, that are too far from all pivots and each other to have linked members."""
    apart = math.cos(2 * math.acos(min_cosine)) - 1e-6
    chosen: list[int] = []
    near = np.zeros(len(candidates), bool)
    for at in range(0, len(pivots), PIVOTS_AT_A_TIME):
        near |= (candidates @ pivots[at : at + PIVOTS_AT_A_TIME].T >= apart).any(1)
    for i in range(len(candidates)):
        if not near[i]:
            chosen.append(i)
            near |= candidates @ candidates[i] >= apart
    return chosen


def _balls(vectors: np.ndarray, pivots: np.ndarray, min_cosine: float) -> np.ndarray:
    """The pivot within half the linking angle of each vector, or -1."""
    ball, closest = np.full(len(vectors), -1, np.int64), np.full(len(vectors), _half(min_cosine))
    for at in range(0, len(pivots), PIVOTS_AT_A_TIME):
        near = vectors @ pivots[at : at + PIVOTS_AT_A_TIME].T
        best = near.argmax(1)
        value = near[np.arange(len(vectors)), best]
        ball, closest = np.where(value >= closest, best + at, ball), np.maximum(value, closest)
    return ball


def _half(min_cosine: float) -> float:
    return math.cos(math.acos(min_cosine) / 2) + 1e-9


def _compare(a: np.ndarray, b: np.ndarray, min_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(a), 1024):
        i, j = np.nonzero(a[at : at + 1024] @ b.T >= min_cosine)
        yield i + at, j


def leaf_pairs(
    vectors: np.ndarray, dense: np.ndarray, first_part: bool, min_cosine: float,
    leaf: int = LEAF_VECTORS, seed: int = 1,
) -> np.ndarray:
    """Row pairs that reach the cosine: others with others (in the first part), others with dense."""
    found: list[np.ndarray] = []

    def visit(rows: np.ndarray, depth: int) -> None:
        others = rows[~dense[rows]]
        if not len(others):
            return
        if len(others) > leaf:
            direction = _directions((vectors.shape[1],), seed * 1000 + depth)
            at = vectors[rows] @ direction
            low, high = _bounds(at[~dense[rows]])
            left, right = rows[at <= high], rows[at >= low]
            if max(np.count_nonzero(~dense[left]), np.count_nonzero(~dense[right])) < 0.8 * len(others):
                visit(left, depth + 1)
                visit(right, depth + 1)
                return
        own, group = vectors[others], rows[dense[rows]]
        if first_part:
            for i, j in _compare(own, own, min_cosine):
                keep = i < j
                found.append(np.stack([others[i[keep]], others[j[keep]]], 1))
        for i, j in _compare(own, vectors[group], min_cosine):
            found.append(np.stack([others[i], group[j]], 1))

    visit(np.arange(len(vectors)), 0)
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _usable(frame: DataFrame, key: str, vector: str) -> DataFrame:
    clean = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    values = F.col(vector).cast("array<double>")
    return (
        frame.where(F.col(key).isNotNull() & clean & F.exists(F.col(vector), lambda x: x != 0))
        .select(F.col(key).cast("bigint").alias("id"), values.alias("v"))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return unit(np.stack(column.to_numpy()).astype(np.float64))


def _folded(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id, v)`` of different vectors, and members ``(id, node)``.

    A node is named by the least id of its equal vectors.  Ids with several vectors keep a node
    of their own with all of these, so a name stands for the same ids wherever it occurs.
    """
    coded = usable.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))
    known = stored(coded.select("id", "h1", "h2").distinct(), "vector-digests")
    several = stored(known.groupBy("id").count().where("count > 1").select("id", F.col("id").alias("own")), "vector-ids")
    tagged = coded.join(small_enough(several), "id", "left")
    nodes = stored(
        tagged.groupBy("own", "h1", "h2").agg(F.min("id").alias("id"), F.any_value("v").alias("v"))
        .select("id", "v", "own", "h1", "h2"), "vector-nodes",
    )
    names = nodes.where("own is null").select("h1", "h2", F.col("id").alias("node"))
    members = (
        known.join(several, "id", "left_anti").join(names, ["h1", "h2"]).select("id", "node")
        .unionByName(several.select("id", F.col("own").alias("node")))
    )
    return nodes.select("id", "v"), stored(members, "vector-members")


def _leaf_pivots(
    rows: DataFrame, total: int, forest: Forest, pivots: np.ndarray, min_cosine: float, leaf: int
) -> np.ndarray:
    """Further pivots: centres of groups with so many vectors in a leaf of the first tree that they fill half of one.

    Medians cut a group of many leaves' size, so some leaf is filled by it, however many vectors there are.
    """
    levels = len(forest.directions[0])
    share = min(1.0, LEAF_SAMPLE * (1 << levels) / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 30)) < int((1 << 30) * share))
    shared = rows.sparkSession.sparkContext.broadcast((forest, pivots))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, pivots = shared.value
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.iloc[at : at + 2000]
                vectors = _matrix(some["v"])
                lone = np.flatnonzero(_balls(vectors, pivots, min_cosine) < 0)
                held, nodes = forest.leaves(vectors[lone], 0)
                yield pd.DataFrame({"node": nodes, "v": some["v"].to_numpy()[lone[held]]})

    def crowded(group: pd.DataFrame) -> pd.DataFrame:
        # In an order that does not depend on the tasks the rows came from.
        vectors = _matrix(group["v"])
        vectors = vectors[np.lexsort(vectors.T[:3])]
        size = len(vectors)
        if size > 4 * LEAF_SAMPLE:
            vectors = vectors[np.random.default_rng(5).permutation(size)[: 4 * LEAF_SAMPLE]]
        scale = size / len(vectors) / share
        found, many = find_pivots(vectors, min_cosine, max(PIVOT_NEIGHBOURS, math.ceil(leaf / 2 / scale)))
        return pd.DataFrame({"v": pd.Series(list(found), dtype=object), "many": (many * scale).astype(np.int64)})

    found = (
        drawn.mapInPandas(place, "node bigint, v array<double>")
        .groupBy("node").applyInPandas(crowded, "v array<double>, many bigint").toPandas()
    )
    if not len(found):
        return pivots
    candidates = np.stack(found["v"].to_numpy()).astype(np.float64)
    order = np.lexsort((candidates[:, 0], -found["many"].to_numpy()))
    candidates = candidates[order]
    return np.concatenate([pivots, candidates[far_apart(candidates, pivots, min_cosine)]])


def _length_links(rows: DataFrame, total: int, min_cosine: float, trees: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` and members ``(id, ball)`` among vectors of one length."""
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    share = int((1 << 30) * min(1.0, SAMPLE_VECTORS / total))
    drawn = rows.where(draw < share).select("v", F.xxhash64("id", F.lit(1)).alias("rank"))
    drawn = drawn.limit(2 * SAMPLE_VECTORS).toPandas()
    # By hash, so that any part of the sample is a sample too.
    drawn = drawn.sort_values("rank", kind="stable")
    # A table of equal draws may leave the sample empty; then there is one leaf.
    sample = _matrix(drawn["v"]) if len(drawn) else np.zeros((0, 1))
    forest = fit_forest(sample, total, trees if len(sample) else 1, leaf)
    pivots, _ = find_pivots(sample[:PIVOT_SAMPLE], min_cosine)
    if len(sample):
        pivots = _leaf_pivots(rows, total, forest, pivots, min_cosine, leaf)
    shared = rows.sparkSession.sparkContext.broadcast((forest, pivots))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, pivots = shared.value
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.iloc[at : at + 2000]
                vectors = _matrix(some["v"])
                ball = _balls(vectors, pivots, min_cosine)
                for tree in range(len(forest.low)):
                    held, nodes = forest.leaves(vectors, tree) if len(forest.directions[tree]) else (
                        np.arange(len(some)), np.zeros(len(some), np.int64))
                    yield pd.DataFrame({
                        "tree": tree, "node": nodes, "id": some["id"].to_numpy()[held],
                        "ball": ball[held], "v": some["v"].to_numpy()[held],
                    })

    placed = stored(
        rows.mapInPandas(place, "tree int, node bigint, id bigint, ball bigint, v array<double>"), "leaves"
    )
    balls = placed.where("tree = 0 and ball >= 0").select("id", "ball").distinct()
    sizes = placed.groupBy("tree", "node").agg(
        F.count_if(F.col("ball") >= 0).alias("dense"), F.count_if(F.col("ball") < 0).alias("others")
    )
    parts = F.greatest(F.lit(1), F.ceil(F.col("dense") / PART_VECTORS)).cast("int")
    # A leaf without vectors outside dense groups has nothing to compare.
    sizes = stored(sizes.where("others > 0").select("tree", "node", parts.alias("parts")), "leaf-sizes")
    dealt = placed.join(sizes, ["tree", "node"]).withColumn(
        "part",
        F.explode(
            F.when(F.col("ball") < 0, F.sequence(F.lit(0), F.col("parts") - 1))
            .otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))
        ),
    )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = group["id"].to_numpy()
        pairs = leaf_pairs(
            _matrix(group["v"]), group["ball"].to_numpy() >= 0, key[2] == 0, min_cosine, leaf, 1 + key[0]
        )
        a, b = ids[pairs[:, 0]], ids[pairs[:, 1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    pairs = dealt.groupBy("tree", "node", "part").applyInPandas(compare, "a bigint, b bigint")
    return pairs.where("a <> b").distinct(), balls


def _few_links(usable: DataFrame, lengths: DataFrame, min_cosine: float, leaf: int) -> DataFrame:
    """Pairs ``(a, b)`` among vectors of the lengths that have no more than a leaf's number, any number of lengths."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = group["id"].to_numpy(), _matrix(group["v"])
        pairs = leaf_pairs(vectors, np.zeros(len(ids), bool), True, min_cosine, leaf)
        a, b = ids[pairs[:, 0]], ids[pairs[:, 1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    few = usable.withColumn("n", F.size("v")).join(lengths.select("n"), "n", "left_semi")
    return few.groupBy("n").applyInPandas(compare, "a bigint, b bigint").where("a <> b").distinct()


def near_vectors(
    frame: DataFrame, key: str = "vec_id", vector: str = "embedding",
    *, min_cosine: float = MIN_COSINE, trees: int = TREES, leaf: int = LEAF_VECTORS,
) -> DataFrame:
    """One row per vector: its key, ``n_links``, ``component_id`` and ``kept``."""
    spark = frame.sparkSession
    usable, folded = _folded(_usable(frame, key, vector))
    lengths = stored(usable.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("many")), "lengths")
    pairs = _few_links(usable, lengths.where(F.col("many") <= leaf), min_cosine, leaf)
    members = spark.createDataFrame([], "id bigint, ball string")
    # Lengths of more vectors than a leaf holds have a forest each.
    lengths = lengths.where(F.col("many") > leaf).orderBy("n").collect()
    for row in lengths:
        some = usable.where(F.size("v") == row["n"])
        found, balls = _length_links(some, row["many"], min_cosine, trees, leaf)
        pairs = pairs.unionByName(found)
        members = members.unionByName(
            balls.select("id", F.concat_ws("-", F.lit(row["n"]), "ball").alias("ball"))
        )
    pairs = stored(pairs, "vector-pairs")
    weights = stored(folded.groupBy("node").agg(F.count(F.lit(1)).alias("weight")), "node-weights")
    weighted = members.join(weights, F.col("id") == F.col("node")).drop("node")
    sizes = weighted.groupBy("ball").agg(
        F.sum("weight").alias("size"), F.min("id").alias("least")
    )
    # There are at most as many dense groups as pivots, which are on the driver.
    dense = stored(weighted.join(F.broadcast(sizes), "ball"), "dense-members")
    edges = pairs.unionByName(dense.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")))
    linked = components(edges)
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Ids linked with a node: the members of its neighbours, and of its dense group or itself but one.
    direct = (
        ends.join(weights, F.col("b") == F.col("node")).select(F.col("a").alias("id"), F.col("weight").alias("n"))
        .unionByName(dense.select("id", (F.col("size") - F.col("weight")).alias("n")))
        .unionByName(weights.select(F.col("node").alias("id"), (F.col("weight") - 1).alias("n")))
        .groupBy("id").agg(F.sum("n").alias("n"))
    )
    # Stored first: Spark splits a join's large key only where both sides come from a shuffle.
    told = stored(direct.join(linked, "id", "left").select(
        F.col("id").alias("node"), F.coalesce("component", "id").alias("component"), "n"), "node-links")
    found = folded.join(told, "node").select("id", "component", "n")
    answer = (
        frame.select(F.col(key).cast("bigint").alias("id"))
        .join(found, "id", "left")
    )
    component = F.coalesce("component", "id")
    return answer.select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
