"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target in words; a document of a source is taken ``target / size of
the source`` times on average: the whole part always, the fraction as a probability.
Method: the cube method (Deville and Tillé 2004).  Flight moves the fractional
probabilities of a few documents at a time along the null space of the two
constraints (words and documents taken), either way at random so that every
expectation stays, until one of them is 0 or 1.  Both totals are unchanged by every
step.  What cannot move on is a small landing problem.

In Spark a source is cut into blocks of consecutive places by size.  A block is flown in
one task and leaves ``LANDING`` documents undecided, its largest; those of many blocks make the
blocks of the next round, and the last block of a source is landed: of all ways to
round at most ``LANDING`` documents the one nearest to both totals is taken.  So a
source's words differ from its target by what that rounding leaves, and a source of any size never meets in one task.

The draw depends on places alone, so reruns agree.  Cases: null and empty texts have
size 0 and are never taken; a null source is a source, the last; rows with equal or null keys
are documents of their own; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.places import placed, sorted_stretches
from gleanset.llm.tables import small_enough, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BLOCK_ROWS = 2_000
LANDING = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fly(sizes: Sequence[float], shares: Sequence[float], leave: int, draw: np.random.Generator) -> list[float]:
    """Shares moved to 0 or 1, all but the last ``leave`` undecided (two at least); both totals stay.

    Three documents are in play at a time.  Their sizes and their number leave one
    direction in which neither total changes.
    """
    now = list(map(float, shares))
    queue = [i for i, share in enumerate(now) if 0.0 < share < 1.0]
    left = len(queue)
    leave = max(leave, 2)
    chances = draw.random(left).tolist()
    play: list[int] = []
    at = 0
    while left > leave:
        while len(play) < 3:
            play.append(queue[at])
            at += 1
        a, b, c = play
        way = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if way == (0, 0, 0):
            way = (1.0, -1.0, 0.0)
        ahead = back = float("inf")
        for i, w in zip(play, way):
            if w > 0:
                ahead, back = min(ahead, (1.0 - now[i]) / w), min(back, now[i] / w)
            elif w < 0:
                ahead, back = min(ahead, -now[i] / w), min(back, (now[i] - 1.0) / w)
        step = ahead if chances[left - 1] * (ahead + back) < back else -back
        still = []
        for i, w in zip(play, way):
            moved = now[i] + step * w
            now[i] = 0.0 if moved < 1e-9 else 1.0 if moved > 1.0 - 1e-9 else moved
            if 0.0 < now[i] < 1.0:
                still.append(i)
        if len(still) == 3:  # rounding alone kept the nearest one from its end
            near = min(play, key=lambda i: min(now[i], 1.0 - now[i]))
            now[near] = float(round(now[near]))
            still.remove(near)
        left -= 3 - len(still)
        play = still
    return now


def land(sizes: Sequence[float], shares: Sequence[float]) -> list[float]:
    """Undecided shares rounded, so that words and documents come nearest to their sums.

    Words come first: a document too many weighs as much as a hundredth of a mean one's words.
    Of equally good ways the first in binary order is taken.
    """
    now = list(map(float, shares))
    spots = [i for i, share in enumerate(now) if 0.0 < share < 1.0]
    if not spots:
        return now
    size = np.array([sizes[i] for i in spots], float)
    share = np.array([now[i] for i in spots])
    ways = (np.arange(1 << len(spots))[:, None] >> np.arange(len(spots))) & 1
    words = np.abs(ways @ size - share @ size) / max(size.mean(), 1.0)
    documents = np.abs(ways.sum(1) - share.sum())
    best = ways[np.argmin(words + documents / 100)]
    for i, taken in zip(spots, best.tolist(), strict=True):
        now[i] = float(taken)
    return now


def _settled(landing: int, seed: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        number, part, parts = (block.column(c)[0].as_py() for c in ("source_no", "block", "blocks"))
        sizes = block.column("size").to_numpy().astype(float).tolist()
        shares = block.column("share").to_pylist()
        draw = np.random.default_rng([seed, number, part, parts])
        shares = fly(sizes, shares, landing, draw)
        if parts == 1:
            shares = land(sizes, shares)
        spot = block.schema.get_field_index("share")
        return block.set_column(spot, block.schema.field(spot), pa.array(shares, pa.float64()))

    return run


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Targets of sources ``(source, source_size)``: weights in order of source share all words.

    A target stops at ``most`` times its source's size, and the excess is shared anew by
    weight.  What is not stopped has one amount per weight in the end, so a round is a sum over the sources.
    """
    told = totals.select(
        F.lit(0).alias("g"), F.col("source").isNull().alias("is_null"), "source", "source_size"
    )
    rows, stretches = sorted_stretches(told, ["g"], ["is_null", "source"], "mixing-sources")
    weight = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int"))
    known = placed(rows, stretches, ["g"]).select(
        F.col("place").alias("source_no"), "source", "source_size", weight.cast("double").alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("most"),
    )
    known = stored(known, "mixing-weights")
    all_words = known.agg(F.sum("source_size")).first()[0] or 0
    each, stopped = 0.0, -1
    while True:
        above = F.col("most") <= F.col("weight") * F.lit(each) if stopped >= 0 else F.lit(False)
        now = known.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if now["n"] == stopped or not now["weight"]:
            break
        each, stopped = (all_words - now["held"]) / now["weight"], now["n"]
    target = F.least(F.col("most"), F.col("weight") * F.lit(each))
    return known.select("source_no", "source", "source_size", target.alias("target"))


def mix(
    frame: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    *,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    block_rows: int = BLOCK_ROWS,
    landing: int = LANDING,
    seed: int = 13,
) -> DataFrame:
    """``key, size, source_size, target, copies, taken`` of every row: how often the mix takes it."""
    if block_rows < 2 * landing:
        raise ValueError("a block must hold at least two landings")
    sized = frame.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    # Stored first, since a sort by range reads its input twice.
    sized = stored(sized.withColumn("draw", F.xxhash64("key")), "mixing-words")
    rows, stretches = sorted_stretches(sized, ["source"], ["size", "draw", "key"], "mixing-sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(totals, weights, most), "mixing-targets")
    about = targets.withColumnRenamed("source", "_source")
    # Targets go to the stretches of a source, which are few, and with them to its rows.
    stretches = stretches.join(small_enough(about), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = placed(rows, stretches, ["source"]).select(
        "key", "source_no", "place", "size", "source_size", "target",
        F.floor(rate).cast("int").alias("base"),
        F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("share"),
        F.floor(F.col("place") / block_rows).cast("bigint").alias("block"),
        F.ceil(F.col("total") / block_rows).cast("bigint").alias("blocks"),
    )
    undecided = (F.col("share") > 0) & (F.col("share") < 1)
    pieces = planned.where(~undecided)
    open_rows = planned.where(undecided)
    most_rows = stretches.agg(F.max("total")).first()[0] or 0
    blocks = -(-most_rows // block_rows)
    merged = block_rows // landing
    while blocks:
        flown = stored(
            open_rows.groupBy("source_no", "block").applyInArrow(_settled(landing, seed), open_rows.schema),
            "mixing-flown",
        )
        pieces = pieces.unionByName(flown.where(~undecided))
        if blocks == 1:
            break
        blocks = -(-blocks // merged)
        open_rows = flown.where(undecided).withColumns({
            "block": F.floor(F.col("block") / merged).cast("bigint"),
            "blocks": F.ceil(F.col("blocks") / merged).cast("bigint"),
        })
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("share").cast("int")).otherwise(0)
    return pieces.select(
        F.col("key").alias(key), "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
