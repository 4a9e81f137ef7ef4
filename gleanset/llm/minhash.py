"""Near-duplicate texts by fast similarity sketches, banding, and exact verification.

Sketch (Dahlgaard, Knudsen, Thorup, FOCS 2017): in round ``r`` every shingle is hashed
to a bin and a value ``r + fraction``; a bin keeps its least value, and rounds go on until
all bins are filled.  Rounds from ``bins`` on fill one certain bin each, so every bin is
filled after twice as many rounds at the latest.  Equal bins estimate the Jaccard
similarity with the concentration of independent draws, at a cost that does not grow with the bins.

Texts with equal shingle sets form a class, and only classes go on.  Classes that agree
in a band meet in a bucket; of buckets with the same classes one stays.  Every class is compared,
on full sets, with the least ones of its buckets, one first and then four more.
Buckets that still hold different components are dealt into blocks of a bounded number of
shingles.  A task has two blocks (or one twice) and compares, on full sets, the classes that are
in different components; main component and main component never meet.  So no two classes of a
bucket remain uncompared unless they are in one component, no pair is written out
but for links, and a task's memory depends on no bucket's size.

With the defaults a pair of similarity 0.8 shares no band with a probability of 3e-6.

Cases: texts without words (null, empty, blank) have an empty set and are linked with
nothing.  Texts of fewer words than a shingle have their whole sequence as their one
shingle.  Rows without a key are linked with nothing; their component is null.  Rows that
share a key count as one vertex, also if their texts differ.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanset.llm.components import components
from gleanset.llm.tables import releasing, small_enough, stored
from gleanset.llm.words import Words, batch_words, mix, range_hashes, slices
from gleanset.plans.durable import durable

BINS = 256
BAND_ROWS = 6
# How many of the least classes of its buckets a class is compared with, before buckets are looked at whole.
STAR_WIDTHS = (1, 4)
# Shingles of a block, so that a task that compares two of them holds some 16 MB (or one longest text more).
BLOCK_SHINGLES = 1 << 20
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the offsets of the texts."""
    counts = words.counts()
    many = np.repeat(np.maximum(counts - size + 1, 0), 1)
    short = (counts > 0) & (counts < size)
    many[short] = 1
    text_of = np.repeat(np.arange(len(counts)), many)
    begin = np.arange(len(text_of)) - np.repeat(np.cumsum(many) - many, many) + words.first[:-1][text_of]
    end = np.minimum(begin + size, words.first[1:][text_of])
    hashes = range_hashes(words.hashes, begin, end)
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    hashes, text_of = hashes[fresh], text_of[fresh]
    return hashes, np.searchsorted(text_of, np.arange(len(counts) + 1))


def sketches(values: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per set; rows of empty sets stay unfilled.  ``bins`` is a power of two."""
    count = len(offsets) - 1
    out = np.full(count * bins, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    for turn in range(2 * bins):
        if not len(values):
            break
        drawn = mix(values + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64))
        where = (drawn & np.uint64(bins - 1)).astype(np.int64) if turn < bins else turn - bins
        found = np.uint64(turn << 48) | (drawn >> np.uint64(16))
        np.minimum.at(out, owner * bins + where, found)
        unfilled = (out.reshape(count, bins) == _EMPTY).any(1)[owner]
        values, owner = values[unfilled], owner[unfilled]
    return out.reshape(count, bins)


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` bins."""
    bands = sketch.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), bands)).copy()
    parts = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    for i in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def _digests(values: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Size and 128-bit digest ``n, h1, h2`` of each set."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(0x5BF03635)), out=sums[1:])
    return [
        pa.array(np.diff(offsets)),
        pa.array(range_hashes(values, offsets[:-1], offsets[1:]).view(np.int64)),
        pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)),
    ]


def _signatures(texts: DataFrame, size: int) -> DataFrame:
    """Key, set size, 128-bit digest of the set, and bands of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = shingle_sets(batch_words(batch, "text", lower=True), size)
            keys = band_keys(sketches(values, offsets))
            bands = pa.FixedSizeListArray.from_arrays(
                pa.array(keys.view(np.int64).ravel()), keys.shape[1]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *_digests(values, offsets), bands.cast(pa.list_(pa.int64()))],
                ["key", "n", "h1", "h2", "bands"],
            )

    return texts.mapInArrow(releasing(run), "key bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = shingle_sets(batch_words(batch, "text", lower=True), size)
            made = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(values.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([*_digests(values, offsets), made], ["n", "h1", "h2", "shingles"])

    return texts.mapInArrow(releasing(run), "n bigint, h1 bigint, h2 bigint, shingles array<bigint>")


def _classes(usable: DataFrame) -> DataFrame:
    """One row per set: ``n, h1, h2``, its ``least`` key, its name ``rep``, and bands.

    The name is the least key that has no other set.  A set whose keys all have others too
    is named by a number that is neither a key nor another set's name.
    """
    known = usable.select("key", "n", "h1", "h2").distinct()
    several = stored(known.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("several")), "shared-keys")
    named = usable.join(small_enough(several), "key", "left")
    classes = stored(
        named.groupBy("n", "h1", "h2")
        .agg(F.min("key").alias("least"), F.min(F.when(F.col("several").isNull(), F.col("key"))).alias("rep"),
             F.min_by("bands", "key").alias("bands")), "classes"
    )
    unnamed = classes.where("rep is null").select("n", "h1", "h2")
    many = unnamed.count()
    if not many:
        return classes
    keys = usable.select("key")
    for salt in range(64):
        number = F.xxhash64(F.lit(salt), "n", "h1", "h2")
        drawn = unnamed.select(number.alias("key")).distinct()
        if drawn.count() == many and not drawn.join(keys, "key", "left_semi").take(1):
            return stored(classes.withColumn("rep", F.coalesce("rep", number)), "named-classes")
    raise RuntimeError("no free names for sets of shared keys")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have at least this similarity, counted on full sets."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(right, "b").join(left, "a").where(100 * common >= percent * union).select("a", "b")


def _other_component(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    for end in ("a", "b"):
        own = found.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a <> of_b").select("a", "b")


def _size_allows(percent: int) -> Column:
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _links(texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links ``(a, b)`` between classes, enough to connect all that belong together."""
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    least = (
        rows.groupBy("bucket")
        .agg(F.min(F.struct("rep", "n")).alias("least"), F.count(F.lit(1)).alias("many"),
             F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("s1"),
             F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"))
        .where("many > 1")
        .groupBy("many", "s1", "s2", "least").agg(F.min("bucket").alias("bucket"))  # the same classes
        .select("bucket", "least")
    )
    # Stored first: Spark splits a join's large key only where both sides come from a shuffle.
    least = stored(least, "bucket-least")
    members = stored(rows.join(least, "bucket"), "bucket-members")
    star = stored(
        members.select(F.col("least.rep").alias("a"), F.col("rep").alias("b"),
                       F.col("least.n").alias("na"), F.col("n").alias("nb"))
        .where(F.col("a") != F.col("b")).where(_size_allows(percent)).select("a", "b").distinct(),
        "bucket-stars",
    )
    wanted = stored(
        members.select("rep").distinct().join(classes.select("rep", "least", "n", "h1", "h2"), "rep"), "bucket-classes"
    )
    carriers = wanted.select(F.col("least").alias("key")).distinct()
    chosen = texts.where("key is not null").join(small_enough(carriers), "key", "left_semi")
    names = wanted.select("n", "h1", "h2", F.col("rep").alias("key"))
    # A key may have several sets: the digest tells whose set it is.
    sets = _sets(chosen, size).dropDuplicates(["n", "h1", "h2"]).join(names, ["n", "h1", "h2"])
    sets = stored(sets.select("key", "shingles"), "shingle-sets")
    links = tested = star.limit(0)

    # Each class with the least of its buckets: with one of them first, then with four more.
    for width in STAR_WIDTHS:
        found = durable(components(links))
        apart = _other_component(star, found).join(tested, ["a", "b"], "left_anti")
        place = F.row_number().over(Window.partitionBy("b").orderBy("a"))
        pairs = stored(apart.withColumn("place", place).where(F.col("place") <= width).select("a", "b"), "star-pairs")
        if not pairs.take(1):
            break
        tested = tested.unionByName(pairs)
        links = stored(links.unionByName(_similar(pairs, sets, percent)), "links")

    # Buckets that still hold several components.
    component = durable(components(links)).select(F.col("id").alias("rep"), "component")
    placed = (
        members.select("bucket", "rep", "n").join(component, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    split = durable(
        placed.groupBy("bucket")
        .agg(F.min("component").alias("main"), F.max("component").alias("last"))
        .where("main <> last").select("bucket", "main")
    )
    placed = stored(
        placed.join(split, "bucket").withColumn("is_main", F.col("component") == F.col("main")).drop("main"),
        "split-buckets",
    )

    def compare(group: pa.Table) -> pa.Table:
        return _links_between_blocks(group, percent)

    within = (
        _meetings(placed).join(sets.select(F.col("key").alias("rep"), "shingles"), "rep")
        .groupBy("bucket", "i", "j").applyInArrow(compare, "a bigint, b bigint")
    )
    return links.unionByName(within.distinct())


def _meetings(placed: DataFrame) -> DataFrame:
    """Members of buckets, once for each pair of blocks ``(i, j)`` that they take part in.

    Blocks ``0:others`` hold what is outside the main component, and blocks from there
    on what is inside; a bucket of few shingles is one block.
    """
    weight = F.sum("n")
    many = lambda inside: F.ceil(F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES)
    blocks = durable(
        placed.groupBy("bucket")
        .agg(weight.alias("weight"), many(~F.col("is_main")).alias("others"), many(F.col("is_main")).alias("mains"))
        .select(
            "bucket",
            F.when(F.col("weight") <= BLOCK_SHINGLES, 1).otherwise(F.col("others")).cast("int").alias("others"),
            F.when(F.col("weight") <= BLOCK_SHINGLES, 0).otherwise(F.col("mains")).cast("int").alias("mains"),
        )
    )
    dealt = F.xxhash64("rep")
    block = F.when(F.col("is_main") & (F.col("mains") > 0), F.col("others") + F.pmod(dealt, F.greatest("mains", F.lit(1))))
    block = block.otherwise(F.pmod(dealt, F.col("others"))).cast("int")
    last = F.when(F.col("block") < F.col("others"), F.col("others") + F.col("mains") - 1).otherwise(F.col("others") - 1)
    pairs = F.transform(
        F.sequence(F.lit(0), last),
        lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j")),
    )
    return (
        placed.join(blocks, "bucket").withColumn("block", block)
        .select("bucket", "rep", "component", "is_main", "block", F.explode(pairs).alias("pair"))
        .select("bucket", "pair.i", "pair.j", "rep", "component", "is_main", "block")
    )


def _links_between_blocks(group: pa.Table, percent: int) -> pa.Table:
    """Links ``(a, b)`` that join the components of two blocks, or of one, on full sets."""
    group = group.sort_by([("block", "ascending"), ("is_main", "ascending"), ("rep", "ascending")])
    rep, component, block = (group.column(c).to_numpy().copy() for c in ("rep", "component", "block"))
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    shingles = group.column("shingles").combine_chunks()
    size = shingles.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(size) - size
    known, place = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
    mark = np.zeros(len(known), np.int8)
    centers = np.flatnonzero((block == i) & ~group.column("is_main").to_numpy())
    links: list[tuple[np.ndarray, np.ndarray]] = []
    for c in centers:
        begin = c + 1 if i == j else int(np.searchsorted(block, j))
        fits = 100 * np.minimum(size[begin:], size[c]) >= percent * np.maximum(size[begin:], size[c])
        others = np.flatnonzero(fits & (component[begin:] != component[c])) + begin
        if not len(others):
            continue
        own = place[first[c] : first[c] + size[c]]
        mark[own] = 1
        much = size[others]
        if 3 * much.sum() > len(place) - first[begin]:
            counted = np.add.reduceat(mark[place[first[begin] :]], first[begin:] - first[begin], dtype=np.int64)
            common = counted[others - begin]
        else:
            starts = np.cumsum(much) - much
            at = np.arange(much.sum()) + np.repeat(first[others] - starts, much)
            common = np.add.reduceat(mark[place[at]], starts, dtype=np.int64)
        mark[own] = 0
        near = others[100 * common >= percent * (size[c] + much - common)]
        joined, one_of = np.unique(component[near], return_index=True)
        if len(joined):
            links.append((np.full(len(joined), rep[c]), rep[near[one_of]]))
            component[np.isin(component, joined)] = component[c]
    ends = [np.concatenate(x) for x in zip(*links)] or [np.zeros(0, np.int64)] * 2
    return pa.table({"a": ends[0], "b": ends[1]})


def near_duplicates(
    texts: DataFrame, key: str = "doc_id", text: str = "text",
    *, shingle_words: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per text: its key, ``n_shingles``, ``component_id`` (least key reachable) and ``kept``."""
    named = texts.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    signed = stored(_signatures(named, shingle_words), "signatures")
    usable = signed.where("key is not null and n > 0")
    classes = _classes(usable)
    links = _links(named, classes, shingle_words, percent)
    names = classes.where("rep <> least").select("rep", "least")
    for end in ("a", "b"):
        own = names.select(F.col("rep").alias(end), "least")
        links = links.join(own, end, "left").withColumn(end, F.coalesce("least", end)).select("a", "b")
    copies = usable.join(classes.select("n", "h1", "h2", "least"), ["n", "h1", "h2"]).where("key <> least")
    linked = components(links.unionByName(copies.select(F.col("least").alias("a"), F.col("key").alias("b"))))
    answer = signed.select("key", "n").join(
        linked.select(F.col("id").alias("key"), "component"), "key", "left"
    )
    component = F.coalesce("component", "key")
    return answer.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


def keep_one(texts: DataFrame, key: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """The texts without the copies: of each group the one with the least key stays."""
    judged = near_duplicates(texts, key, text, **how)
    copies = judged.where(~F.col("kept")).select(key).distinct()
    return texts.join(small_enough(durable(copies)), key, "left_anti")
