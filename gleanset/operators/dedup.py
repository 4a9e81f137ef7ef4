"""First-wins de-duplication on two keys, id and exact body, in row order.

A row is kept when neither its id nor its body belongs to a stored row or to an
earlier *kept* row.  A rejected row claims nothing, so one pass per key would be
wrong.  Seen as a graph whose vertices are ids and bodies and whose edges are
rows, the kept rows are the greedy maximal matching in row order; it is found in
rounds (Blelloch, Fineman, Shun, SPAA 2012): every row that comes first for both
its keys is kept, rows sharing a key with it go, and the rest meets again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.functions.values import EMPTY_DIGEST, body_digest
from gleanset.plans.durable import durable

# A key is hot when it seems to hold more rows than this and more than a thousandth
# of all rows.  So there are never more than some two thousand to broadcast.
HOT_ROWS = 100_000
HOT_SAMPLE_ROWS = 1_000_000

# Frames counted at or below this many rows (keys only) are broadcast.
BROADCAST_ROWS = 500_000

# Bits of the filter of keys that rows and a store share: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25
# Tasks over which rows of one key are dealt where they meet the shared keys.
SALTS = 16

# From this round on, chains of rows that wait for one another are settled in row order: first
# all components of at most SLICE_ROWS rows side by side, and then, of what is left, a slice of
# about SLICE_ROWS earliest rows per round, four times that at most, in one task.
SLICE_FROM_ROUND = 8
SLICE_ROWS = 300_000
SAMPLE_ROWS = 10_000
# Steps of labelling: components some hundred links wide are known by then, and wider ones stay open.
LABEL_STEPS = 8


def free_names(columns: Sequence[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that no column has, however its letters are cased."""
    taken = {c.lower() for c in columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        names.append(name)
    return names


def _private(prefix: str, place: Column, other: Column) -> Column:
    """A key for rows whose own key is blank: shared only by rows alike in order and other key."""
    told = F.to_json(F.struct(place.alias("place")), {"ignoreNullFields": "false"})
    return F.concat(F.lit("\u0000" + prefix), told, other)


def id_key(column: str = "id") -> Column:
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.when(value != "", value)


def text_key(column: str = "selftext", digest: str | None = None) -> Column:
    """Digest of a body, null where it is blank.

    ``digest`` names a column that holds it already, that of the empty text included; bodies are not read then.
    """
    if digest is not None:
        return F.when(F.col(digest) != EMPTY_DIGEST, F.col(digest))
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.when(value != "", body_digest(value))


def stored_keys(stored: DataFrame, digest: str | None = None) -> DataFrame:
    """Both keys of stored rows, null where blank; frames that hold the keys pass as they are."""
    if {"id_key", "text_key"} <= set(stored.columns):
        return stored.select("id_key", "text_key")
    return stored.select(id_key().alias("id_key"), text_key(digest=digest).alias("text_key"))


def existence_sets(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct non-blank ids, and digests of distinct non-blank bodies, of stored rows."""
    keys = stored_keys(stored)
    ids = keys.select("id_key").where("id_key is not null").distinct()
    texts = keys.select("text_key").where("text_key is not null").distinct()
    return ids, texts


def anti_id(rows: DataFrame, stored: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose id is blank or not stored.  Every key is salted, so ``hot_rows`` has no effect."""
    ids, _ = existence_sets(stored)
    return _anti(rows, id_key(), ids)


def anti_text(
    rows: DataFrame, stored: DataFrame, *, hot_rows: int = HOT_ROWS, digest: str | None = None
) -> DataFrame:
    """Rows whose body is blank or not stored, byte for byte; ``hot_rows`` as for :func:`anti_id`.

    ``digest`` names a column of the rows as for :func:`text_key`.
    """
    _, texts = existence_sets(stored)
    return _anti(rows, text_key(digest=digest), texts)


def _anti(rows: DataFrame, value: Column, taken: DataFrame) -> DataFrame:
    """Rows with a blank key and rows whose key is not taken; no job runs before an action.

    The keys that rows and store share are found from keys alone.  A bitmap of their hashes,
    of at most ``FILTER_BITS`` bits, is broadcast; rows whose bit is not set stay where they
    lie.  Only the others, nearly all of which go, meet the shared keys themselves in an
    anti-join, salted by task so that a key with very many rows is dealt to ``SALTS`` tasks.
    """
    key, maybe, salt = free_names(rows.columns, "_key", "_maybe", "_salt")
    keyed = rows.withColumn(key, value)
    shared = taken.toDF(key).join(keyed.select(key).distinct(), key, "left_semi")
    marked = _in_filter(keyed, shared, key, maybe)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    doubtful = marked.where(maybe).withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    fresh = doubtful.join(shared.withColumn(salt, salts), [key, salt], "left_anti")
    return marked.where(~F.col(maybe)).select(*rows.columns).unionByName(fresh.select(*rows.columns))


def _in_filter(rows: DataFrame, keys: DataFrame, key: str, mark: str) -> DataFrame:
    """The rows with a mark that is false only where ``key`` is null or certainly not in ``keys``."""
    place, number, bits = free_names([*rows.columns, mark], "_bit", "_bucket", "_bits")
    hashed = _bit(F.col(key))
    filters = _filter(keys.select(hashed.alias(place)), place, number, bits)
    named = rows.withColumn(place, F.when(F.col(key).isNotNull(), hashed))
    found = named.withColumn(number, F.bitmap_bucket_number(place)).join(F.broadcast(filters), number, "left")
    is_set = _is_set(F.col(bits), F.bitmap_bit_position(place))
    return found.withColumn(mark, F.coalesce(is_set, F.lit(False))).drop(place, number, bits)


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))


def _filter(places: DataFrame, place: str, number: str, bits: str) -> DataFrame:
    """Bitmaps of the places; one of the built-in functions has 32,768 bits, so there are at most FILTER_BITS / 32,768."""
    return places.groupBy(F.bitmap_bucket_number(place).alias(number)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bits)
    )


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1


def _near_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be among ``id_key`` of ``ids``, and those whose id is blank; no row is moved."""
    place, number, bits = free_names(rows.columns, "_bit", "_bucket", "_bits")
    blank = rows.sparkSession.range(1).select(F.lit("").alias("id_key"))
    marked = ids.select("id_key").unionByName(blank).select(_bit(F.col("id_key")).alias(place))
    filters = _filter(marked, place, number, bits)
    own = _bit(F.coalesce(F.col("id").cast("string"), F.lit("")))
    found = (F.bitmap_bucket_number(own) == F.col(number)) & _is_set(F.col(bits), F.bitmap_bit_position(own))
    return rows.join(F.broadcast(filters), found, "left_semi")


def _hot_sample(rows: DataFrame, total: int, hot_rows: int) -> tuple[DataFrame, int] | None:
    """Rows to find hot keys in, and the count there that makes a key hot; None if none can be.

    A sample is enough: which keys are treated as hot changes the work, never the
    result.  A key needs at least a two-thousandth of the sample, which bounds
    how many there are.
    """
    least = max(hot_rows, total // 1000)
    if total <= least:
        return None
    fraction = min(1.0, HOT_SAMPLE_ROWS / total)
    return durable(rows.sample(fraction)), max(1, int(least * fraction / 2))


def _hot_keys(sample: tuple[DataFrame, int] | None, key: str) -> DataFrame | None:
    """Keys with very many rows, or None."""
    if sample is None:
        return None
    rows, least = sample
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = durable(counts.where(F.col("n") > least).select(key))
    return hot if hot.take(1) else None


def _without(rows: DataFrame, taken: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Rows whose key is not taken.

    Rows of hot keys never meet in one task: they are tested where they lie
    against the few hot keys that are taken.
    """
    if hot is None:
        return rows.join(taken, key, "left_anti")
    few = F.broadcast(hot)
    taken_hot = taken.join(few, key, "left_semi").distinct()
    open_hot = hot.join(F.broadcast(taken_hot), key, "left_anti")
    in_hot = rows.join(F.broadcast(open_hot), key, "left_semi")
    in_cold = rows.join(few, key, "left_anti").join(taken, key, "left_anti")
    return in_hot.unionByName(in_cold)


def known_keys(rows: DataFrame, stored: DataFrame, digest: str | None = None) -> DataFrame:
    """The keys of ``stored`` that some of the rows have, kept: ``(id_key, text_key)``, one of them null.

    All that a later check of the same rows against the same store needs to know of it.
    ``digest`` names a column of the rows as for :func:`text_key`.
    """
    pairs = rows.select(id_key().alias("id_key"), text_key(digest=digest).alias("text_key"))
    ids, texts = _stored_near(stored, pairs, pairs.count())
    ids = ids.join(pairs.select("id_key").distinct(), "id_key", "left_semi")
    texts = texts.join(pairs.select("text_key").distinct(), "text_key", "left_semi")
    none = F.lit(None).cast("string")
    return durable(
        ids.select("id_key", none.alias("text_key")).unionByName(texts.select(none.alias("id_key"), "text_key"))
    )


def _stored_near(stored: DataFrame, rows: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Stored ids and body digests that can matter to these rows.

    Few rows against a large store: their keys are broadcast, and one scan of the
    store finds the known ones without moving it.
    """
    if total > BROADCAST_ROWS:
        return existence_sets(stored)
    tagged = F.explode(
        F.array(
            F.struct(F.lit("id").alias("kind"), F.col("id_key").alias("key")),
            F.struct(F.lit("text").alias("kind"), F.col("text_key").alias("key")),
        )
    )
    wanted = rows.select(tagged.alias("k")).select("k.*")
    known = durable(
        stored_keys(stored)
        .select(tagged.alias("k"))
        .select("k.*")
        .join(F.broadcast(wanted.distinct()), ["kind", "key"], "left_semi")
        .distinct()
    )
    ids = known.where("kind = 'id'").select(F.col("key").alias("id_key"))
    texts = known.where("kind = 'text'").select(F.col("key").alias("text_key"))
    return ids, texts


def _firsts(rows: DataFrame) -> DataFrame:
    """Rows that come first for their id and for their body; no group is ever gathered."""
    by_id = rows.groupBy("id_key").agg(F.min("ord").alias("ord"))
    by_text = rows.groupBy("text_key").agg(F.min("ord").alias("ord"))
    return by_id.join(by_text, "ord").select("id_key", "text_key", "ord")


def _keep_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one part after another, as ``part`` tells; a part is let go when the next begins."""
    ids: set = set()
    texts: set = set()
    now = None
    for batch in batches:
        kept = []
        for part, i, t in zip(batch["part"], batch["id_key"], batch["text_key"], strict=True):
            if part != now:
                now, ids, texts = part, set(), set()
            free = i not in ids and t not in texts
            if free:
                ids.add(i)
                texts.add(t)
            kept.append(free)
        yield batch.loc[kept, ["id_key", "text_key"]]


def _settle_in_order(rows: DataFrame) -> DataFrame:
    """Kept rows of every ``part``, whose rows lie together and in order."""
    kept = rows.select("part", "id_key", "text_key").mapInPandas(_keep_in_order, "id_key string, text_key string")
    return rows.join(kept, ["id_key", "text_key"], "left_semi").select("id_key", "text_key", "ord")


def _least_neighbour(pairs: DataFrame, own: bool) -> DataFrame:
    """Links ``(x, y)``, ``x > y``, of the ``b`` of every vertex ``a`` to the least of them all.

    With ``own``, ``a`` is linked as well; without it only those ``b`` that are larger than ``a``.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = pairs.join(least, "a")
    linked = (joined if own else joined.where("b > a")).select(F.col("b").alias("x"), F.col("m").alias("y"))
    if own:
        linked = linked.unionByName(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return linked.where("x > y").distinct()


def _labels(links: DataFrame, steps: int) -> DataFrame:
    """``(vertex, label)`` after some steps of alternating stars (Kiveris et al., SoCC 2014).

    Vertices with one label are connected.  Those without a row are their own label.
    """
    now = durable(links.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    for _ in range(steps):
        there, back = now.toDF("a", "b"), now.toDF("b", "a")
        large = _least_neighbour(there.unionByName(back), own=False)
        now = durable(_least_neighbour(large.toDF("a", "b"), own=True))
    return now.groupBy("x").agg(F.min("y").alias("label")).withColumnRenamed("x", "vertex")


def settle_components(rows: DataFrame, most_rows: int, steps: int = LABEL_STEPS) -> DataFrame:
    """Kept rows of all components that have at most ``most_rows`` rows and are known after some steps.

    Ids and bodies are vertices, by 64-bit hash; a collision joins components and changes no result,
    since a part of several is settled in row order too.  A label is a whole number of components
    when no row has an end outside it; labels with such rows are left for slices.
    """
    ends = rows.withColumns({
        "i": F.xxhash64(F.lit("id"), "id_key"), "t": F.xxhash64(F.lit("text"), "text_key"),
    })
    labels = durable(_labels(ends.select(F.col("i").alias("a"), F.col("t").alias("b")), steps))
    named = durable(
        ends.join(labels.toDF("i", "i_label"), "i", "left").join(labels.toDF("t", "t_label"), "t", "left")
        .select(
            "id_key", "text_key", "ord",
            F.coalesce("i_label", "i").alias("part"), F.coalesce("t_label", "t").alias("other"),
        )
    )
    crossing = named.where("part <> other").select(F.explode(F.array("part", "other")).alias("part")).distinct()
    small = named.groupBy("part").count().where(F.col("count") <= most_rows).select("part")
    whole = small.join(crossing, "part", "left_anti")
    # Many partitions, so that parts of the greatest size seldom share a task; a task holds one at a time.
    parts = named.join(whole, "part", "left_semi").repartition("part").sortWithinPartitions("part", "ord")
    return _settle_in_order(parts)


def _literal(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(value).cast(kind)


def _earliest(rows: DataFrame, total: int, slice_rows: int) -> DataFrame | None:
    """About the ``slice_rows`` earliest rows, or None if a sample misjudged their number.

    Any bound on the order is exact here; the sample only decides how far it reaches.
    """
    if total <= slice_rows:
        return rows
    sampled = rows.select("ord").sample(min(1.0, SAMPLE_ROWS / total))
    reach = max(1, min(SAMPLE_ROWS, total) * slice_rows // total)
    bound = sampled.orderBy("ord").limit(reach).agg(F.max("ord").alias("ord")).first()["ord"]
    if bound is None:
        return None
    earliest = rows.where(F.col("ord") <= _literal(bound, rows.schema["ord"].dataType))
    return earliest if earliest.count() <= 4 * slice_rows else None


def _settle_earliest(rows: DataFrame, total: int, slice_rows: int) -> DataFrame | None:
    """Kept rows among the earliest; later rows cannot change them."""
    earliest = _earliest(rows, total, slice_rows)
    if earliest is None:
        return None
    # A shuffle of the slice alone: coalescing would scan all rows in one task too.
    one_task = earliest.withColumn("part", F.lit(0)).repartition(1).sortWithinPartitions("ord")
    return _settle_in_order(one_task)


def kept_rows(
    keys: DataFrame,
    *,
    slice_from_round: int = SLICE_FROM_ROUND,
    slice_rows: int = SLICE_ROWS,
    hot_ids: DataFrame | None = None,
    hot_texts: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """Settle a durable key table ``(id_key, text_key, ord)``; also returns the rounds taken.

    Every round keeps at least the earliest row, so the loop ends; ``ord`` is unique.
    """
    rows = keys
    kept = None
    rounds = 0
    while total := rows.count():
        rounds += 1
        found = _firsts(rows)
        if rounds == slice_from_round and total > slice_rows:
            found = found.unionByName(settle_components(rows, slice_rows)).distinct()
        elif rounds >= slice_from_round:
            settled = _settle_earliest(rows, total, slice_rows)
            found = found if settled is None else found.unionByName(settled).distinct()
        found = durable(found)
        kept = found if kept is None else kept.unionByName(found)
        rest = _without(rows, found.select("id_key"), "id_key", hot_ids)
        rest = _without(rest, found.select("text_key"), "text_key", hot_texts)
        rows = durable(rest)
    return (keys.limit(0) if kept is None else kept), rounds


def ordered_dedup(
    rows: DataFrame,
    stored: DataFrame | None,
    order: Sequence[str],
    *,
    hot_rows: int = HOT_ROWS,
    slice_from_round: int = SLICE_FROM_ROUND,
    slice_rows: int = SLICE_ROWS,
    digest: str | None = None,
) -> DataFrame:
    """Rows that are new against ``stored`` and against earlier kept rows.

    ``rows`` has ``id`` and ``selftext``; so has ``stored``, or it has the keys
    (see :func:`stored_keys`).  ``order`` names the columns to order by, nulls
    first; rows that tie are ordered by id and then by body digest, blanks
    first.  Blank ids and blank bodies are never duplicates; a row blank in both
    is always kept.  Of rows alike in all of these one is kept.  ``digest``
    names a column of the rows as for :func:`text_key`.

    Keys travel, and bodies of the kept rows or, where those are most, of the
    rejected rows and of rows that occur more than once: whichever rows are fewer
    are looked for with a broadcast filter, and the others stay or go where they lie.
    """
    body = text_key(digest=digest)
    both_blank = id_key().isNull() & body.isNull()
    ord_, place, own_id, own_text = free_names(rows.columns, "ord", "place", "id_key", "text_key")
    named = rows.where(~both_blank).withColumn(place, F.struct(*order)).withColumns(
        {own_id: id_key(), own_text: body}
    ).withColumns({
        own_id: F.coalesce(own_id, _private("i", F.col(place), F.col(own_text))),
        own_text: F.coalesce(own_text, _private("t", F.col(place), F.col(own_id))),
    })
    ordinal = F.struct(
        F.col(place).alias("place"), F.col(own_id).alias("id_key"), F.col(own_text).alias("text_key")
    )
    ordered = named.withColumn(ord_, ordinal).drop(place, own_id, own_text)
    keyed = ordered.select(F.col(ord_).alias("ord")).select("ord", "ord.id_key", "ord.text_key")
    # Of rows alike in both keys only the first can be kept; copies fold before the shuffle.
    pairs = durable(
        keyed.groupBy("id_key", "text_key")
        .agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("copies"))
    )
    total = pairs.count()
    sample = _hot_sample(pairs.select("id_key", "text_key"), total, hot_rows)
    hot_ids = _hot_keys(sample, "id_key")
    hot_texts = _hot_keys(sample, "text_key")

    fresh = pairs.select("id_key", "text_key", "ord")
    if stored is not None:
        ids, texts = _stored_near(stored, pairs, total)
        fresh = _without(fresh, ids, "id_key", hot_ids)
        fresh = durable(_without(fresh, texts, "text_key", hot_texts))

    kept, _ = kept_rows(
        fresh,
        slice_from_round=slice_from_round,
        slice_rows=slice_rows,
        hot_ids=hot_ids,
        hot_texts=hot_texts,
    )
    chosen = kept.select(F.col("ord").alias(ord_))
    if 2 * kept.count() <= total:
        parts, near = [], _near_ids(ordered, kept)
    else:
        # A row of no pair that is rejected or occurs more than once is kept where it lies.
        key, maybe = free_names(ordered.columns, "_key", "_maybe")
        others = pairs.where("copies > 1").select("ord").unionByName(
            pairs.select("ord").join(kept.select("ord"), "ord", "left_anti")
        )
        named_by = [F.struct(F.col(o)["id_key"], F.col(o)["text_key"]).alias(key) for o in (ord_, "ord")]
        marked = _in_filter(ordered.select("*", named_by[0]), others.select(named_by[1]), key, maybe)
        parts, near = [marked.where(~F.col(maybe)).select(*ordered.columns)], marked.where(maybe).select(*ordered.columns)
    if total <= BROADCAST_ROWS:
        repeated = pairs.where("copies > 1").select(F.col("ord").alias(ord_))
        once, several = (F.broadcast(chosen.join(repeated, ord_, how)) for how in ("left_anti", "left_semi"))
        parts += [near.join(once, ord_, "left_semi"), near.join(several, ord_, "left_semi").dropDuplicates([ord_])]
    else:
        parts.append(near.join(chosen, ord_, "left_semi").dropDuplicates([ord_]))
    fresh = parts[0]
    for part in parts[1:]:
        fresh = fresh.unionByName(part)
    return fresh.drop(ord_).unionByName(rows.where(both_blank))
