import random

import pytest
from pyspark.sql import functions as F

from gleanset.functions.values import EMPTY_DIGEST, body_digest
from gleanset.operators import dedup

SCHEMA = "ord bigint, id string, selftext string"


def in_order(rows, stored=()):
    """The rule, one row after the other."""
    ids = {i for i, _ in stored if i}
    texts = {t for _, t in stored if t}
    kept = []
    for o, i, t in sorted(rows):
        if (i and i in ids) or (t and t in texts):
            continue
        kept.append(o)
        if i:
            ids.add(i)
        if t:
            texts.add(t)
    return kept


def run(spark, rows, stored=None, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("ord", "no")
    old = None if stored is None else spark.createDataFrame(stored, "id string, selftext string")
    kept = dedup.ordered_dedup(frame, old, ["no"], **options)
    return sorted(r.no for r in kept.collect())


def random_rows(rng, n, ids, texts):
    return [
        (
            o,
            rng.choice(["", None] + [f"i{k}" for k in range(ids)] * 3),
            rng.choice(["", None] + [f"t{k}" for k in range(texts)] * 3),
        )
        for o in rng.sample(range(10 * n), n)
    ]


def test_a_rejected_row_claims_nothing(spark):
    assert run(spark, [(1, "1", "x"), (2, "2", "x"), (3, "2", "y")]) == [1, 3]


def test_bodies_compare_byte_for_byte(spark):
    rows = [(1, "a", "Text"), (2, "b", "text"), (3, "c", "text "), (4, "d", "Text")]
    assert run(spark, rows) == [1, 2, 3]


def test_blank_keys_are_never_duplicates(spark):
    rows = [(1, "", "x"), (2, None, "y"), (3, "a", ""), (4, "b", None), (5, "", ""), (6, "", "")]
    assert run(spark, rows, [("", "")]) == [1, 2, 3, 4, 5, 6]


def test_stored_ids_and_bodies_reject(spark):
    rows = [(1, "old", "new"), (2, "new", "old body"), (3, "new", "fresh")]
    assert run(spark, rows, [("old", "old body")]) == [3]


def test_no_rows_and_no_stored_rows(spark):
    assert run(spark, [], [("a", "b")]) == []
    assert run(spark, [(1, "a", "b")], []) == [1]


@pytest.mark.parametrize("seed", range(4))
def test_random_rows_equal_the_rule(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 120, 25, 25)
    stored = [(f"i{rng.randrange(25)}", f"t{rng.randrange(25)}") for _ in range(3)]
    assert run(spark, rows, stored) == in_order(rows, stored)


@pytest.mark.parametrize("seed", range(3))
def test_hot_keys_are_split_and_change_nothing(spark, seed, monkeypatch):
    rng = random.Random(100 + seed)
    rows = random_rows(rng, 150, 60, 60)
    # A third of the rows share a body, another lot shares an id.
    rows = [(o, i, "hot") if k % 3 == 0 else (o, "busy", t) if k % 5 == 0 else (o, i, t)
            for k, (o, i, t) in enumerate(rows)]
    stored = [("i1", "t1")]
    found = []
    plain = dedup._hot_keys

    def spy(*args):
        found.append(plain(*args))
        return found[-1]

    monkeypatch.setattr(dedup, "_hot_keys", spy)
    assert run(spark, rows, stored, hot_rows=10) == in_order(rows, stored)
    assert any(h is not None for h in found)


def test_hot_keys_are_found_in_a_sample(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_SAMPLE_ROWS", 2000)
    rows = spark.range(20_000).selectExpr(
        "id as no", "concat('i', id) as id", "if(id % 3 = 0, 'hot', concat('t', id % 9000)) as selftext"
    )
    keys = rows.select(F.col("selftext").alias("text_key"))
    hot = dedup._hot_keys(dedup._hot_sample(keys, 20_000, 2000), "text_key")
    assert [r.text_key for r in hot.collect()] == ["hot"]
    kept = dedup.ordered_dedup(rows, None, ["no"], hot_rows=2000)
    assert sorted(r.no for r in kept.collect()) == in_order([tuple(r) for r in rows.collect()])


def test_long_chain_is_settled_by_slices(spark):
    """Every row waits for the one before: rounds alone would need half as many as rows."""
    rows = []
    for k in range(60):
        rows += [(2 * k, f"i{k}", f"t{k}"), (2 * k + 1, f"i{k + 1}", f"t{k}")]
    keyed = spark.createDataFrame(
        [(i, t, o) for o, i, t in rows], "id_key string, text_key string, ord bigint"
    )
    kept, rounds = dedup.kept_rows(keyed, slice_from_round=2, slice_rows=50)
    assert sorted(r.ord for r in kept.collect()) == in_order(rows)
    assert rounds <= 5


def test_slices_with_an_order_of_several_columns(spark):
    rows = []
    for k in range(40):
        rows += [(k, "a", f"i{k}", f"t{k}"), (k, "b", f"i{k + 1}", f"t{k}")]
    frame = spark.createDataFrame(rows, "n int, s string, id string, selftext string")
    kept = dedup.ordered_dedup(frame, None, ["n", "s"], slice_from_round=1, slice_rows=30)
    flat = [(2 * n + (s == "b"), i, t) for n, s, i, t in rows]
    assert sorted(2 * r.n + (r.s == "b") for r in kept.collect()) == in_order(flat)


def test_misjudged_slice_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SAMPLE_ROWS", 1)
    rng = random.Random(9)
    rows = random_rows(rng, 80, 10, 10)
    assert run(spark, rows, slice_from_round=1, slice_rows=2) == in_order(rows)


def test_large_side_path_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    rows = random_rows(rng, 100, 30, 30)
    stored = [("i1", "t1"), ("i2", "")]
    assert run(spark, rows, stored) == in_order(rows, stored)


def test_order_of_several_columns(spark):
    frame = spark.createDataFrame(
        [(2, "b", "1", "x"), (1, "z", "1", "y"), (2, "a", "2", "x")],
        "n int, s string, id string, selftext string",
    )
    kept = dedup.ordered_dedup(frame, None, ["n", "s"]).collect()
    assert sorted((r.n, r.s) for r in kept) == [(1, "z"), (2, "a")]


def test_anti_joins_split_hot_keys(spark):
    rows = spark.range(300).selectExpr(
        "if(id % 3 = 0, 'hot', concat('i', id % 50)) as id",
        "if(id % 4 = 0, 'body', if(id % 4 = 1, '', concat('t', id))) as selftext",
        "id as n",
    )
    stored = spark.createDataFrame([("hot", "body"), ("i1", "t2")], "id string, selftext string")
    for anti in (dedup.anti_id, dedup.anti_text):
        plain = sorted(r.n for r in anti(rows, stored).collect())
        assert plain == sorted(r.n for r in anti(rows, stored, hot_rows=20).collect())
        assert 0 < len(plain) < 300


def test_anti_joins_and_sets(spark):
    rows = spark.createDataFrame(
        [("a", "x"), ("", "y"), ("c", ""), ("d", "x")], "id string, selftext string"
    )
    stored = spark.createDataFrame([("a", "x"), ("", ""), (None, None)], "id string, selftext string")
    assert sorted(r.id for r in dedup.anti_id(rows, stored).collect()) == ["", "c", "d"]
    assert sorted(r.id for r in dedup.anti_text(rows, stored).collect()) == ["", "c"]
    ids, texts = dedup.existence_sets(stored)
    assert (ids.count(), texts.count()) == (1, 1)


@pytest.mark.parametrize("bits", [32_768, dedup.FILTER_BITS])
def test_anti_joins_with_a_filter_that_errs(spark, monkeypatch, bits):
    """Keys whose hashes meet in the bitmap are still told apart, and nulls go past it."""
    monkeypatch.setattr(dedup, "FILTER_BITS", bits)
    rows = spark.range(40_000).selectExpr(
        "if(id % 9 = 0, null, concat('i', id % 30000)) as id", "concat('t', id % 20000) as selftext", "id as n"
    )
    stored = spark.range(0, 60_000, 3).selectExpr("concat('i', id) as id", "concat('t', id) as selftext")
    names, texts = ({f"{c}{k}" for k in range(0, 60_000, 3)} for c in "it")
    every = rows.collect()
    assert sorted(r.n for r in dedup.anti_id(rows, stored).collect()) == [r.n for r in every if r.id not in names]
    assert sorted(r.n for r in dedup.anti_text(rows, stored).collect()) == [
        r.n for r in every if r.selftext not in texts
    ]


def test_anti_joins_start_no_job_and_move_few_bodies(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('i', id) as id", "repeat(concat('t', id), 50) as selftext")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    stored = rows.where("substring(id, 2) % 500 = 0")
    before = spark._jsc.sc().dagScheduler().numTotalJobs()
    found = dedup.anti_id(rows, stored)
    assert spark._jsc.sc().dagScheduler().numTotalJobs() == before
    assert found.count() == 20_000 - 40
    marked = dedup._in_filter(
        rows.withColumn("k", dedup.id_key()), stored.select(dedup.id_key().alias("k")), "k", "maybe"
    )
    # Only rows whose bit is set go on to the join, and those are the stored ones.
    assert 40 <= marked.where("maybe").count() <= 45


def test_keys_not_bodies_are_shuffled(spark):
    frame = spark.range(5).select(
        F.col("id").cast("string").alias("id"), F.lit("b").alias("selftext"), F.col("id").alias("n")
    )
    plan = dedup.ordered_dedup(frame, None, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def chains(lengths):
    """Rows that each share an id with the row before or a body with it, in turns, dealt in row order."""
    rows = []
    for c, length in enumerate(lengths):
        for k in range(length):
            rows.append((k * len(lengths) + c, f"i{c}.{(k + 1) // 2}", f"t{c}.{k // 2}"))
    return rows


def test_components_are_settled_side_by_side(spark):
    rows = chains([50] * 300 + [1, 2, 3] * 20 + [2_500])
    frame = spark.createDataFrame(rows, SCHEMA).toDF("ord", "id_key", "text_key")
    kept, rounds = dedup.kept_rows(frame, slice_from_round=3, slice_rows=600)
    assert sorted(r.ord for r in kept.collect()) == in_order(rows)
    # Two rounds of their own, one for all chains but the longest, and slices of that one.
    assert rounds <= 12


def test_only_whole_components_are_settled(spark):
    rows = chains([40, 7, 200, 3])
    frame = spark.createDataFrame(rows, SCHEMA).toDF("ord", "id_key", "text_key")
    kept = {r.ord for r in dedup.settle_components(frame, 100).collect()}
    assert kept == {o for o in in_order(rows) if o % 4 != 2}
    # After one step the longer chains are not known; what is settled is right all the same.
    early = {r.ord for r in dedup.settle_components(frame, 10**6, steps=1).collect()}
    assert {o for o in in_order(rows) if o % 4 == 3} <= early <= set(in_order(rows))
    assert dedup.settle_components(frame.limit(0), 100).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_rows_equal_the_rule(spark, seed):
    rows = [(o, i or f"only{o}", t or f"own{o}") for o, i, t in random_rows(random.Random(seed), 300, 120, 120)]
    frame = spark.createDataFrame(rows, SCHEMA).toDF("ord", "id_key", "text_key")
    kept, _ = dedup.kept_rows(frame, slice_from_round=1, slice_rows=40)
    assert sorted(r.ord for r in kept.collect()) == in_order(rows)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("bits", [8, 1 << 25])
def test_digests_and_filters_change_no_row(spark, monkeypatch, seed, few, bits):
    """Few kept rows and many, by broadcast and by shuffle, with bodies and with digests of them."""
    monkeypatch.setattr(dedup, "FILTER_BITS", bits)
    rng = random.Random(seed)
    rows = random_rows(rng, 80, *((5, 6) if few else (400, 500)))
    rows += [(o + 1, i, t) for o, i, t in rows[:5]]  # a second copy; its place is another, mostly
    rows = list({o: (o, i, t) for o, i, t in rows}.values())
    stored = [(f"i{k}", f"t{k + 1}") for k in range(0, 400, 97)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("ord", "no")
    digested = frame.withColumn("d", body_digest(F.coalesce("selftext", F.lit(""))))
    old = spark.createDataFrame(stored, "id string, selftext string")
    want = in_order(rows, stored)
    assert (2 * len(want) <= len(rows)) == few
    for most in (0, dedup.BROADCAST_ROWS):
        monkeypatch.setattr(dedup, "BROADCAST_ROWS", most)
        for some, digest in ((frame, None), (digested, "d")):
            kept = dedup.ordered_dedup(some, old, ["no"], digest=digest)
            assert kept.columns == some.columns
            assert sorted(r.no for r in kept.collect()) == want


def test_dropped_rows_go_before_a_shuffle_of_kept_ones(spark, monkeypatch):
    """Of many rows few are kept: only these go on from the filter, whichever way they are joined."""
    rows = spark.range(2_000).selectExpr("concat('i', id) as id", "repeat(concat('t', id), 9) as selftext", "id as n")
    kept = rows.where("n % 50 = 0").select(dedup.id_key().alias("id_key"))
    assert 40 <= dedup._near_ids(rows, kept).count() <= 45
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 0)
    fresh = dedup.ordered_dedup(rows, rows.where("n % 50 <> 0").select("id", "selftext"), ["n"])
    assert "getbit" in fresh._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.n for r in fresh.collect()) == list(range(0, 2_000, 50))


def test_digest_of_the_empty_text(spark):
    assert spark.range(1).select(body_digest(F.lit(""))).first()[0] == EMPTY_DIGEST
