"""Versions of a store: what is visible, older versions, and writers that meet."""

import random
import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gleanset.operators import dedup
from gleanset.plans import run as R
from gleanset.schemas import SOURCE_COLUMNS
from gleanset.sinks import stored as sink
from gleanset.sinks import versions as V
from gleanset.sources import stored as src
from gleanset.streaming import runs as S

COLUMNS = ", ".join(f"{c} {'double' if c == 'created_utc' else 'string'}" for c in SOURCE_COLUMNS)


def rows(spark, pairs):
    """Rows of ids and bodies."""
    cells = [
        [i if c == "id" else body if c == "selftext" else 1.0 if c == "created_utc" else c for c in SOURCE_COLUMNS]
        for i, body in pairs
    ]
    return spark.createDataFrame(cells, COLUMNS)


def ids(spark, store, backend, **how):
    return sorted(r.id for r in src.snapshot_read(spark, store, backend, **how).collect())


@pytest.mark.parametrize("backend", ["csv", "sheets"])
def test_older_versions_and_unpublished_runs(spark, tmp_path, backend, monkeypatch):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, backend, rows(spark, [("a", "one")]))
    sink.verified_append(rows(spark, [("b", "two")]), store, "r1", backend)
    sink.verified_append(rows(spark, [("b", "two"), ("c", "three")]), store, "r1", backend)
    assert [ids(spark, store, backend, version=n) for n in range(3)] == [["a"], ["a", "b"], ["a", "b", "c"]]
    assert src.snapshot_keys(spark, store, backend, version=1).count() == 2
    with pytest.raises(ValueError, match="no version"):
        src.snapshot_read(spark, store, backend, version=9)
    # A run cut in half: its files lie there and nothing names them.
    half = sink.grid_append if backend == "sheets" else sink.csv_rows
    sink._write_run(half(rows(spark, [("x", "half")])), store, backend, "r2", 10, "\n")
    # A run whose check fails.
    real = sink.run_rows
    monkeypatch.setattr(sink, "run_rows", lambda *a: real(*a).limit(1))
    with pytest.raises(RuntimeError, match="expected 2"):
        sink.verified_append(rows(spark, [("y", "bad"), ("z", "bad too")]), store, "r3", backend)
    monkeypatch.undo()
    assert ids(spark, store, backend) == ["a", "b", "c"]
    assert {r.id_key for r in src.snapshot_keys(spark, store, backend).collect()} == {"a", "b", "c"}


def test_csv_keys_are_not_parsed(spark, tmp_path):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "csv", rows(spark, [("a", "one\n\"x\""), ("", "two"), ("c", "")]))
    keys = src.snapshot_keys(spark, store, "csv")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id_key:string,text_key:string>" in plan and "value" not in plan
    wanted = dedup.stored_keys(src.snapshot_read(spark, store, "csv"))
    assert sorted(map(repr, keys.collect())) == sorted(map(repr, wanted.collect()))


def test_one_number_is_published_once(spark, tmp_path):
    store = str(tmp_path / "store")
    won, lost = [], []

    def race(name):
        version = V.Version(0, (V.RunFiles(name, (f"run={name}/x",), 1),))
        try:
            V.publish(spark, store, version)
            won.append(name)
        except V.LostRace:
            lost.append(name)

    threads = [threading.Thread(target=race, args=(f"w{i}",)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 7
    assert [r.run for r in V.read_version(spark, store).runs] == won


def test_a_rename_does_not_overwrite(spark, tmp_path):
    for name in ("draft", "target"):
        (tmp_path / name).write_text(name)
    draft, target = (V._path(spark, str(tmp_path / n)) for n in ("draft", "target"))
    with pytest.raises(Exception, match="FileAlreadyExists|exist"):
        V._rename_new(spark, draft, target)
    V._rename_new(spark, draft, V._path(spark, str(tmp_path / "new")))
    assert (tmp_path / "new").read_text() == "draft" and (tmp_path / "target").read_text() == "target"


POSTS = ("post_id string, subreddit string, title string, text string, author string, created_utc double, "
         "score bigint, num_comments bigint, url string, stickied boolean, listing_pos bigint")
NOW = datetime(2031, 5, 6, 7, 0, tzinfo=timezone.utc)


def posts(spark, told):
    """``(id, community, minutes before now, body)``."""
    return spark.createDataFrame(
        [(i, c, f"t {i}", b, None, NOW.timestamp() - 60 * m, 1, 1, f"/{i}", False, int(m)) for i, c, m, b in told], POSTS
    )


SETTINGS = R.RunSettings(
    communities=["ops"], pains=["alpha", "beta"], tools=["wiki"], curated_hours=4, global_hours=4,
    search_options={"batch_size": 1, "max_age_hours": None, "search_limit": 3},
)


@pytest.mark.parametrize("backend", ["csv", "sheets"])
def test_two_sessions_append_the_same_posts_at_once(spark, tmp_path, backend):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, backend, rows(spark, [("old", "old body")]))
    told = [(f"p{i}", "ops", i + 1, f"body {i % 25}") for i in range(40)]
    failures = []

    def one(name, part):
        try:
            session = spark.newSession()
            R.run_batch(session, posts(session, part), store, name, SETTINGS, NOW, stream="curated", backend=backend)
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=one, args=(f"w{k}", told[k * 5 : 30 + k * 5])) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    found = src.snapshot_read(spark, store, backend).collect()
    assert len({r.id for r in found}) == len(found) and len({r.selftext for r in found}) == len(found)
    assert {r.selftext for r in found} == {"old body", *(f"body {k}" for k in range(25))}
    assert V.latest_number(spark, store) >= 1


def test_a_loser_frees_what_only_its_own_rejected_rows_held(spark, tmp_path):
    """The winner takes a body; the loser's row with it goes, and the row it had displaced comes in."""
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "sheets")
    base = sink.current_version(spark, store)
    mine = rows(spark, [("1", "taken"), ("1", "free")]).withColumn("n", F.monotonically_increasing_id())
    fresh = dedup.ordered_dedup(mine, None, ["n"])
    sink.verified_append(rows(spark, [("9", "taken")]), store, "winner", "sheets", since=base)

    def renew(added):
        return dedup.ordered_dedup(mine, added, ["n"]).drop("n")

    assert sink.verified_append(fresh.drop("n"), store, "loser", "sheets", since=base, renew=renew) == 1
    assert sorted((r.id, r.selftext) for r in src.snapshot_read(spark, store, "sheets").collect()) == [
        ("1", "free"), ("9", "taken")
    ]


def test_known_keys_are_those_that_rows_share(spark):
    mine = rows(spark, [("a", "x"), ("b", ""), ("", "z")])
    stored = rows(spark, [("a", "q"), ("c", "z"), ("d", "w")])
    found = {(r.id_key, r.text_key is not None) for r in dedup.known_keys(mine, stored).collect()}
    assert found == {("a", False), (None, True)}


# --- the streamed run ----------------------------------------------------------------


def test_streamed_runs_equal_runs_over_the_lookback(spark, tmp_path):
    """Micro-batch by micro-batch against whole runs over all posts so far."""
    draw = random.Random(4)
    told = [
        (f"p{i}", draw.choice(["ops", "else", "more"]), 240 - i * 3 - draw.random(),
         f"{draw.choice(['alpha wiki', 'beta wiki', 'alpha', 'none'])} {draw.randrange(30)}") for i in range(60)
    ]
    told.append(("ancient", "ops", 300, "alpha wiki ancient"))
    parts = [told[-1:] + told[:20], told[20:40], told[40:60]]
    source, store, other = str(tmp_path / "in"), str(tmp_path / "streamed"), str(tmp_path / "batched")
    for path in (store, other):
        sink.create_store(spark, path, "sheets")

    def clock(number):
        return NOW - timedelta(hours=2 - number) if number < 3 else NOW

    def drain(progress, now):
        stream = spark.readStream.schema(POSTS).parquet(source)
        query = S.incremental_append(
            stream, store, str(tmp_path / progress), backend="sheets", settings=SETTINGS, now=now
        )
        query.awaitTermination()

    for k, part in enumerate(parts):
        posts(spark, part).coalesce(1).write.mode("append").parquet(source)
        drain("progress", clock)
        R.run_batch(
            spark, posts(spark, [r for p in parts[: k + 1] for r in p]), other, f"r{k}", SETTINGS, clock(k), backend="sheets"
        )
        assert ids(spark, store, "sheets") == ids(spark, other, "sheets")
    kept = [p.name for p in (tmp_path / "progress-lookback").iterdir()]
    assert sorted(kept) == ["batch=1", "batch=2"]  # earlier ones are let go
    state = spark.read.parquet(str(tmp_path / "progress-lookback" / "batch=2"))
    assert "ancient" not in {r.post_id for r in state.collect()} and state.count() > 20
    before = ids(spark, store, "sheets")
    drain("replay", NOW)
    again = ids(spark, store, "sheets")
    assert len(again) == len(set(again)) and set(before) <= set(again)
    drain("replay again", NOW)
    assert ids(spark, store, "sheets") == again


def test_a_post_of_an_earlier_micro_batch_competes(spark, tmp_path):
    """Three places: newer posts of the first micro-batch keep an older one of the second out."""
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    sink.create_store(spark, store, "sheets")
    for part in ([(f"new{i}", "else", i + 1, f"alpha wiki {i}") for i in range(3)], [("old", "else", 100, "alpha wiki old")]):
        posts(spark, part).coalesce(1).write.mode("append").parquet(source)
        S.incremental_append(
            spark.readStream.schema(POSTS).parquet(source), store, str(tmp_path / "progress"),
            backend="sheets", settings=SETTINGS, now=NOW,
        ).awaitTermination()
    assert ids(spark, store, "sheets") == ["new0", "new1", "new2"]
    with pytest.raises(ValueError, match="now"):
        S.incremental_append(spark.readStream.schema(POSTS).parquet(source), store, "x", settings=SETTINGS)
