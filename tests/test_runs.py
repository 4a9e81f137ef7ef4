import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gleanset.operators import sets
from gleanset.operators.search import first_seen
from gleanset.plans import run as R
from gleanset.sinks.stored import create_store
from gleanset.sources.raw import raw_flatten, read_submissions
from gleanset.sources.stored import snapshot_read
from gleanset.streaming import runs as S

NOW = datetime(2026, 9, 3, 12, tzinfo=timezone.utc)
AT = NOW.timestamp()
POSTS = (
    "post_id string, subreddit string, title string, text string, author string, "
    "created_utc double, score bigint, num_comments bigint, url string"
)
STORED = (
    "subreddit string, id string, title string, author string, created_utc double, "
    "created_iso string, url string, selftext string"
)
HOUR = 3600


def posts(spark, rows):
    """Rows of (id, community, age in hours, title, body)."""
    return spark.createDataFrame(
        [(i, c, t, b, None, AT - age * HOUR, 1, 2, f"/{i}") for i, c, age, t, b in rows], POSTS
    )


ROWS = [
    ("both", "Ops", 1, "alpha", "with wiki"),
    ("curated", "ops", 2, "nothing", "special"),
    ("global", "elsewhere", 3, "beta", "by mail"),
    ("copy", "ops", 12, "other title", "special"),
    ("stored id", "ops", 1, "t", "fresh body"),
    ("stored body", "ops", 1, "t", "known body"),
    ("empty 1", "ops", 1, "t", ""),
    ("empty 2", "ops", 1, "t", ""),
    ("too old", "ops", 14, "alpha", "wiki wiki"),
    ("no match", "elsewhere", 1, "alpha", "alone"),
]
SETTINGS = R.RunSettings(communities=["OPS", "gone"], pains=["alpha", "beta"], tools=["wiki", "mail"])


def store_with_rows(spark, tmp_path, backend):
    path = str(tmp_path / "store")
    old = [
        ("s", "stored id", "t", "a", 1.0, "i", "u", "old"),
        ("s", "x", "t", "a", 1.0, "i", "u", "known body"),
    ]
    create_store(spark, path, backend, spark.createDataFrame(old, STORED))
    return path


def run(spark, store, backend="csv", name="one", settings=SETTINGS, **options):
    return R.run_batch(
        spark, posts(spark, ROWS), store, name, settings, NOW, backend=backend, **options
    )


NEW = ["both", "curated", "empty 1", "empty 2", "global"]


@pytest.mark.parametrize("backend", ["csv", "sheets"])
def test_run_appends_new_rows_once(spark, tmp_path, backend):
    store = store_with_rows(spark, tmp_path, backend)
    for name in ("one", "one", "two"):
        outcome = run(spark, store, backend, name)
        new = [] if name == "two" else NEW
        assert sorted(r.id for r in outcome.kept.collect()) == new
        result = outcome.result.first().asDict()
        assert result == {
            "existing_rows": 7 if name == "two" else 2,
            "curated_posts": 7,
            "global_posts": 2,
            "combined_candidates": 9,
            "unique_posts": len(new),
            "uploaded": bool(new),
        }
        ids = sorted(r.id for r in snapshot_read(spark, store, backend).collect())
        assert ids == sorted(["stored id", "x", *NEW])


def test_dry_run_tells_sources_and_writes_nothing(spark, tmp_path):
    store = store_with_rows(spark, tmp_path, "csv")
    outcome = run(spark, store, dry_run=True)
    told = {
        r.id: (r.source, r.matched_pain_keywords, r.matched_tools)
        for r in outcome.candidates.collect()
    }
    assert told == {
        "both": ("curated+global", ["alpha"], ["wiki"]),
        "curated": ("curated", [], []),
        "empty 1": ("curated", [], []),
        "empty 2": ("curated", [], []),
        "global": ("global", ["beta"], ["mail"]),
    }
    assert not outcome.uploaded
    assert snapshot_read(spark, store).count() == 2


@pytest.mark.parametrize(
    ("stream", "enabled", "kept"),
    [
        ("curated", True, ["both", "curated", "empty 1", "empty 2"]),
        ("global", True, ["both", "global"]),
        ("both", False, ["both", "curated", "empty 1", "empty 2"]),
        ("global", False, []),
    ],
)
@pytest.mark.parametrize("dry_run", [True, False])
def test_streams_alone(spark, tmp_path, stream, enabled, kept, dry_run):
    store = store_with_rows(spark, tmp_path, "sheets")
    settings = R.RunSettings(
        communities=["ops"], pains=["alpha", "beta"], tools=["wiki", "mail"], search_enabled=enabled
    )
    outcome = run(
        spark, store, "sheets", settings=settings, stream=stream, dry_run=dry_run
    )
    assert sorted(r.id for r in outcome.kept.collect()) == kept
    assert outcome.uploaded == (bool(kept) and not dry_run)
    assert outcome.result.first().existing_rows == 2


@pytest.mark.parametrize("stream", ["both", "curated", "global"])
def test_reports_tell_what_each_part_found(spark, tmp_path, stream):
    outcome = run(spark, store_with_rows(spark, tmp_path, "sheets"), "sheets", stream=stream, dry_run=stream == "global")
    told = {"community": [], "batch": [], "search": []}
    for row in outcome.reports.collect():
        told[row.kind].append(row)
    counts = outcome.result.first()
    assert sum(r.posts for r in told["community"]) == counts.curated_posts
    assert sum(r.posts for r in told["batch"]) == counts.global_posts == sum(r.posts for r in told["search"])
    assert [r.name for r in sorted(told["community"], key=lambda r: r.number)] == (
        [] if stream == "global" else list(SETTINGS.communities)
    )
    assert [r.number for r in sorted(told["batch"], key=lambda r: r.number)] == (
        [] if stream == "curated" else list(range(1, told["search"][0].number + 1))
    )
    assert all(r.raw >= r.within_lookback >= r.posts for r in told["batch"])


@pytest.mark.parametrize("bad", [{"stream": "all"}, {"backend": "disk"}])
def test_names_are_checked(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        run(spark, str(tmp_path), **bad)


@pytest.mark.parametrize("bad", [{"curated_hours": 0}, {"pains": [""]}, {"tools": []}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        R.RunSettings(**bad)


def test_defaults_hold_the_fixed_sizes():
    base = R.RunSettings()
    assert (len(base.pains), len(base.tools), len(base.communities)) == (35, 12, 30)
    assert (base.curated_hours, base.global_hours) == (13, 6)


def test_curated_copy_comes_first(spark):
    frame = posts(spark, ROWS)
    curated, searched = R.collect_streams(frame, SETTINGS, NOW)
    union = sets.source_order(sets.stream_union(curated, searched)).collect()
    assert [r.stream_no for r in union] == [0] * 7 + [1] * 2
    assert union[0].created_utc >= union[1].created_utc


def test_flattening_submissions(spark, tmp_path):
    path = tmp_path / "in.json"
    row = {
        "id": "1", "subreddit": {"display_name": "ops"}, "title": None, "selftext": None,
        "author": None, "created_utc": 5, "score": 3, "num_comments": 4, "permalink": "/r/1",
        "stickied": False, "listing_pos": 1,
    }
    path.write_text(json.dumps(row) + "\n" + json.dumps(row | {"id": "2", "author": {"name": "me"}}))
    rows = raw_flatten(read_submissions(spark, str(path)), "http://base").orderBy("post_id").collect()
    assert rows[0].asDict() == {
        "post_id": "1", "subreddit": "ops", "title": "", "text": "", "author": None,
        "created_utc": 5.0, "score": 3, "num_comments": 4, "url": "http://base/r/1",
        "stickied": False, "listing_pos": 1,
    }
    assert rows[1].author == "me"
    path.write_text("{broken")
    with pytest.raises(Exception):
        read_submissions(spark, str(path)).collect()


def test_last_copy_wins_by_id(spark):
    copies = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]
    rows = spark.createDataFrame(copies, "post_id string, n int, v string")
    assert sorted((r.post_id, r.v) for r in sets.distinct_by_id(rows, ["n"]).collect()) == [
        ("a", "y"),
        ("b", "z"),
    ]


def test_multisets_are_compared(spark):
    make = lambda terms: spark.createDataFrame([(t,) for t in terms], "term string")
    assert sets.vocab_partition_check(make("abc"), make("cab")).count() == 0
    got = sets.vocab_partition_check(make("aab"), make("abbb")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "missing", 1), ("b", "surplus", 2)]


# --- streaming -----------------------------------------------------------------------


def write_batch(spark, folder, rows):
    posts(spark, rows).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("backend", ["csv", "sheets"])
def test_stream_appends_as_batches_would(spark, tmp_path, backend):
    store = store_with_rows(spark, tmp_path, backend)
    source = str(tmp_path / "in")
    write_batch(spark, source, ROWS[:4])

    def drain(progress):
        stream = spark.readStream.schema(POSTS).parquet(source)
        query = S.incremental_append(stream, store, str(tmp_path / progress), backend=backend)
        query.awaitTermination()

    drain("progress")
    first = {r.id for r in snapshot_read(spark, store, backend).collect()}
    # The older copy comes first in time order, so it is the one kept.
    assert first == {"stored id", "x", "both", "global", "copy"}
    write_batch(spark, source, ROWS[4:])
    drain("progress")
    second = sorted(r.id for r in snapshot_read(spark, store, backend).collect())
    assert second == sorted([*first, "empty 1", "empty 2", "too old", "no match"])
    # A new progress folder replays everything as one batch, and nothing is new.
    drain("replay")
    assert sorted(r.id for r in snapshot_read(spark, store, backend).collect()) == second
    # One that starts with other posts leaves earlier runs alone.
    source = str(tmp_path / "other")
    write_batch(spark, source, [("late", "ops", 1, "t", "late body")])
    drain("other progress")
    assert sorted(r.id for r in snapshot_read(spark, store, backend).collect()) == sorted(
        [*second, "late"]
    )


def test_second_writer_of_a_store_is_refused(spark, tmp_path):
    store = store_with_rows(spark, tmp_path, "sheets")
    name = S.writer_name(store)
    rate = spark.readStream.format("rate").load()
    held = rate.writeStream.queryName(name).format("noop").start()
    try:
        stream = spark.readStream.schema(POSTS).parquet(str(tmp_path))
        with pytest.raises(Exception, match=name):
            S.incremental_append(stream, store, str(tmp_path / "progress"), backend="sheets")
    finally:
        held.stop()


def test_runs_cover_both_ends(spark):
    # A post created exactly at a run is seen by it, and by the run that looks exactly back to it.
    rows = [("1", "s", 0, "", ""), ("2", "s", 1, "", "")]
    got = S.sliding_runs(posts(spark, rows), *S.GLOBAL_SCHEDULE).orderBy("run_at").collect()
    assert [(int(r.run_at - AT) // HOUR, r.seen, r.first_seen, r.seen_again) for r in got] == [
        (0, 2, 2, 0),
        (3, 2, 0, 2),
        (6, 1, 0, 1),
    ]


def test_curated_runs_end_at_half_past(spark):
    got = S.sliding_runs(posts(spark, [("1", "s", 0, "", "")]), *S.CURATED_SCHEDULE).collect()
    ends = sorted(datetime.fromtimestamp(r.run_at, timezone.utc).strftime("%H:%M") for r in got)
    assert ends == ["00:30", "12:30"]


def test_rows_late_by_less_than_the_overlap_are_caught(spark):
    rows = posts(spark, [(str(k), "s", k / 7, "", "") for k in range(100)])
    late = rows.withColumn("visible_at", F.col("created_utc") + F.lit(3 * HOUR))
    got = S.late_data(late, *S.GLOBAL_SCHEDULE).collect()
    assert [(r.delay_hours, r.posts, r.caught, r.missed) for r in got] == [(3, 100, 100, 0)]
    gone = rows.withColumn("visible_at", F.col("created_utc") + F.lit(6 * HOUR + 1))
    (row,) = S.late_data(gone, *S.GLOBAL_SCHEDULE).collect()
    assert row.missed == 100


def test_stream_state_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    write_batch(spark, source, [("a", "s", 1, "", ""), ("a", "s", 2, "", ""), ("b", "s", 1, "", "")])
    stream = spark.readStream.schema(POSTS).parquet(source)
    stream = stream.withColumn("ts", F.timestamp_seconds("created_utc"))
    out = str(tmp_path / "out")
    query = (
        S.stream_first_seen(stream, "12 hours").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert sorted(r.post_id for r in spark.read.schema(POSTS).parquet(out).collect()) == ["a", "b"]


def replayed(spark, tmp_path, parts, make):
    """What a stream tells of rows that come in the given parts, one micro-batch each."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(source)
        query = (
            make(spark.readStream.schema(parts[0].schema).parquet(source))
            .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
    state = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    return spark.read.parquet(out), state


def test_streamed_first_copies_equal_the_batch_form_on_a_shuffled_replay(spark, tmp_path):
    draw = random.Random(3)
    kind = "post_id string, ts timestamp, batch int, rank int, body string"
    rows = [
        (f"p{i}", datetime.fromtimestamp(AT + i * 60, timezone.utc), b, draw.randrange(20), f"{i} {b}")
        for i in range(300) for b in draw.sample(range(9), draw.randint(1, 4))
    ]
    rows.append((None, datetime.fromtimestamp(AT, timezone.utc), 1, 1, "without id"))
    draw.shuffle(rows)
    end = [(None, datetime.fromtimestamp(AT + 10**6, timezone.utc), None, None, None)]
    parts = [rows[:400], rows[400:], end]
    got, state = replayed(
        spark, tmp_path, [spark.createDataFrame(p, kind) for p in parts],
        lambda posts: S.stream_first_copy(posts, "1 hour", "12 hours"),
    )
    want = first_seen(spark.createDataFrame(rows, kind))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert state == 1  # of the closing row


def test_streamed_copies_that_lie_far_apart_are_told_each(spark, tmp_path):
    kind = "post_id string, ts timestamp, batch int, rank int"
    hours = [("a", 0, 2, 0), ("a", 1, 1, 0), ("a", 9, 0, 0), ("b", 3, 0, 0), (None, 99, 0, 0)]
    rows = [(i, datetime.fromtimestamp(AT + h * HOUR, timezone.utc), b, r) for i, h, b, r in hours]
    got, _ = replayed(
        spark, tmp_path, [spark.createDataFrame(rows, kind)],
        lambda posts: S.stream_first_copy(posts, "2 hours", "1 hour"),
    )
    assert sorted((r.post_id, r.batch) for r in got.collect()) == [("a", 0), ("a", 1), ("b", 0)]


def test_streamed_late_rows_equal_the_batch_form(spark, tmp_path):
    rows = posts(spark, [(str(k), "s", k / 7, "", "") for k in range(200)]).select(
        "created_utc", (F.col("created_utc") + F.lit(HOUR) * (F.hash("post_id") % 9 + 9)).alias("visible_at")
    )
    in_order = [r for r in rows.orderBy("visible_at").collect()]
    end = [(AT + 10**6, AT + 10**6)]
    parts = [spark.createDataFrame(p, rows.schema) for p in (in_order[:90], in_order[90:], end)]
    got, _ = replayed(spark, tmp_path, parts, lambda s: S.late_data_stream(s, *S.GLOBAL_SCHEDULE))
    sums = got.groupBy("delay_hours").agg(*[F.sum(c).alias(c) for c in ("posts", "caught", "missed")])
    want = S.late_data(rows, *S.GLOBAL_SCHEDULE)
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, want.collect()))
    assert got.groupBy("run_at", "delay_hours").count().where("count > 1").count() == 0
    assert 0 < sums.agg(F.sum("missed")).first()[0] < 200
