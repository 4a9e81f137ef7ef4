"""A streamed run copies no body but of candidates of its searches and of the rows that it keeps."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from gleanset.functions.values import body_digest
from gleanset.plans import catalog
from gleanset.plans import run as R
from gleanset.schemas import BODY_DIGEST
from gleanset.sinks import stored as sink
from gleanset.sources import stored as src
from gleanset.sources import testdata as D
from gleanset.streaming import runs as S

NOW = datetime(2024, 5, 10, tzinfo=timezone.utc)
SETTINGS = R.RunSettings(
    communities=["ops"], pains=["alpha", "beta"], tools=["wiki"], curated_hours=240, global_hours=240,
    search_options={"batch_size": 1, "search_limit": 3, "max_age_hours": None},
)
POSTS = (
    "post_id string, subreddit string, title string, text string, author string, created_utc double, "
    "score bigint, num_comments bigint, url string"
)


def posts(spark, told):
    return spark.createDataFrame(
        [(i, place, "", text, "a", (NOW - timedelta(hours=age)).timestamp(), 1, 0, "u") for i, place, age, text in told],
        POSTS,
    )


def drain(spark, source, store, progress):
    stream = spark.readStream.schema(POSTS).parquet(source)
    S.incremental_append(stream, store, progress, backend="sheets", settings=SETTINGS, now=NOW).awaitTermination()


def stored(spark, store):
    return sorted((r.id, r.selftext) for r in src.snapshot_read(spark, store, "sheets").collect())


def test_listed_posts_are_not_copied_whole(spark, tmp_path, monkeypatch):
    told = [(f"p{i}", "ops" if i % 2 else "else", i + 1, f"alpha wiki {i % 25}" if i % 3 else None) for i in range(60)]
    source, store, other = (str(tmp_path / n) for n in ("in", "streamed", "batched"))
    posts(spark, told).write.parquet(source)
    for path in (store, other):
        sink.create_store(spark, path, "sheets")
    R.run_batch(spark, posts(spark, told), other, "one", SETTINGS, NOW, backend="sheets")
    copied = []
    plain = R.durable

    def seen(frame):
        kept = plain(frame)
        if {"text", "selftext"} & set(kept.columns):
            copied.append(kept.count())
        return kept

    monkeypatch.setattr(R, "durable", seen)
    drain(spark, source, store, str(tmp_path / "progress"))
    assert stored(spark, store) == stored(spark, other) and len(stored(spark, store)) > 20
    drain(spark, source, store, str(tmp_path / "again"))
    assert stored(spark, store) == stored(spark, other)
    # The second pass: candidates of two searches, accepted ones, and no new row; none of the 30 listed posts.
    assert max(copied[len(copied) // 2 :]) <= 6


def test_a_state_without_digests_goes_on(spark, tmp_path):
    batch = posts(spark, [("new", "ops", 1, "alpha wiki"), ("blank", "ops", 2, None)])
    old = posts(spark, [("old", "ops", 3, "beta wiki"), ("gone", "ops", 300, "beta wiki")])
    state = str(tmp_path / "state")
    old.write.parquet(f"{state}/batch=0")
    window = S.lookback_window(batch, state, 1, NOW, 240)
    want = body_digest(F.coalesce("text", F.lit("")))
    assert sorted(r.post_id for r in window.where(F.col(BODY_DIGEST) == want).collect()) == ["blank", "new", "old"]
    assert window.count() == 3


def test_texts_meet_their_events_once(spark, monkeypatch):
    joined = []
    plain = D.posts_of

    def seen(frame):
        joined.append(frame)
        return plain(frame)

    monkeypatch.setattr(D, "posts_of", seen)
    assert catalog.all_queries()["incremental_append"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(joined) == 1
