"""Texts are matched where they are read, once, and moved only of posts that are wanted."""

import pytest
from pyspark.sql import functions as F

from gleanset.functions import text as X
from gleanset.operators import dedup, matching, search
from gleanset.plans import catalog
from gleanset.sources import testdata as D

SF = "/root/testdata/sf0.001"


def test_partition_check_matches_every_text_once(spark, monkeypatch):
    calls = []
    plain = X.find_matches

    def counted(*args):
        calls.append(args)
        return plain(*args)

    monkeypatch.setattr(X, "find_matches", counted)
    check = catalog.all_queries()["vocab_partition_check"](spark, SF)
    assert len(calls) == 1
    text = X.search_text()
    posts = D.posts(spark, SF)
    sides = {"thon": "missing", "er": "surplus"}
    want = {(t, side, posts.where(X.term_matches(text, t)).count()) for t, side in sides.items()}
    assert {tuple(r) for r in check.collect()} == {w for w in want if w[2]}


def test_events_are_never_broadcast_whole(spark):
    plan = D.posts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("given", [False, True])
def test_search_by_hits_brings_the_newest_posts_only(spark, given):
    """Ties in time and id, a blank id, and more posts than places: as without hits."""
    rows = [(f"p{i % 30}", "pain" if i % 3 else "sore", f"tool {i}", float(i % 12)) for i in range(90)]
    rows += [(None, "sore pain", "tool", 99.0), ("p1", "sore pain", "other", 99.0), ("p2", "", None, 98.0)]
    posts = spark.createDataFrame(rows, "post_id string, title string, text string, created_utc double").repartition(5)
    batches, tools = [["pain"], ["sore"]], ["tool"]
    hit = posts.withColumn("hits", matching.batch_hits(X.search_text(), batches, tools))
    asked = []

    def lookup(ids):
        asked.append(ids)
        found = ids.withColumnRenamed("post_id", "wanted")
        return hit.join(found, F.col("post_id").eqNullSafe(F.col("wanted")), "left_semi")

    want = search.ranked_candidates(posts, batches, tools, search_limit=4)
    found = search.ranked_candidates(
        hit, batches, tools, search_limit=4, hits="hits", lookup=lookup if given else None
    )
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    if given:
        assert asked[0].count() <= 4 * len(batches)


def test_streams_move_texts_of_candidates_only(spark, monkeypatch):
    """Every read of whole posts for the search names the ids that it wants."""
    asked = []
    plain = D.posts

    def seen(*args, **options):
        asked.append(options.get("ids"))
        return plain(*args, **options)

    monkeypatch.setattr(D, "posts", seen)
    _, searched = catalog.streams(spark, SF)
    assert sum(ids is not None for ids in asked) == 1
    posts = plain(spark, SF, matching=True)
    _, want = catalog.R.collect_streams(posts, catalog.settings(), D.clock(spark, SF))
    shown = ["post_id", "batch", "rank", "matched_pain_keywords", "matched_tools", "text"]
    assert sorted(map(str, searched.select(shown).collect())) == sorted(map(str, want.select(shown).collect()))


@pytest.mark.parametrize("most", [0, dedup.BROADCAST_ROWS])
def test_bodies_of_new_rows_are_looked_up(spark, monkeypatch, most):
    wanted = []
    plain = D.posts

    def seen(*args, **options):
        wanted.append(options.get("ids"))
        return plain(*args, **options)

    monkeypatch.setattr(D, "posts", seen)
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", most)
    _, fresh = catalog._stored_and_new(spark, SF, "sheets")
    assert (wanted[-1] is not None) == bool(most)
    stored = catalog.stored_keys(spark, SF)
    want = dedup.ordered_dedup(catalog.all_rows(spark, SF), stored, ["created_utc", "id"])
    assert fresh.columns == want.columns
    assert sorted(map(str, fresh.collect())) == sorted(map(str, want.collect()))
