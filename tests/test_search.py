import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gleanset.operators import reports, search
from gleanset.sources import curated as C

NOW = datetime(2026, 9, 3, 12, tzinfo=timezone.utc)
AT = NOW.timestamp()
SCHEMA = "post_id string, subreddit string, title string, text string, created_utc double"
PAINS = ["alpha", "beta", "gamma", ""]
TOOLS = ["wiki", "mail"]


def posts(spark, rows):
    """Rows of (id, age in seconds, text)."""
    return spark.createDataFrame([(i, "s", "", t, AT - age) for i, age, t in rows], SCHEMA)


def hit(text, terms):
    return [t for t in terms if t and re.search(rf"(?<!\w){re.escape(t)}(?!\w)", text, re.I)]


def by_hand(rows, hours, batch_size, limit, max_age=24):
    """The search told in plain steps; also its funnel."""
    pains = [p for p in PAINS if p]
    batches = [pains[i : i + batch_size] for i in range(0, len(pains), batch_size)]
    seen, found, funnel = set(), [], []
    for b, terms in enumerate(batches, start=1):
        raw = [r for r in rows if hit(r[2], terms) and hit(r[2], TOOLS) and r[1] <= max_age * 3600]
        raw = sorted(raw, key=lambda r: (r[1], r[0], r[2]))[:limit]
        within = [r for r in raw if r[1] <= hours * 3600]
        new = 0
        for rank, r in enumerate(raw, start=1):
            if r in within and r[0] not in seen:
                seen.add(r[0])
                found.append((b, rank, r[0], hit(r[2], pains), hit(r[2], TOOLS)))
                new += 1
        funnel.append((b, len(raw), len(within), new))
    return found, funnel


def rows_for_search():
    words = ["alpha", "beta", "gamma", "alphabet", "wiki", "mail", "mailbox"]
    rows = []
    for k in range(200):
        text = " ".join(words[(k * m + m) % 7] for m in (1, 3, 5)) + (" gamma" if k % 4 == 0 else "")
        rows.append((f"p{k % 150}", 60.0 * ((k * 37) % 400), text))
    return rows


@pytest.mark.parametrize(("batch_size", "limit"), [(1, 7), (2, 20), (5, 250), (1, 1500)])
def test_search_and_funnel_equal_plain_steps(spark, batch_size, limit):
    rows = rows_for_search()
    frame = posts(spark, rows).repartition(5)
    options = {"batch_size": batch_size, "search_limit": limit}
    found, funnel = by_hand(rows, 3, batch_size, limit)
    got = search.global_search(frame, PAINS, TOOLS, 3, NOW, **options).collect()
    assert sorted(
        (r.batch, r["rank"], r.post_id, r.matched_pain_keywords, r.matched_tools) for r in got
    ) == sorted(found)
    candidates = search.global_candidates(frame, PAINS, TOOLS, 3, NOW, **options)
    n = len(funnel)
    assert sorted(tuple(r) for r in search.batch_funnel(candidates, n).collect()) == funnel
    total = search.funnel_total(candidates, n).first()
    assert tuple(total) == (len(found), n)


def test_limit_comes_before_cutoff_and_day_caps_lookback(spark):
    rows = [("new", 60, "alpha wiki"), ("old", 7 * 3600, "alpha wiki"), ("gone", 90_000, "alpha wiki")]
    frame = posts(spark, rows)
    ids = lambda **o: sorted(
        r.post_id for r in search.global_search(frame, PAINS, TOOLS, NOW_HOURS, NOW, **o).collect()
    )
    NOW_HOURS = 48
    assert ids() == ["new", "old"]
    assert ids(max_age_hours=None) == ["gone", "new", "old"]
    assert ids(search_limit=1) == ["new"]


def test_batches_without_rows_are_listed(spark):
    frame = posts(spark, [("1", 60, "alpha wiki")])
    found = search.global_candidates(frame, PAINS, TOOLS, 6, NOW, batch_size=1)
    assert sorted(tuple(r) for r in search.batch_funnel(found, 3).collect()) == [
        (1, 1, 1, 1),
        (2, 0, 0, 0),
        (3, 0, 0, 0),
    ]


def test_case_sensitive_search_checks_case_after_finding(spark):
    frame = posts(spark, [("1", 60, "Alpha wiki"), ("2", 61, "alpha wiki")])
    found = search.global_candidates(frame, PAINS, TOOLS, 6, NOW, case_sensitive=True)
    assert sorted((r.post_id, r.exact) for r in found.collect()) == [("1", False), ("2", True)]


@pytest.mark.parametrize(
    "change",
    [
        {"hours": 0},
        {"pains": [""]},
        {"tools": []},
        {"search_limit": 0},
        {"batch_size": 0},
        {"now": datetime(2026, 9, 3, 12)},
    ],
)
def test_arguments_are_checked(spark, change):
    frame = posts(spark, [("1", 60, "alpha wiki")])
    args = {"pains": PAINS, "tools": TOOLS, "hours": 6, "now": NOW} | change
    with pytest.raises(ValueError):
        search.global_search(
            frame,
            args.pop("pains"),
            args.pop("tools"),
            args.pop("hours"),
            args.pop("now"),
            **args,
        )


def test_top_rows_are_cut_before_the_shuffle(spark):
    frame = posts(spark, rows_for_search())
    found = search.global_candidates(frame, PAINS, TOOLS, 6, NOW)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- curated listings ----------------------------------------------------------------

LISTING = "post_id string, subreddit string, created_utc double, stickied boolean, listing_pos bigint"


def listing(spark, rows):
    return spark.createDataFrame([(i, s, AT - age, st, p) for i, s, age, st, p in rows], LISTING)


def test_listing_rules(spark):
    hour = 3600
    rows = [
        ("old sticky", "A", 50 * hour, True, 1),
        ("new sticky", "A", 1 * hour, True, 2),
        ("edge", "A", 13 * hour, False, 3),
        ("old", "A", 14 * hour, False, 4),
        ("hidden", "A", 2 * hour, False, 5),
        ("b new", "b", 1 * hour, None, 1),
        ("b old", "b", 20 * hour, None, 2),
        ("other", "c", 1 * hour, False, 1),
    ]
    frame = listing(spark, rows)
    kept = C.multi_scan(frame, ["B", "a", "none"], 13, NOW, newest_first=False)
    assert sorted((r.list_pos, r.post_id) for r in kept.collect()) == [
        (0, "b new"),
        (1, "edge"),
        (1, "new sticky"),
    ]
    # A listing sorted by time needs no stop rule.
    flat = C.curated_scan(frame, "A", 13, NOW)
    assert sorted(r.post_id for r in flat.collect()) == ["edge", "hidden", "new sticky"]
    skipped = C.source_skip(frame, ["B", "a", "none"]).collect()
    assert [tuple(r) for r in skipped] == [(2, "none")]
    counts = C.community_counts(kept, ["B", "a", "none"])
    assert sorted(tuple(r) for r in counts.collect()) == [(0, "B", 1), (1, "a", 2), (2, "none", 0)]


def test_community_listed_twice_is_scanned_twice(spark):
    frame = listing(spark, [("1", "a", 60, False, 1)])
    kept = C.multi_scan(frame, ["a", "A"], 13, NOW)
    assert sorted(r.list_pos for r in kept.collect()) == [0, 1]
    assert C.allow_list(frame, ["a", "A"]).count() == 1


def test_cutoff_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "posts")
    posts(spark, [("1", 60, "x")]).write.parquet(path)
    frame = C.lookback_filter(spark.read.parquet(path), NOW, 6).select("post_id")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_utc" in plan
    assert "title" not in plan


@pytest.mark.parametrize("now", [datetime(2026, 1, 1), NOW])
def test_cutoff_needs_a_zone(now):
    if now.tzinfo is None:
        with pytest.raises(ValueError):
            C.cutoff_epoch(now, 1)
    else:
        assert C.cutoff_epoch(now.astimezone(timezone(timedelta(hours=5))), 1) == AT - 3600
        with pytest.raises(ValueError):
            C.cutoff_epoch(now, 0)


# --- coverage ------------------------------------------------------------------------


def test_coverage(spark):
    rows = [("1", 0, "alpha wiki"), ("2", 5400, "alphabet wiki"), ("1", 0, "beta wiki")]
    ranked = search.ranked_candidates(
        posts(spark, rows), [["alpha"], ["beta"], ["gamma"]], TOOLS, whole_word=False
    )
    report = {r.batch: r for r in reports.coverage_report(ranked, 3).collect()}
    assert (report[1].raw, report[1].exact, report[1].exact_pct) == (2, 1, 50.0)
    assert (report[1].raw_hours, report[1].exact_hours) == (1.5, 0.0)
    assert report[1].raw_newest == "2026-09-03T12:00:00+00:00"
    assert report[3].asDict() == {
        "batch": 3, "raw": 0, "exact": 0, "exact_pct": 0.0, "raw_newest": None,
        "raw_oldest": None, "raw_hours": 0.0, "exact_newest": None, "exact_oldest": None,
        "exact_hours": 0.0,
    }
    total = reports.coverage_total(ranked).first()
    assert (total.summed_raw, total.distinct_raw) == (3, 2)
    assert (total.summed_exact, total.distinct_exact) == (2, 1)
    empty = reports.coverage_total(ranked.where("batch > 9")).first()
    assert (empty.summed_raw, empty.distinct_raw, empty.raw_newest) == (0, 0, None)


def test_cooccurrence_lists_all_cells(spark):
    frame = posts(spark, [("1", 0, "alpha wiki"), ("2", 0, "wiki"), ("3", 0, "wiki")])
    got = {r.cell: r.posts for r in reports.cooccurrence(frame, "alpha", "wiki").collect()}
    assert got == {"both": 1, "only_a": 0, "only_b": 2, "neither": 0}


def test_limit_report_is_newest_first(spark):
    frame = posts(spark, [(str(k), k, "x") for k in range(30)])
    assert [r.post_id for r in reports.limit_report(frame).collect()] == [str(k) for k in range(20)]


def test_ties_go_by_id(spark):
    frame = posts(spark, [("b", 5, "x"), ("a", 5, "x"), ("c", 1, "x")])
    assert [r.post_id for r in search.newest_sort(frame).collect()] == ["c", "a", "b"]
    top = search.topn_per_batch(frame.withColumn("batch", F.lit(1)), 2).collect()
    assert sorted((r["rank"], r.post_id) for r in top) == [(1, "c"), (2, "a")]
