import random
import re

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanset import vocabulary as V
from gleanset.functions import text as X
from gleanset.operators import matching

PAINS = ["waiting", "single owner", "who decides"]
TOOLS = ["wiki", "tracker", "mail"]


def python_hit(text, term, case_sensitive=False):
    flags = 0 if case_sensitive else re.IGNORECASE
    return re.search(rf"(?<!\w){re.escape(term)}(?!\w)", text, flags) is not None


def posts(spark, rows):
    return spark.createDataFrame(rows, "post_id string, title string, text string")


def test_title_and_body_together_satisfy_the_rule(spark):
    rows = posts(spark, [("1", "WAITING again", "see the Wiki"), ("2", "waiting", "nothing")])
    found = matching.matched_posts(rows, PAINS, TOOLS).collect()
    assert [(r.post_id, r.matched_pain_keywords, r.matched_tools) for r in found] == [
        ("1", ["waiting"], ["wiki"])
    ]


def test_both_vocabularies_are_required(spark):
    rows = posts(spark, [("1", "wiki", "tracker"), ("2", "waiting", "who decides")])
    assert matching.any_and_any(rows, PAINS, TOOLS).count() == 0


def test_case_sensitive_matching(spark):
    rows = posts(spark, [("1", "Waiting", "wiki"), ("2", "waiting", "wiki")])
    kept = matching.any_and_any(rows, PAINS, TOOLS, case_sensitive=True).collect()
    assert [r.post_id for r in kept] == ["2"]
    listed = matching.matched_arrays(rows, PAINS, TOOLS, case_sensitive=True)
    assert [r.matched_pain_keywords for r in listed.orderBy("post_id").collect()] == [
        [],
        ["waiting"],
    ]


def test_null_parts_leave_the_newline(spark):
    rows = posts(spark, [("1", None, "x"), ("2", "x", None), ("3", None, None)])
    found = rows.select(X.search_text().alias("s")).collect()
    assert [r.s for r in found] == ["\nx", "x\n", "\n"]


def test_phrase_across_title_and_body_is_no_match(spark):
    rows = posts(spark, [("1", "a single", "owner of the wiki")])
    assert not rows.select(X.term_matches(X.search_text(), "single owner")).first()[0]


def test_order_and_repeats_of_terms_are_kept(spark):
    rows = posts(spark, [("1", "mail wiki", "")])
    found = rows.select(X.find_matches(X.search_text(), ["wiki", "", "mail", "wiki"])).first()[0]
    assert found == ["wiki", "mail", "wiki"]


def test_no_terms_match_nothing(spark):
    rows = posts(spark, [("1", "mail", "")])
    got = rows.select(
        X.find_matches(X.search_text(), []), X.any_term(X.search_text(), ["", ""])
    ).first()
    assert tuple(got) == ([], False)


CASES = [
    ("unblocked", "blocked"),
    ("cross-team work", "cross-team"),
    ("cross team", "cross-team"),
    ("c++ code", "c++"),
    ("a.b", "a.b"),
    ("axb", "a.b"),
    ("éstuck", "stuck"),
    ("stucḱ now", "stuck"),
    ("stuck² now", "stuck"),
    ("_stuck", "stuck"),
    ("9stuck", "stuck"),
    ("字stuck", "stuck"),
    ("JİRA", "jira"),
    ("jıra", "jira"),
    ("ſlack", "slack"),
    ("Kanban", "kanban"),
    ("ÉCOLE", "école"),
    ("slack.", "slack"),
    ("(Slack)", "slack"),
    ("", "slack"),
]


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_hits_equal_python_on_hard_cases(spark, case_sensitive):
    terms = sorted({t for _, t in CASES})
    rows = spark.createDataFrame([(t,) for t, _ in CASES], "text string")
    found = rows.select("text", X.find_matches(F.col("text"), terms, case_sensitive).alias("m"))
    for r in found.collect():
        assert r.m == [t for t in terms if python_hit(r.text, t, case_sensitive)], r.text


def test_every_code_point_bounds_words_as_in_python(spark):
    """For all characters that the JVM's Unicode tables, which may be older, know."""
    points = [c for c in map(chr, range(1, 0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF]
    rows = spark.createDataFrame(pd.DataFrame({"text": [f"stuck{c}" for c in points]}))
    known = rows.where(~F.col("text").rlike(r"\p{Cn}"))
    got = known.select("text", X.term_matches(F.col("text"), "stuck").alias("hit")).toPandas()
    assert len(got) > 250_000
    differ = [t for t, hit in zip(got.text, got.hit) if hit == bool(re.search(r"\w\Z", t))]
    assert differ == []


letters = st.text(alphabet="aAkKsSiIİıſKéÉ_9 .-\n", max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(letters, min_size=1, max_size=30), st.lists(letters, min_size=1, max_size=4))
def test_find_matches_equals_python(spark, texts, terms):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows.select("text", X.find_matches(F.col("text"), terms).alias("m")).collect()
    for r in found:
        assert r.m == [t for t in terms if t and python_hit(r.text, t)], (r.text, terms)


def test_term_batches_and_checks():
    assert [len(b) for b in V.term_batches(V.PAIN_TERMS)] == [5] * 7
    assert V.term_batches(["a", "b", "c"], 2) == [["a", "b"], ["c"]]
    assert V.nonblank_terms(["a", "", "b"]) == ["a", "b"]
    with pytest.raises(ValueError):
        V.term_batches(["a"], 0)


def test_coverage_groups_split_the_vocabulary():
    V.check_groups(V.PAIN_TERMS, V.COVERAGE_GROUPS)
    with pytest.raises(ValueError):
        V.check_groups(V.PAIN_TERMS, V.COVERAGE_GROUPS[1:])


def test_batch_cross_lists_every_batch_of_a_post(spark):
    rows = posts(spark, [("1", "waiting, who decides", "wiki"), ("2", "who decides", "none")])
    hits = matching.batch_cross(rows, [["waiting"], ["single owner"], ["who decides"]], TOOLS)
    assert sorted((r.post_id, r.batch) for r in hits.collect()) == [("1", 1), ("1", 3)]


def test_term_counts_include_zero(spark):
    rows = posts(spark, [("1", "waiting", "wiki"), ("2", "waiting", "")])
    counts = matching.term_counts(rows, ["waiting", "mail"]).collect()
    assert [(r.ord, r.term, r.n_posts) for r in counts] == [(0, "waiting", 2), (1, "mail", 0)]


def vocabulary_and_texts(seed, size):
    """Terms that begin, end and hold one another, and texts made of them."""
    draw = random.Random(seed)
    parts = ["a", "ab", "was", "the", "é", "Éa", "straße", "c++", "x.y", "$", "_", "\u0301", "ſk", "Σ", "ς", "中", "9"]
    terms = ["".join(draw.choice(parts) + draw.choice(["", "", " ", "-"]) for _ in range(draw.randint(1, 4))).strip()
             for _ in range(size)]
    terms = [draw.choice([t, t.lower(), t.upper()]) for t in terms] + ["", terms[0], terms[0]]
    texts = [draw.choice(["", " ", ".", "a"]).join(draw.choice([draw.choice(terms), draw.choice(parts).upper()])
             for _ in range(draw.randint(0, 12))) for _ in range(120)]
    return terms, [*texts, "", None, "İ ı K \U0001d400 x"]


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_large_vocabularies_are_matched_like_small_ones(spark, monkeypatch, case_sensitive):
    terms, texts = vocabulary_and_texts(5, 240)
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    many = X.find_many(F.col("text"), terms, case_sensitive)
    one = X.any_term(F.col("text"), terms, case_sensitive)
    got = [(r.text, r.many, r.one) for r in frame.select("text", many.alias("many"), one.alias("one")).collect()]
    monkeypatch.setattr(X, "TRIE_TERMS", 10**9)
    for at in range(0, len(terms), 81):
        part = terms[at : at + 81]
        plain = frame.select(X.find_matches(F.col("text"), part, case_sensitive).alias("found")).collect()
        for (text, many, one), r in zip(got, plain, strict=True):
            inside = [t for t in many if t in part]
            assert [t for t in part if t in r.found] == [t for t in part if t in inside], text
    flat = [[t for t in terms if t in many] for _, many, _ in got]
    assert [many for _, many, _ in got] == flat  # in vocabulary order, repeated terms included
    assert all(one == bool(many) for text, many, one in got if text is not None)
    assert sum(len(f) for f in flat) > 300


def test_five_thousand_terms(spark):
    draw = random.Random(8)
    words = ["".join(draw.choice("abcde") for _ in range(draw.randint(1, 4))) for _ in range(3000)]
    terms = [" ".join(draw.sample(words, draw.choice([1, 1, 2, 3]))) for _ in range(4800)] + words[:200]
    texts = [" ".join(draw.choice(words).title() for _ in range(draw.randint(0, 60))) for _ in range(50)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r.found for r in frame.select("id", X.find_matches(F.col("text"), terms).alias("found")).collect()}
    for i, text in enumerate(texts):
        padded = f" {text.lower()} "
        assert got[i] == [t for t in terms if f" {t} " in padded]
    assert sum(map(len, got.values())) > 500


def test_a_trie_finds_what_its_terms_find():
    terms = ["a", "ab", "abc", "abd", "b c", "b", "c++", "xyz"]
    pattern = re.compile(X.trie_body(terms))
    for t in terms:
        assert pattern.fullmatch(t), t
    for t in ["", "abx", "c", "c+", "xy", "b "]:
        assert not pattern.fullmatch(t), t
