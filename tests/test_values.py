import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gleanset.functions import values as N
from gleanset.operators import cleaning
from gleanset.schemas import SOURCE_COLUMNS

RAW = (
    "post_id string, subreddit string, title string, text string, author string, "
    "created_utc double, url string"
)


def seconds():
    rng = random.Random(7)
    fixed = [0.0, -1.5, 0.5, 1930367167.0, 1972857600.0, 1972857600.123456, 1.0000005, 2.5e-6]
    fixed += [-0.25, 253402300799.0, -62135596800.0, 1e9 + 1e-7]
    return fixed + [rng.uniform(0, 4e9) for _ in range(3000)] + [
        rng.randrange(0, 4 * 10**15) / 1e6 for _ in range(3000)
    ]


def test_iso_and_plain_text_equal_python(spark):
    values = seconds()
    rows = spark.createDataFrame([(v,) for v in values], "at double")
    got = rows.select(
        "at", N.epoch_to_iso(F.col("at")).alias("iso"), N.epoch_text(F.col("at")).alias("plain")
    ).collect()
    assert len(got) == len(values)
    for r in got:
        assert r.iso == datetime.fromtimestamp(r.at, timezone.utc).isoformat(), r.at
        if abs(r.at) >= 1e-3 or r.at == 0:
            assert r.plain == repr(r.at), r.at


def test_iso_does_not_follow_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.createDataFrame([(1710054000.0,)], "at double")
        assert row.select(N.epoch_to_iso(F.col("at"))).first()[0] == "2024-03-10T07:00:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize(
    "text",
    ["1", " 1.5 ", "1e3", "1_000", "1._5", "_1", "1__0", ".5", "5.", "1d", "1.0f", "1L", "0x10", "",
     " ", "soon", "inf", "-Infinity", "nan", "+2", "1e", "1e5_0", "--1"],
)
def test_numeric_cast_equals_python(spark, text):
    try:
        wanted = float(text)
    except ValueError:
        wanted = None
    row = spark.createDataFrame([(text,)], "v string")
    got = row.select(N.numeric_cast(F.col("v"))).first()[0]
    assert repr(got) == repr(wanted)


def test_cleaning_keeps_the_body_and_orders_columns(spark):
    body = '  "quoted"\r\n\ttab \\ back\n\n end '
    row = ("p", "s", None, body, None, 1930367167.0, None)
    got = cleaning.clean_posts(spark.createDataFrame([row], RAW)).collect()
    assert got[0].asDict() == {
        "subreddit": "s",
        "id": "p",
        "title": "",
        "author": "",
        "created_utc": 1930367167.0,
        "created_iso": "2031-03-04T05:06:07+00:00",
        "url": "",
        "selftext": body,
    }
    assert tuple(got[0].asDict()) == SOURCE_COLUMNS


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"post_id": None}, "post_id is required"),
        ({"post_id": "", "subreddit": None}, "post_id is required"),
        ({"subreddit": "", "created_utc": None}, "subreddit is required"),
        ({"created_utc": None}, "created_utc is required"),
        ({"created_utc": float("nan")}, "created_utc is no date"),
        ({"created_utc": float("inf")}, "created_utc is no date"),
        ({"created_utc": 1e15}, "created_utc is no date"),
    ],
)
def test_incomplete_posts_fail_the_batch_or_are_reported(spark, change, reason):
    row = {
        "post_id": "p", "subreddit": "s", "title": "t", "text": "b", "author": "a",
        "created_utc": 1.0, "url": "u",
    }
    good = tuple(row.values())
    bad = tuple((row | change).values())
    rows = spark.createDataFrame([good, bad], RAW)
    with pytest.raises(Exception, match=reason):
        cleaning.clean_posts(rows).collect()
    passed, rejected = cleaning.required_check(rows)
    assert passed.count() == 1
    assert [r.reject_reason for r in rejected.collect()] == [reason]


def test_time_as_text_must_be_a_number(spark):
    schema = RAW.replace("created_utc double", "created_utc string")
    rows = spark.createDataFrame(
        [("1", "s", "", "", None, "5", ""), ("2", "s", "", "", None, "1d", "")], schema
    )
    passed, rejected = cleaning.required_check(rows)
    assert [r.created_utc for r in cleaning.clean_posts(passed).collect()] == [5.0]
    assert [r.reject_reason for r in rejected.collect()] == ["created_utc must be numeric"]


def test_empty_groups_have_no_span_and_no_share(spark):
    row = spark.createDataFrame([(None, 0)], "at double, n bigint")
    got = row.select(
        N.window_hours(F.col("at"), F.col("at")), N.percent(F.col("n"), F.col("n"))
    ).first()
    assert tuple(got) == (0.0, 0.0)
