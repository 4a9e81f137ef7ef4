"""CSV files cut into byte ranges, against Spark's own reader of whole files."""

import csv
import io
import random

import pytest

from gleanset.schemas import CSV_COLUMNS
from gleanset.sources import csv_ranges as C
from gleanset.sources import stored as src


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that records span several."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def text_of(rows, end):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(CSV_COLUMNS)
    writer.writerows(rows)
    return out.getvalue()


def hostile(seed, count):
    draw = random.Random(seed)
    bits = ['"', '""', ",", "\n", "\r\n", "\n\n", "a", " é😀", "\t", "", '",\n"', "word " * 9]
    return [[str(i), *("".join(draw.choice(bits) for _ in range(draw.randrange(7))) for _ in CSV_COLUMNS[1:])]
            for i in range(count)]


def cells(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_ranges_equal_whole_files(spark, tmp_path, small_ranges, end, seed):
    rows = [[c.replace("\r", "") if end == "\n" else c for c in r] for r in hostile(seed, 120)]
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "a.csv").write_bytes(text_of(rows[:80], end).encode())
    (folder / "b.csv").write_bytes(("﻿" + text_of(rows[80:], end)).encode())
    got = src.csv_scan(spark, str(folder))
    assert C.physical_lines(spark, str(folder)).rdd.getNumPartitions() > 20
    assert cells(got) == sorted(tuple(r) for r in rows)
    whole = spark.read.options(**src.CSV_OPTIONS).option("lineSep", end)
    names = ", ".join(f"{c} string" for c in CSV_COLUMNS)
    assert cells(got) == cells(whole.schema(names).csv(str(folder)).na.fill(""))


def test_a_record_over_many_ranges_and_blank_lines(spark, tmp_path, small_ranges):
    long = ("line \"quoted\"\n\n" * 400).strip()
    rows = [["1", *[""] * 11, long], ["2", *["x"] * 12], ["3", *[""] * 11, "y\n" * 300]]
    path = tmp_path / "one.csv"
    path.write_bytes((text_of(rows, "\n") + "\n\n").encode())
    assert cells(src.csv_scan(spark, str(path))) == sorted(tuple(r) for r in rows)
    path.write_bytes(text_of(rows, "\n").rstrip("\n").encode())
    assert cells(src.csv_scan(spark, str(path))) == sorted(tuple(r) for r in rows)


def test_header_alone_and_wrong_headers(spark, tmp_path, small_ranges):
    path = tmp_path / "one.csv"
    path.write_bytes(text_of([], "\n").encode())
    assert src.csv_scan(spark, str(path)).count() == 0
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.csv").write_bytes(text_of([["1"] * 13], "\n").encode())
    (tmp_path / "data" / "b.csv").write_bytes(text_of([["1"] * 13], "\n").replace("title", "name").encode())
    with pytest.raises(Exception, match="schema"):
        src.csv_scan(spark, str(tmp_path / "data")).collect()


def test_without_a_broadcast(spark, tmp_path, small_ranges, monkeypatch):
    rows = hostile(9, 60)
    path = tmp_path / "one.csv"
    path.write_bytes(text_of(rows, "\r\n").encode())
    monkeypatch.setattr(C, "BROADCAST_RANGES", 0)
    assert cells(src.csv_scan(spark, str(path))) == sorted(tuple(r) for r in rows)
