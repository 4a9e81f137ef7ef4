import csv
import io

import pytest

from gleanset.operators import dedup, reports
from gleanset.plans.durable import shared_folder
from gleanset.schemas import CSV_COLUMNS, GRID_COLUMNS, SOURCE_COLUMNS
from gleanset.sinks import stored as sink
from gleanset.sources import stored as src

CLEAN = ", ".join(f"{c} {'double' if c == 'created_utc' else 'string'}" for c in SOURCE_COLUMNS)
HOSTILE = [
    "plain", "", " ", "  both ends  ", 'a "quoted" word', '"', '""', "back\\slash", '\\"', "tab\there",
    "line\nfeed", "carriage\r\nreturn", "lone\rreturn", "#comment", "a,b;c", "naïve 字 😀", "\n", "﻿mark",
    "end\\", "'single'", "trailing newline\n", "NULL", "null",
]


def clean_rows(spark, bodies=HOSTILE, prefix="p"):
    rows = [
        ("s", f"{prefix}{k}", f" title {k} ", None if k % 2 else "a", 1972857600.0 + k / 4,
         "2032-07-08T00:00:00+00:00", "u", body)
        for k, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, CLEAN)


def bodies_of(frame):
    return {r.id: r.selftext for r in frame.collect()}


def part_bytes(path):
    return [p.read_bytes() for p in sorted(path.rglob("part-*")) if "_keys" not in p.parts]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_csv_round_trip_here_and_with_pythons_reader(spark, tmp_path, line_end):
    store = tmp_path / "store"
    sink.create_store(spark, str(store), "csv", clean_rows(spark), line_end)
    wanted = {f"p{k}": b for k, b in enumerate(HOSTILE)}
    back = src.snapshot_read(spark, str(store))
    assert back.columns == list(CSV_COLUMNS)
    assert bodies_of(back) == wanted
    assert {r.created_utc for r in back.collect()} >= {"1972857600.0", "1972857600.25"}
    by_python = {}
    for raw in part_bytes(store):
        reader = csv.DictReader(io.StringIO(raw.decode(), newline=""))
        assert tuple(reader.fieldnames) == CSV_COLUMNS
        by_python |= {r["id"]: r["selftext"] for r in reader}
    assert by_python == wanted
    assert src.line_style(spark, str(store)) == line_end


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_append_keeps_stored_bytes_and_line_ends(spark, tmp_path, line_end):
    store = tmp_path / "store"
    sink.create_store(spark, str(store), "csv", clean_rows(spark), line_end)
    before = part_bytes(store)
    sink.csv_append(clean_rows(spark, ["x\ny"], "q").coalesce(1), str(store), "two")
    after = part_bytes(store)
    assert set(before) < set(after)
    (added,) = set(after) - set(before)
    assert added.endswith(line_end.encode())
    assert added.count(b"\r\n") == (2 if line_end == "\r\n" else 0)
    assert bodies_of(src.snapshot_read(spark, str(store), only_run="two")) == {"q0": "x\ny"}


def test_csv_keeps_labels_and_grid_blanks_them(spark):
    rows = clean_rows(spark, ["b"]).selectExpr("*", "'yes' as label2", "'m' as matched_tools")
    in_csv = sink.csv_rows(rows).first().asDict()
    assert (in_csv["label1"], in_csv["label2"]) == ("", "yes")
    assert tuple(in_csv) == CSV_COLUMNS
    in_grid = sink.grid_append(rows).first().asDict()
    assert tuple(in_grid) == GRID_COLUMNS
    assert {in_grid[c] for c in GRID_COLUMNS[8:]} == {""}


@pytest.mark.parametrize("prepare", [sink.csv_rows, sink.grid_append])
def test_missing_column_is_refused(spark, prepare):
    with pytest.raises(ValueError, match="url"):
        prepare(clean_rows(spark).drop("url"))


def write(tmp_path, raw):
    path = tmp_path / "data.csv"
    path.write_bytes(raw)
    return str(path)


HEADER = ",".join(CSV_COLUMNS)


def test_foreign_csv_file(spark, tmp_path):
    raw = '﻿' + HEADER + '\r\ns,p,"two\r\nlines ""q""",a,1.0,i,u,"x\ny",,,,,\r\ns,short\r\n'
    rows = src.csv_scan(spark, write(tmp_path, raw.encode())).collect()
    assert rows[0].title == 'two\r\nlines "q"'
    assert rows[0].selftext == "x\ny"
    assert rows[1].asDict()["id"] == "short" and rows[1].selftext == ""


@pytest.mark.parametrize("header", ["id,title", HEADER + ",extra", HEADER.upper(), ""])
def test_wrong_header_is_refused(spark, tmp_path, header):
    with pytest.raises(ValueError, match="schema"):
        src.csv_scan(spark, write(tmp_path, header.encode() + b"\na,b\n"))


def test_every_file_of_a_store_must_have_the_header(spark, tmp_path):
    store = tmp_path / "store"
    sink.create_store(spark, str(store), "csv", clean_rows(spark))
    other = store / "run=zz"
    other.mkdir()
    (other / "part-0.csv").write_text(HEADER.replace("title", "name") + "\n" + "a," * 12 + "b\n")
    sink.adopt_run(spark, str(store), "zz")
    with pytest.raises(Exception):
        src.snapshot_read(spark, str(store)).collect()


GRID = "row_no bigint, cells array<string>"


def test_grid_rows_are_cut_filled_and_blanked(spark):
    pages = spark.createDataFrame(
        [
            (1, list(GRID_COLUMNS)),
            (2, ["s", "p", None, "a"]),
            (3, [str(k) for k in range(20)]),
            (4, []),
        ],
        GRID,
    )
    rows = {r.id: r for r in src.grid_scan(pages).collect()}
    assert (rows["p"].title, rows["p"].commentable) == ("", "")
    assert rows["1"].commentable == "13"
    assert "" in rows


@pytest.mark.parametrize(
    "values", [[], [(1, ["id"])], [(1, [*GRID_COLUMNS, "more"])], [(1, list(CSV_COLUMNS))]]
)
def test_wrong_grid_header_is_refused(spark, values):
    with pytest.raises(ValueError):
        src.grid_scan(spark.createDataFrame(values, GRID))


def test_backend_names(spark):
    assert src.backend_choice(" Sheets ") == "sheets"
    assert src.backend_choice() == "csv"
    with pytest.raises(ValueError):
        src.backend_choice("excel")


@pytest.mark.parametrize("backend", ["csv", "sheets"])
def test_verified_append(spark, tmp_path, backend):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, backend)
    assert src.snapshot_read(spark, store, backend).count() == 0
    rows = clean_rows(spark, [f"b{k}" for k in range(250)])
    assert sink.verified_append(rows, store, "one", backend, rows_per_file=100) == 250
    # A repeated run replaces its own rows.
    assert sink.verified_append(rows, store, "one", backend) == 250
    assert src.snapshot_read(spark, store, backend).count() == 250
    assert src.snapshot_read(spark, store, backend, except_run="one").count() == 0
    assert sink.verified_append(rows.limit(0), store, "two", backend) == 0
    assert not (tmp_path / "store" / "run=two").exists()
    with pytest.raises(ValueError):
        sink.verified_append(rows, store, "three", backend, rows_per_file=0)


def test_store_is_made_once_and_runs_need_names(spark, tmp_path):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "sheets")
    with pytest.raises(Exception, match="exist"):
        sink.create_store(spark, store, "sheets")
    for name in ("", "a/b", "a=b", sink.FIRST_RUN):
        with pytest.raises(ValueError):
            sink.verified_append(clean_rows(spark), store, name, "sheets")


def test_append_that_does_not_add_up_fails(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "sheets")
    real = sink.run_rows
    monkeypatch.setattr(sink, "run_rows", lambda *a: real(*a).limit(1))
    with pytest.raises(RuntimeError, match="expected 2"):
        sink.verified_append(clean_rows(spark, ["a", "b"]), store, "one", "sheets")


def test_stats_count_every_file_once(spark, tmp_path):
    path = tmp_path / "data"
    clean_rows(spark).repartition(3).write.parquet(str(path))
    stats = src.dataset_stats(spark.read.parquet(str(path))).first()
    size = sum(len(b) for b in part_bytes(path))
    assert tuple(stats) == (len(HOSTILE), 8, size)


def test_audit(spark, tmp_path):
    before = spark.createDataFrame([("a",), ("",), ("",)], "id string")
    after = spark.createDataFrame([("a",), ("",), ("",), ("b",), ("b",)], "id string")
    audit = reports.store_audit(before, after, 2).first()
    assert tuple(audit) == (True, 3, 5, True, 1)


def test_stored_rows_reject_candidates(spark, tmp_path):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "csv", clean_rows(spark))
    again = dedup.ordered_dedup(clean_rows(spark), src.snapshot_read(spark, store), ["id"])
    assert again.count() == 0


def test_named_checkpoint_folder_is_used(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_digests_stand_for_stored_bodies(spark, tmp_path):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "sheets", clean_rows(spark))
    keys = src.snapshot_keys(spark, store, "sheets")
    wanted = dedup.stored_keys(src.snapshot_read(spark, store, "sheets"))
    pairs = sorted(map(repr, wanted.collect()))
    assert sorted(map(repr, keys.collect())) == pairs
    scans = [p for p in keys._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in p]
    assert any("ReadSchema: struct<id:string,body_key:string>" in p for p in scans)
    # Another tool adds a run without digests.
    other = src.snapshot_read(spark, store, "sheets").where("id = 'p0'")
    other.selectExpr("'q' as id", "'own body' as selftext").write.parquet(f"{store}/run=other")
    sink.adopt_run(spark, store, "other")
    more = src.snapshot_keys(spark, store, "sheets")
    assert more.count() == keys.count() + 1
    new = clean_rows(spark, ["own body", "plain", "new body"], "n")
    assert [r.id for r in dedup.ordered_dedup(new, more, ["id"]).collect()] == ["n2"]
    assert src.snapshot_keys(spark, store, "sheets", except_run="other").count() == keys.count()


def test_reading_for_dedup_needs_two_columns(spark, tmp_path):
    store = str(tmp_path / "store")
    sink.create_store(spark, store, "sheets", clean_rows(spark))
    two = src.snapshot_read(spark, store, "sheets").select("id", "selftext")
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,selftext:string>" in plan
