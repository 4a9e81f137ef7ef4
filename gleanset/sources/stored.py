"""Reading the stored dataset: CSV files, grid pages, and run-partitioned stores.

A store is a folder with one sub-folder per append, ``run=<id>``, and a list of
versions (see ``sinks.versions``).  Readers take the files that a version names, the
newest unless told otherwise; what no version names is not there.  A folder without any
version, as another tool may leave it, is read whole.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.operators.dedup import id_key, stored_keys
from gleanset.sinks.versions import RunFiles, full_paths, read_version
from gleanset.sources.csv_ranges import csv_records, parsed
from gleanset.schemas import BODY_KEY, CSV_COLUMNS, GRID_COLUMNS, stored_schema

BACKENDS = ("csv", "sheets")
FIRST_RUN = "start"

# Quotes are doubled, bodies keep their blanks and line ends, empty is empty.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "enforceSchema": False,
    "mode": "PERMISSIVE",
}


def backend_choice(name: str = "csv") -> str:
    """The storage format a setting names: ``csv`` or ``sheets`` (grid rows, kept as Parquet)."""
    backend = name.strip().lower()
    if backend not in BACKENDS:
        raise ValueError(f"storage must be one of {', '.join(BACKENDS)}; got {name!r}")
    return backend


def backend_columns(backend: str) -> tuple[str, ...]:
    return CSV_COLUMNS if backend_choice(backend) == "csv" else GRID_COLUMNS


def _first_line(spark: SparkSession, path: str) -> str | None:
    """First physical line of one file, its carriage return included."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    row = reader.text(path).first()
    return None if row is None else row[0]


def line_style(spark: SparkSession, path: str) -> str:
    """The line end that the files at the path use."""
    line = _first_line(spark, path)
    return "\r\n" if line is not None and line.endswith("\r") else "\n"


def _check_header(line: str | None, expected: tuple[str, ...]) -> None:
    text = (line or "").removeprefix("\ufeff").rstrip("\r")
    found = tuple(next(csv.reader([text]), ()))
    if found != expected:
        raise ValueError(f"unexpected dataset schema: expected {expected}, found {found}")


def _blank_nulls(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return frame.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def csv_scan(spark: SparkSession, path: str) -> DataFrame:
    """A CSV dataset of 13 text columns; missing cells are empty strings.

    The header must be exact: one file is checked here, every file when read.
    Bodies span lines; a large file is read by many tasks all the same (see ``csv_ranges``).
    """
    _check_header(_first_line(spark, path), CSV_COLUMNS)
    return _csv_cells(spark, path)


def _csv_cells(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return _blank_nulls(parsed(csv_records(spark, paths), CSV_COLUMNS, CSV_OPTIONS), CSV_COLUMNS)


def grid_scan(pages: DataFrame) -> DataFrame:
    """Ragged rows ``(row_no, cells)`` to 14 text columns; the first row is the header.

    Rows are cut or filled to width.  The header is not: it must match exactly.
    """
    cells = F.transform(F.col("cells").cast("array<string>"), lambda c: F.coalesce(c, F.lit("")))
    width = len(GRID_COLUMNS)
    head = pages.select("row_no", cells.alias("cells")).orderBy("row_no").limit(1).collect()
    if not head:
        raise ValueError("the grid is empty; a header row is expected")
    header_no, header = head[0]
    if tuple(header) != GRID_COLUMNS:
        raise ValueError(f"unexpected dataset schema: expected {GRID_COLUMNS}, found {header}")
    filled = F.slice(F.concat(cells, F.array_repeat(F.lit(""), width)), 1, width)
    body = pages.where(F.col("row_no") != header_no).select(filled.alias("cells"))
    return body.select(*[F.col("cells")[i].alias(c) for i, c in enumerate(GRID_COLUMNS)])


def runs_of(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    except_run: str | None = None,
    only_run: str | None = None,
) -> tuple[RunFiles, ...] | None:
    """The runs of a version, the newest by default; None for a folder without versions."""
    found = read_version(spark, path, version)
    if found is None:
        return None
    return tuple(
        r for r in found.runs if r.run != except_run and (only_run is None or r.run == only_run)
    )


def snapshot_read(
    spark: SparkSession,
    path: str,
    backend: str = "csv",
    *,
    except_run: str | None = None,
    only_run: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Stored rows of a store, lazily; select few columns and only those are read.

    ``except_run`` leaves out one run's own files, so that a repeated run sees
    what its first try saw; ``only_run`` reads nothing else.  ``version`` reads the
    store as it was then, whatever has been appended since.
    """
    backend = backend_choice(backend)
    runs = runs_of(spark, path, version, except_run, only_run)
    if runs is not None:
        return read_runs(spark, path, backend, runs)
    columns = backend_columns(backend)
    schema = stored_schema(columns).add(T.StructField("run", T.StringType()))
    if backend == "csv":
        _check_header(_first_line(spark, f"{path}/run={FIRST_RUN}"), columns)
        # Only to find the folder's runs; their files are read by ranges.
        named = spark.read.schema("value string, run string").text(path).inputFiles()
        runs = {f: f.rpartition("/run=")[2].partition("/")[0] for f in named}
        chosen = [f for f, r in runs.items() if r != except_run and (only_run is None or r == only_run)]
        return _csv_cells(spark, chosen) if chosen else _no_rows(spark, columns)
    rows = spark.read.schema(schema).parquet(path)
    if except_run is not None:
        rows = rows.where(F.col("run") != except_run)
    if only_run is not None:
        rows = rows.where(F.col("run") == only_run)
    return _blank_nulls(rows, columns)


def _no_rows(spark: SparkSession, columns: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([], stored_schema(columns))


def read_runs(spark: SparkSession, path: str, backend: str, runs: tuple[RunFiles, ...]) -> DataFrame:
    """The rows of some runs of a store."""
    columns = backend_columns(backend)
    files = full_paths(path, [f for r in runs for f in r.files])
    if not files:
        return _no_rows(spark, columns)
    if backend_choice(backend) == "csv":
        return _csv_cells(spark, files)
    return _blank_nulls(spark.read.schema(stored_schema(columns)).parquet(*files), columns)


def snapshot_keys(
    spark: SparkSession,
    path: str,
    backend: str = "csv",
    *,
    except_run: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Ids and body digests of a store, null where blank: all that de-duplication needs.

    Grid stores keep the digest of every body beside it, so bodies are not read; CSV
    stores have a file of keys beside each run, so nothing is parsed.  Rows that
    another tool wrote have neither; theirs are worked out, and the
    scan for them skips all row groups that have no such row.
    """
    backend = backend_choice(backend)
    runs = runs_of(spark, path, version, except_run)
    if runs is not None:
        return run_keys(spark, path, backend, runs)
    if backend == "csv":
        return stored_keys(snapshot_read(spark, path, backend, except_run=except_run))
    schema = stored_schema(_KEY_COLUMNS).add(T.StructField("run", T.StringType()))
    rows = spark.read.schema(schema).parquet(path)
    if except_run is not None:
        rows = rows.where(F.col("run") != except_run)
    return _grid_keys(rows)


_KEY_COLUMNS = ("id", "selftext", BODY_KEY)
_KEYS = "id_key string, text_key string"


def _grid_keys(rows: DataFrame) -> DataFrame:
    digest = F.when(F.col(BODY_KEY) != "", F.col(BODY_KEY))
    keyed = rows.where(F.col(BODY_KEY).isNotNull()).select(
        id_key().alias("id_key"), digest.alias("text_key")
    )
    return keyed.unionByName(stored_keys(rows.where(F.col(BODY_KEY).isNull())))


def run_keys(spark: SparkSession, path: str, backend: str, runs: tuple[RunFiles, ...]) -> DataFrame:
    """Ids and body digests of some runs of a store."""
    if backend_choice(backend) == "sheets":
        files = full_paths(path, [f for r in runs for f in r.files])
        if not files:
            return spark.createDataFrame([], _KEYS)
        return _grid_keys(spark.read.schema(stored_schema(_KEY_COLUMNS)).parquet(*files))
    keys = full_paths(path, [f for r in runs for f in r.keys])
    found = spark.read.schema(_KEYS).parquet(*keys) if keys else spark.createDataFrame([], _KEYS)
    bare = tuple(r for r in runs if not r.keys)
    return found.unionByName(stored_keys(read_runs(spark, path, backend, bare))) if bare else found


def dataset_stats(rows: DataFrame) -> DataFrame:
    """Rows, columns, and bytes of a file-backed dataset; every file's size counts once.

    Needs the frame as read from files, before any projection.
    """
    width = len(rows.columns)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size")
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(width).alias("n_columns"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"),
    )
