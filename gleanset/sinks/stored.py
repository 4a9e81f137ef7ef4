"""Appending to the stored dataset.

Every try of an append writes a folder of its own, checks it, and then publishes a
version of the store that names its files.  Nothing stored is rewritten; a repeated run
takes its first try's place; what fails before it is published is never seen.

Writers do not wait for each other.  One that finds its version's number taken looks at what
the others have added since it read the store, drops its rows that are now known, and tries the
next number.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanset.functions.values import body_digest, epoch_text
from gleanset.schemas import (
    BODY_KEY,
    CSV_COLUMNS,
    LABEL_COLUMNS,
    REVIEW_COLUMNS,
    SOURCE_COLUMNS,
    stored_schema,
)
from gleanset.operators.dedup import stored_keys
from gleanset.sinks.versions import (
    LostRace,
    RunFiles,
    Version,
    discard,
    full_paths,
    latest_number,
    publish,
    read_version,
    run_folders,
    written_files,
)
from gleanset.sources.stored import (
    FIRST_RUN,
    backend_choice,
    backend_columns,
    line_style,
    read_runs,
    run_keys,
    snapshot_read,
)

ROWS_PER_FILE = 1_000_000

CSV_WRITE_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "quoteAll": True,
    "encoding": "UTF-8",
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def check_columns(rows: DataFrame) -> None:
    missing = [c for c in SOURCE_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"new rows lack required columns: {missing}")


def _as_text(rows: DataFrame, column: str) -> Column:
    kind = rows.schema[column].dataType
    value = F.col(column)
    text = epoch_text(value) if isinstance(kind, T.DoubleType) else value.cast("string")
    return F.coalesce(text, F.lit("")).alias(column)


def csv_rows(rows: DataFrame) -> DataFrame:
    """The 13 stored text columns; a label the rows carry is kept, others are blank."""
    check_columns(rows)
    labels = [
        _as_text(rows, c) if c in rows.columns else F.lit("").alias(c) for c in LABEL_COLUMNS
    ]
    return rows.select(*[_as_text(rows, c) for c in SOURCE_COLUMNS], *labels)


def grid_append(rows: DataFrame) -> DataFrame:
    """The 14 stored text columns; labels and review are always blank."""
    check_columns(rows)
    blanks = [F.lit("").alias(c) for c in LABEL_COLUMNS + REVIEW_COLUMNS]
    return rows.select(*[_as_text(rows, c) for c in SOURCE_COLUMNS], *blanks)


def _quoted_lines(rows: DataFrame) -> DataFrame:
    quoted = [
        F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in rows.columns
    ]
    return rows.select(F.concat_ws(",", *quoted).alias("value"))


def _crlf_files(rows: DataFrame, rows_per_file: int, with_blank: bool) -> DataFrame:
    """Lines of CSV files that each start with the header, at most so many rows to a file.

    Files are cut by task and by place in the task, so no row is moved; the writer
    starts a new file at every ``file``.  ``with_blank`` adds a file of the header alone, so
    that a store without rows has its columns and line end.
    """
    header = ",".join(f'"{c}"' for c in CSV_COLUMNS)
    place = F.monotonically_increasing_id()
    in_task = place.bitwiseAND(F.lit((1 << 33) - 1))
    file = F.concat_ws("-", F.shiftright(place, 33), F.floor(in_task / rows_per_file))
    lines = _quoted_lines(rows).select("value", place.alias("place"), file.alias("file"))
    first = in_task % rows_per_file == 0
    lines = lines.select(
        F.when(first, F.concat(F.lit(header + "\r\n"), "value")).otherwise(F.col("value")).alias("value"),
        "file",
        "place",
    )
    # The writer asks for rows by file; by place too, a file's header row comes first.
    lines = lines.sortWithinPartitions("file", "place").drop("place")
    if with_blank:
        blank = rows.sparkSession.createDataFrame([(header, "header")], "value string, file string")
        lines = lines.unionByName(blank)
    return lines


def check_run(run: str) -> str:
    """A run's name is a folder name, and never that of the first run."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run) or run == FIRST_RUN:
        raise ValueError(f"no name for a run: {run!r}")
    return run


def _write_run(
    rows: DataFrame, path: str, backend: str, run: str, rows_per_file: int, line_end: str
) -> str:
    """Write rows to a new folder of the run and return it, as a path below the store."""
    if rows_per_file < 1:
        raise ValueError("rows per file must be at least 1")
    folder = f"run={run}/try={uuid.uuid4().hex}"
    target = f"{path}/{folder}"
    if backend_choice(backend) == "sheets":
        digest = F.when(F.col("selftext") == "", "").otherwise(body_digest(F.col("selftext")))
        keyed = rows.withColumn(BODY_KEY, digest)
        keyed.write.option("maxRecordsPerFile", rows_per_file).parquet(target)
    elif line_end == "\n":
        writer = rows.write.option("maxRecordsPerFile", rows_per_file)
        writer.options(**CSV_WRITE_OPTIONS).csv(target)
    else:
        # The CSV writer would turn line feeds inside bodies into this line end too.
        lines = _crlf_files(rows, rows_per_file, with_blank=run == FIRST_RUN)
        lines.write.option("lineSep", line_end).partitionBy("file").text(target)
    return folder


def _checked(spark: SparkSession, path: str, backend: str, run: str, folder: str, sent: int) -> RunFiles:
    """What a folder holds, read back; for CSV its keys are written beside it on the way."""
    found = RunFiles(run, written_files(spark, path, folder), sent)
    rows = run_rows(spark, path, backend, found)
    if backend_choice(backend) == "csv":
        seen = Observation()
        keys = f"_keys/{folder}"
        stored_keys(rows.observe(seen, F.count(F.lit(1)).alias("n"))).write.parquet(f"{path}/{keys}")
        count = seen.get["n"]
        found = RunFiles(run, found.files, sent, written_files(spark, path, keys))
    else:
        count = rows.count()
    if count != sent:
        discard(spark, path, folder)
        raise RuntimeError(f"run {run} holds {count} rows; expected {sent}")
    return found


def _written(
    ready: DataFrame, path: str, backend: str, run: str, rows_per_file: int, line_end: str
) -> RunFiles:
    sent = Observation()
    counted = ready.observe(sent, F.count(F.lit(1)).alias("n"))
    folder = _write_run(counted, path, backend, run, rows_per_file, line_end)
    return _checked(ready.sparkSession, path, backend, run, folder, sent.get["n"])


def current_version(spark: SparkSession, path: str) -> Version:
    """The newest version; one before the first for a folder that another tool has made."""
    found = read_version(spark, path)
    if found is not None:
        return found
    runs = [RunFiles(run, written_files(spark, path, f"run={run}"), -1) for run in run_folders(spark, path)]
    return Version(-1, tuple(runs))


def adopt_run(spark: SparkSession, path: str, run: str) -> None:
    """Let a store have the files that another tool has put into a run's folder."""
    check_run(run)
    _publish(spark, path, current_version(spark, path), RunFiles(run, written_files(spark, path, f"run={run}"), -1))


def _publish(spark: SparkSession, path: str, base: Version, added: RunFiles) -> None:
    """Publish a run after whatever others have published meanwhile."""
    while True:
        try:
            return publish(spark, path, base.with_run(added))
        except LostRace:
            base = current_version(spark, path)


def create_store(
    spark: SparkSession,
    path: str,
    backend: str = "csv",
    rows: DataFrame | None = None,
    line_end: str = "\n",
) -> None:
    """Start a store with its schema, and with rows when given; an existing store is an error."""
    if latest_number(spark, path) is not None or run_folders(spark, path):
        raise ValueError(f"a store exists at {path}")
    if rows is None:
        ready = spark.createDataFrame([], stored_schema(backend_columns(backend)))
    else:
        ready = csv_rows(rows) if backend_choice(backend) == "csv" else grid_append(rows)
    first = _written(ready, path, backend, FIRST_RUN, ROWS_PER_FILE, line_end)
    publish(spark, path, Version(-1, ()).with_run(first))


def csv_append(
    rows: DataFrame,
    path: str,
    run: str,
    *,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Add rows to a CSV store as one run, with the line ends the store uses."""
    check_run(run)
    spark = rows.sparkSession
    base = current_version(spark, path)
    line_end = store_line_end(spark, path, base)
    _publish(spark, path, base, _written(csv_rows(rows), path, "csv", run, rows_per_file, line_end))


def store_line_end(spark: SparkSession, path: str, version: Version) -> str:
    """The line end of a CSV store's first file."""
    files = [f for r in version.runs if r.run == FIRST_RUN for f in r.files]
    return line_style(spark, full_paths(path, files)[0]) if files else "\n"


def verified_append(
    rows: DataFrame,
    path: str,
    run: str,
    backend: str = "csv",
    *,
    rows_per_file: int = ROWS_PER_FILE,
    since: Version | None = None,
    renew: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Append one run, read its files back, publish it, and return its row count.

    Raises when the files hold another number of rows than was written; then nothing
    is published.  Without rows nothing is written at all.  ``rows`` is computed more than once,
    so it should be durable.

    ``since`` is the version that ``rows`` were judged against, the newest by default.  If
    others have published since, ``renew`` gets the keys that they have added (see
    ``stored_keys``) and returns the rows that are still new; without it rows are taken as they are.
    """
    check_run(run)
    if rows_per_file < 1:
        raise ValueError("rows per file must be at least 1")
    spark = rows.sparkSession
    backend = backend_choice(backend)
    base = current_version(spark, path) if since is None else since
    while rows.take(1):
        if backend == "csv":
            ready, line_end = csv_rows(rows), store_line_end(spark, path, base)
        else:
            ready, line_end = grid_append(rows), "\n"
        added = _written(ready, path, backend, run, rows_per_file, line_end)
        while True:
            try:
                publish(spark, path, base.with_run(added))
                return added.rows
            except LostRace:
                newest = current_version(spark, path)
                won = tuple(r for r in newest.since(base) if r.run != run)
                base = newest
                if renew is not None and won:
                    break
        for folder in {"/".join(f.split("/")[:2]) for f in added.files}:
            discard(spark, path, folder)
        rows = renew(run_keys(spark, path, backend, won))
    return 0


def run_rows(spark: SparkSession, path: str, backend: str, run: str | RunFiles) -> DataFrame:
    """The rows that one run added: a published one by name, or a try by its files."""
    if isinstance(run, RunFiles):
        return read_runs(spark, path, backend, (run,))
    return snapshot_read(spark, path, backend, only_run=run)
