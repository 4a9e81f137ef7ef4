"""Multi-line CSV files read by many tasks each.

A line end inside quotes closes no record, so a byte range of a file does not know by
itself where its records begin.  Quotes are doubled inside fields; so a line end closes a
record exactly when an even number of quotes stands before it in the file.  One pass
counts quotes per range, a running sum of these counts per file tells whether a range
begins inside quotes, and a second pass cuts every range into records on its own.  What a record
leaves at a range's edges is put together by a small shuffle of those pieces alone.
Records are then parsed by Spark's CSV parser.

Fields with quotes must be quoted, as CSV writers do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanset.plans.durable import durable
from gleanset.schemas import stored_schema

# Ranges counted at or below this many are broadcast to the tasks that cut them.
BROADCAST_RANGES = 200_000

# A piece of a range: a whole record, what comes before the first record end, what follows
# the last one, or a range without any record end.
WHOLE, HEAD, TAIL, MIDDLE = range(4)

_PIECES = "file string, start bigint, kind int, first boolean, record string"


def physical_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines as they stand in the files, with file and range; ranges of a file are separate tasks."""
    read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    lines = read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def range_states(lines: DataFrame) -> DataFrame:
    """``(file, start, inside)``: does the range begin inside quotes?  One row per range."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    return counts.select("file", "start", (before % 2 == 1).alias("inside"))


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """Lines joined by line feeds up to and with each line in ``ends``."""
    offsets = pa.array(np.concatenate([[0], ends + 1]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, lines.cast(pa.string())), "\n")


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and edge pieces of ranges; a range's lines come one after another, in order."""
    at: tuple[str, int] | None = None
    open_lines: list[str] = []  # of a record not closed yet
    odd = headless = fresh = False

    def rows(kinds: list[int], firsts: list[bool], records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(kinds, pa.int32()),
             pa.array(firsts), records],
            ["file", "start", "kind", "first", "record"],
        )

    def leave() -> Iterator[pa.RecordBatch]:
        if open_lines:
            kind = MIDDLE if headless else TAIL
            yield rows([kind], [fresh], pa.array(["\n".join(open_lines)]))

    for batch in batches:
        files, starts = batch.column("file").to_pylist(), np.asarray(batch.column("start"))
        changed = np.flatnonzero(starts[1:] != starts[:-1]) + 1
        changed = sorted({*changed.tolist(), *(i for i in range(1, len(files)) if files[i] != files[i - 1])})
        for a, b in zip([0, *changed], [*changed, batch.num_rows]):
            if a == b:
                continue
            if (files[a], int(starts[a])) != at:
                yield from leave()
                at = files[a], int(starts[a])
                open_lines = []
                odd = headless = bool(batch.column("inside")[a].as_py())
                fresh = at[1] == 0  # the file's first record is still to come
            lines = batch.column("value").slice(a, b - a)
            counts = np.asarray(pc.count_substring(lines, '"'))
            parity = (np.cumsum(counts) + odd) % 2
            ends = np.flatnonzero(parity == 0)
            odd = bool(parity[-1])
            if not len(ends):
                open_lines += lines.to_pylist()
                continue
            last = int(ends[-1]) + 1
            records = _joined(lines.slice(0, last), ends)
            if open_lines:
                begun = "\n".join([*open_lines, records[0].as_py()])
                records = pa.concat_arrays([pa.array([begun]), records.slice(1)])
            kinds = [WHOLE] * len(records)
            firsts = [False] * len(records)
            if headless:
                kinds[0], headless = HEAD, False
            firsts[0], fresh = fresh, False
            yield rows(kinds, firsts, records)
            open_lines = lines.slice(last).to_pylist()
    if at is not None:
        yield from leave()


def _mended(pieces: DataFrame) -> DataFrame:
    """Records that several ranges hold a part of."""
    edges = pieces.where(F.col("kind") != WHOLE)
    # Pieces of a record follow the tail that begins it; only places are ordered here, not texts.
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    begun = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(order)
    spots = edges.select("file", "start", "kind").withColumn("begun", begun)
    parts = edges.join(spots, ["file", "start", "kind"])
    told = F.sort_array(F.collect_list(F.struct("start", "record")))
    whole = parts.groupBy("file", "begun").agg(told.alias("told"), F.max("first").alias("first"))
    return whole.select("first", F.array_join(F.col("told.record"), "\n").alias("record"))


def csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(first, record)``: every record's text; ``first`` marks a file's first record, its header."""
    lines = physical_lines(spark, paths)
    states = durable(range_states(lines))
    if states.count() <= BROADCAST_RANGES:
        # A broadcast join leaves the lines in the order their task reads them.
        met = lines.join(F.broadcast(states), ["file", "start"])
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        met = numbered.join(states, ["file", "start"]).sortWithinPartitions("file", "start", "line")
    pieces = met.select("file", "start", "value", "inside").mapInArrow(cut_records, _PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("first", "record")
    return whole.unionByName(_mended(pieces))


def parsed(records: DataFrame, columns: Sequence[str], options: dict[str, object]) -> DataFrame:
    """Cells of records; a header that is not ``columns`` fails the job, blank lines are no records."""
    told = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k != "header"}
    text = F.regexp_replace("record", "\r$", "")
    text = F.when(F.col("first"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    cells = F.from_csv(text, stored_schema(columns).simpleString()[7:-1].replace(":", " "), told)
    rows = records.where(text != "").select("first", cells.alias("cells"))
    return rows.where(_no_header(columns)).select("cells.*")


def _no_header(columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"cells.{c}").eqNullSafe(F.lit(c))
    wrong = F.raise_error(F.lit(f"unexpected dataset schema: expected {tuple(columns)}"))
    return F.when(~F.col("first"), True).when(same, False).otherwise(wrong.cast("boolean"))
