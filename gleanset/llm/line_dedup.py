"""Site-relative line de-duplication, in DataFrame operations only.

A line is boilerplate of a host when more than ``max_ratio`` of the host's pages
contain it, and at least ``min_pages`` do.  Lines are counted by hash, once per
page, with partial counts per task; the few hashes over the ratio are then counted
again by the lines themselves, so equal hashes of different lines do no harm.

A host has at most (lines per page) / ``max_ratio`` boilerplate lines, so its list
stays short.  All lists are broadcast when they are counted as few; otherwise they are
joined by host, where Spark splits a host with very many pages.

Cases: lines are what ``\\n`` separates, compared as they are; blank lines are never
dropped.  A null text stays null.  Pages with a null host form a host of their own.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.tables import small_enough
from gleanset.operators.dedup import free_names
from gleanset.plans.durable import durable

MAX_RATIO = Fraction(1, 10)
MIN_PAGES = 3
# Boilerplate lines of all hosts together that are broadcast at most.
BROADCAST_LINES = 50_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _told(lines: Column) -> Column:
    return F.filter(lines, lambda line: F.trim(line, F.lit(" \t\r\f\v")) != "")


def boilerplate_lines(
    pages: DataFrame, host: str = "source", text: str = "text",
    *, max_ratio: Fraction = MAX_RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``_host``, ``_line``, pages with the line, and pages of the host, for lines over the ratio."""
    named = pages.select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    totals = named.groupBy("_host").agg(F.count(F.lit(1)).alias("host_pages"))
    over = (F.col("n_pages") >= min_pages) & (
        F.col("n_pages") * max_ratio.denominator > F.col("host_pages") * max_ratio.numerator
    )
    hashes = F.array_distinct(F.transform(_told(_lines(F.col("_text"))), lambda x: F.xxhash64(x)))
    counted = (
        named.select("_host", F.explode(hashes).alias("_hash"))
        .groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
    )
    same_host = F.col("a._host").eqNullSafe(F.col("b._host"))
    suspects = durable(
        counted.alias("a").join(totals.alias("b"), same_host).where(over)
        .select("a._host", "_hash", "host_pages")
    )
    per_host = suspects.groupBy("_host", "host_pages").agg(F.collect_set("_hash").alias("_hashes"))
    suspected = F.filter(
        F.array_distinct(_told(_lines(F.col("_text")))),
        lambda x: F.array_contains("_hashes", F.xxhash64(x)),
    )
    per_host = small_enough(durable(per_host), BROADCAST_LINES)
    return (
        named.alias("a").join(per_host.alias("b"), same_host)
        .select("a._host", "host_pages", F.explode(suspected).alias("_line"))
        .groupBy("_host", "host_pages", "_line").agg(F.count(F.lit(1)).alias("n_pages"))
        .where(over)
    )


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text",
    *, max_ratio: Fraction = MAX_RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """The pages without their host's boilerplate lines, with ``n_lines`` and ``n_dropped`` added.

    Columns of these two names are replaced.
    """
    found = durable(boilerplate_lines(pages, host, text, max_ratio=max_ratio, min_pages=min_pages))
    own_host, bad, hashes, left = free_names(pages.columns, "_host", "_bad", "_bad_hashes", "_kept")
    lists = found.groupBy(F.col("_host").alias(own_host)).agg(
        F.collect_list("_line").alias(bad),
        F.collect_list(F.xxhash64("_line")).alias(hashes),
    )
    lists = F.broadcast(lists) if found.count() <= BROADCAST_LINES else durable(lists)
    columns = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    joined = pages.select(*columns).join(lists, F.col(host).eqNullSafe(F.col(own_host)), "left")
    lines = _lines(F.col(text))
    kept = F.filter(
        lines,
        lambda x: ~(F.array_contains(hashes, F.xxhash64(x)) & F.array_contains(bad, x)),
    )
    kept = F.when(F.col(bad).isNull(), lines).otherwise(kept)
    return joined.withColumn(left, kept).select(
        *[F.array_join(left, "\n").alias(c) if c == text else F.col(c) for c in columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
