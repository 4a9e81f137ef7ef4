"""Coverage, provenance, and counters, all as small DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.functions.text import search_text, term_matches
from gleanset.functions.values import epoch_to_iso, percent, window_hours
from gleanset.operators.search import batch_funnel, funnel_total, newest_first
from gleanset.operators.sets import distinct_by_id
from gleanset.sources.curated import community_counts


def _bounds(flag: Column | None, prefix: str) -> list[Column]:
    at = F.col("created_utc") if flag is None else F.when(flag, F.col("created_utc"))
    return [F.max(at).alias(f"{prefix}_newest_at"), F.min(at).alias(f"{prefix}_oldest_at")]


def coverage_report(ranked: DataFrame, n_groups: int) -> DataFrame:
    """Per query group: candidates, exact matches, their share, and the time both span.

    ``ranked`` has ``batch``, ``created_utc``, ``exact``.  A group without rows is
    listed with zeros and no bounds.
    """
    per_group = ranked.groupBy("batch").agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("exact").alias("exact"),
        *_bounds(None, "raw"),
        *_bounds(F.col("exact"), "exact"),
    )
    numbers = ranked.sparkSession.range(1, n_groups + 1)
    groups = numbers.select(F.col("id").cast("int").alias("batch"))
    full = groups.join(per_group, "batch", "left").withColumns(
        {"raw": F.coalesce("raw", F.lit(0)), "exact": F.coalesce("exact", F.lit(0))}
    )
    spans = []
    for p in ("raw", "exact"):
        newest, oldest = F.col(f"{p}_newest_at"), F.col(f"{p}_oldest_at")
        spans += [
            epoch_to_iso(newest).alias(f"{p}_newest"),
            epoch_to_iso(oldest).alias(f"{p}_oldest"),
            window_hours(newest, oldest).alias(f"{p}_hours"),
        ]
    share = percent(F.col("exact"), F.col("raw")).alias("exact_pct")
    return full.select("batch", "raw", "exact", share, *spans)


def coverage_total(ranked: DataFrame) -> DataFrame:
    """Sums over groups against distinct posts; their difference is the overlap of the groups."""
    per_post = ranked.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if("exact").alias("n_exact"),
        *_bounds(None, "raw"),
        *_bounds(F.col("exact"), "exact"),
    )
    return per_post.agg(
        F.coalesce(F.sum("n_raw"), F.lit(0)).alias("summed_raw"),
        F.count(F.lit(1)).alias("distinct_raw"),
        F.coalesce(F.sum("n_exact"), F.lit(0)).alias("summed_exact"),
        F.count_if(F.col("n_exact") > 0).alias("distinct_exact"),
        epoch_to_iso(F.max("raw_newest_at")).alias("raw_newest"),
        epoch_to_iso(F.min("raw_oldest_at")).alias("raw_oldest"),
        epoch_to_iso(F.max("exact_newest_at")).alias("exact_newest"),
        epoch_to_iso(F.min("exact_oldest_at")).alias("exact_oldest"),
    )


def cooccurrence(posts: DataFrame, a: str, b: str, case_sensitive: bool = False) -> DataFrame:
    """Posts with both terms, one of them, or neither; all four cells are listed."""
    text = search_text()
    has_a = F.coalesce(term_matches(text, a, case_sensitive), F.lit(False))
    has_b = F.coalesce(term_matches(text, b, case_sensitive), F.lit(False))
    marked = posts.select(has_a.alias("a"), has_b.alias("b"))
    both = F.col("a") & F.col("b")
    cells = {
        "both": both,
        "only_a": F.col("a") & ~F.col("b"),
        "only_b": F.col("b") & ~F.col("a"),
        "neither": ~(F.col("a") | F.col("b")),
    }
    one_row = marked.agg(*[F.count_if(c).alias(n) for n, c in cells.items()])
    pairs = [F.struct(F.lit(n).alias("cell"), F.col(n).alias("posts")) for n in cells]
    return one_row.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")


def limit_report(exact: DataFrame, rows: int = 20) -> DataFrame:
    """The newest exact matches, for reading."""
    return exact.orderBy(*newest_first()).limit(rows)


def provenance(survivors: DataFrame, curated: DataFrame, searched: DataFrame) -> DataFrame:
    """Tag kept rows with the stream or streams that held their id before de-duplication.

    The matched terms come from the last searched copy of the id, and are empty
    lists for ids that only the curated stream held.
    """
    in_curated = curated.select(F.col("post_id").alias("id")).distinct()
    in_curated = in_curated.withColumn("in_curated", F.lit(True))
    columns = ["post_id", "matched_pain_keywords", "matched_tools", "batch", "rank"]
    last = distinct_by_id(searched.select(columns), ["batch", "rank"])
    in_searched = last.select(
        F.col("post_id").alias("id"),
        "matched_pain_keywords",
        "matched_tools",
        F.lit(True).alias("in_searched"),
    )
    tagged = survivors.join(in_curated, "id", "left").join(in_searched, "id", "left")
    none = F.array().cast("array<string>")
    return tagged.select(
        *survivors.columns,
        F.when(F.col("in_curated") & F.col("in_searched"), "curated+global")
        .when(F.col("in_curated"), "curated")
        .otherwise("global")
        .alias("source"),
        F.coalesce("matched_pain_keywords", none).alias("matched_pain_keywords"),
        F.coalesce("matched_tools", none).alias("matched_tools"),
    )


def run_result(
    stages: dict[str, DataFrame | None],
    uploaded: bool,
) -> DataFrame:
    """Rows of every stage as one row: one pass, one aggregate.

    A stage given as None counts zero.  ``combined_candidates`` is the sum of the
    two streams, before de-duplication.
    """
    present = {n: f for n, f in stages.items() if f is not None}
    if not present:
        raise ValueError("a run has at least one stage")
    marks = None
    for name, frame in present.items():
        mark = frame.select(F.lit(name).alias("stage"))
        marks = mark if marks is None else marks.unionByName(mark)
    counts = marks.agg(
        *[F.count_if(F.col("stage") == n).alias(n) for n in stages],
    )
    both = F.col("curated_posts") + F.col("global_posts")
    return counts.select(
        "existing_rows",
        "curated_posts",
        "global_posts",
        both.alias("combined_candidates"),
        "unique_posts",
        F.lit(uploaded).alias("uploaded"),
    )


def run_reports(
    curated: DataFrame | None,
    communities: Sequence[str],
    found: DataFrame | None,
    batches: Sequence[Sequence[str]],
) -> DataFrame:
    """What each part of a run found; one row per ``kind``, ``number``, and ``name``.

    ``community``: ``posts`` of each listed community within the lookback, by place in the list.
    ``batch``: per search, its ``raw`` candidates, those ``within_lookback``, and ``posts`` first
    accepted there; its terms are the name.  ``search``: distinct ``posts`` over all
    searches, whose number it carries.  A stream given as None has no rows.  ``found`` comes
    from ``global_candidates``.
    """
    if curated is None and found is None:
        raise ValueError("a run has at least one stream")
    none = F.lit(None).cast("bigint")
    parts = []
    if curated is not None:
        listed = community_counts(curated, communities)
        parts.append(listed.select(
            F.lit("community").alias("kind"), F.col("list_pos").cast("int").alias("number"),
            F.col("community").alias("name"), none.alias("raw"), none.alias("within_lookback"), "posts",
        ))
    if found is not None:
        names = F.array(*[F.lit(", ".join(b)) for b in batches])
        parts.append(batch_funnel(found, len(batches)).select(
            F.lit("batch").alias("kind"), F.col("batch").alias("number"),
            F.element_at(names, F.col("batch")).alias("name"), "raw", "within_lookback",
            F.col("new_exact").alias("posts"),
        ))
        parts.append(funnel_total(found, len(batches)).select(
            F.lit("search").alias("kind"), F.col("batches").alias("number"), F.lit("all").alias("name"),
            none.alias("raw"), none.alias("within_lookback"), F.col("distinct_matches").alias("posts"),
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def store_audit(before: DataFrame, after: DataFrame, expected_new: int) -> DataFrame:
    """After a write: is the schema the same, did the row count grow as it should, are ids unique?

    Rows without an id are exempt from the last check.
    """
    sides = before.select(F.lit(0).alias("is_after"), "id").unionByName(
        after.select(F.lit(1).alias("is_after"), "id")
    )
    per_id = sides.groupBy("id").agg(
        F.count_if(F.col("is_after") == 0).alias("n_before"),
        F.count_if(F.col("is_after") == 1).alias("n_after"),
    )
    named = F.coalesce("id", F.lit("")) != ""
    totals = per_id.agg(
        F.coalesce(F.sum("n_before"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("n_after"), F.lit(0)).alias("rows_after"),
        F.count_if(named & (F.col("n_after") > 1)).alias("duplicate_ids"),
    )
    grew = F.col("rows_after") - F.col("rows_before")
    return totals.select(
        F.lit(before.columns == after.columns).alias("same_schema"),
        "rows_before",
        "rows_after",
        (grew == expected_new).alias("grew_as_expected"),
        "duplicate_ids",
    )
