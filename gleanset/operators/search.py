"""Batched keyword search: newest candidates per batch, then cutoff, match, first seen."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanset import vocabulary as V
from gleanset.functions.text import any_term, search_text
from gleanset.operators.matching import batch_cross, matched_arrays
from gleanset.sources.curated import cutoff_epoch, day_prefilter

# First-level slices per batch.  Each holds the newest rows of some input
# partitions; the last level then ranks at most limit x SLICES rows per batch.
SLICES = 64


def newest_first() -> list[Column]:
    """Newest first; ties by id, then by content, so that reruns agree."""
    return [F.desc("created_utc"), F.asc("post_id"), F.asc("title"), F.asc("text")]


def newest_sort(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("created_utc"), F.asc("post_id"))


def topn_per_batch(candidates: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` rows of every batch, with their ``rank`` from 1.

    Two levels: rows are first cut within slices made of whole input partitions,
    so a batch that holds most rows is still ranked by many tasks.  The slice
    of a row is its task's number, which a retried task keeps.
    """
    if limit <= 0:
        raise ValueError("search limit must be positive")
    sliced = candidates.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    within_slice = Window.partitionBy("batch", "_slice").orderBy(*newest_first())
    first_cut = (
        sliced.withColumn("rank", F.row_number().over(within_slice))
        .where(F.col("rank") <= limit)
        .drop("rank", "_slice")
    )
    within_batch = Window.partitionBy("batch").orderBy(*newest_first())
    return first_cut.withColumn("rank", F.row_number().over(within_batch)).where(
        F.col("rank") <= limit
    )


def newest_ids(posts: DataFrame, hits: str, limit: int) -> DataFrame:
    """Ids of all posts that may be among the newest ``limit`` of a batch; at most ``limit`` ids for each.

    Judged by time and id alone, in levels as in :func:`topn_per_batch`; rows that tie in both all count.
    """
    if limit <= 0:
        raise ValueError("search limit must be positive")
    order = [F.desc("created_utc"), F.asc("post_id")]
    keys = _by_batch(posts.select("post_id", "created_utc", hits), hits).drop(hits)
    sliced = keys.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    within_slice = Window.partitionBy("batch", "_slice").orderBy(*order)
    within_batch = Window.partitionBy("batch").orderBy(*order)
    first_cut = sliced.withColumn("_rank", F.rank().over(within_slice)).where(F.col("_rank") <= limit)
    newest = first_cut.withColumn("_rank", F.rank().over(within_batch)).where(F.col("_rank") <= limit)
    return newest.select("post_id").distinct()


def _by_batch(posts: DataFrame, hits: str) -> DataFrame:
    """A row per post and batch.  A plain explode would be given a condition that works the hits out once more."""
    return posts.withColumn("batch", F.explode_outer(hits)).where(F.col("batch").isNotNull())


def _of_ids(posts: DataFrame, ids: DataFrame) -> DataFrame:
    few = F.broadcast(ids.withColumnRenamed("post_id", "_wanted"))
    return posts.join(few, F.col("post_id").eqNullSafe(F.col("_wanted")), "left_semi")


def check_search(
    pains: Sequence[str],
    tools: Sequence[str],
    search_limit: int,
) -> tuple[list[str], list[str]]:
    """Both vocabularies without blanks; each must keep at least one term."""
    if search_limit <= 0:
        raise ValueError("search limit must be positive")
    pain_terms = V.nonblank_terms(pains)
    tool_terms = V.nonblank_terms(tools)
    if not pain_terms:
        raise ValueError("the search needs at least one pain term")
    if not tool_terms:
        raise ValueError("the search needs at least one tool term")
    return pain_terms, tool_terms


def ranked_candidates(
    posts: DataFrame,
    batches: Sequence[Sequence[str]],
    tools: Sequence[str],
    *,
    all_pains: Sequence[str] | None = None,
    case_sensitive: bool = False,
    search_limit: int = V.SEARCH_LIMIT,
    whole_word: bool = True,
    hits: str | None = None,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Newest candidates per batch, with ``exact``: do the full vocabularies match?

    Candidates are found by whole words, or with ``whole_word=False`` also inside
    words, as a loose search service would; ``exact`` always means whole words.

    ``hits`` names a column that tells each post's batches already, as ``batch_hits`` makes it
    where texts are read.  The newest are then sought by time and id, and ``lookup`` brings the whole posts
    of a few ``post_id``, by default a broadcast semi-join with the posts, so that no other text is moved.
    """
    pains = list(all_pains) if all_pains is not None else [t for b in batches for t in b]
    if hits is None:
        # A service finds candidates without regard to case; the exact check may mind it.
        found = batch_cross(posts, batches, tools, case_sensitive=False, whole_word=whole_word)
    else:
        ids = newest_ids(posts, hits, search_limit)
        whole = _of_ids(posts, ids) if lookup is None else lookup(ids)
        found = _by_batch(whole, hits).drop(hits)
    top = topn_per_batch(found, search_limit)
    text = search_text()
    exact = any_term(text, pains, case_sensitive) & any_term(text, tools, case_sensitive)
    return top.withColumn("exact", F.coalesce(exact, F.lit(False)))


def first_seen(rows: DataFrame, order: Sequence[str] = ("batch", "rank")) -> DataFrame:
    """First row of every id in the given order; apply after the filters."""
    by_id = Window.partitionBy("post_id").orderBy(*order)
    numbered = rows.withColumn("_seen", F.row_number().over(by_id))
    return numbered.where(F.col("_seen") == 1).drop("_seen")


def global_candidates(
    posts: DataFrame,
    pains: Sequence[str],
    tools: Sequence[str],
    lookback_hours: float,
    now: datetime,
    *,
    case_sensitive: bool = False,
    batch_size: int = V.BATCH_SIZE,
    search_limit: int = V.SEARCH_LIMIT,
    max_age_hours: float | None = 24,
    whole_word: bool = True,
    hits: str | None = None,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Top candidates of every batch with ``within`` (lookback) and ``exact`` marks.

    ``hits`` and ``lookup`` as for :func:`ranked_candidates`, for the same terms, batches and ``whole_word``.
    Posts that ``lookup`` brings are held to the bound on age as well.
    """
    if lookback_hours <= 0:
        raise ValueError("lookback hours must be positive")
    pain_terms, tool_terms = check_search(pains, tools, search_limit)
    batches = V.term_batches(pain_terms, batch_size)

    def young(some: DataFrame) -> DataFrame:
        return some if max_age_hours is None else day_prefilter(some, now, max_age_hours)

    ranked = ranked_candidates(
        young(posts),
        batches,
        tool_terms,
        case_sensitive=case_sensitive,
        search_limit=search_limit,
        whole_word=whole_word,
        hits=hits,
        lookup=None if lookup is None else lambda ids: young(lookup(ids)),
    )
    return ranked.withColumn("within", F.col("created_utc") >= cutoff_epoch(now, lookback_hours))


def global_search(
    posts: DataFrame,
    pains: Sequence[str],
    tools: Sequence[str],
    lookback_hours: float,
    now: datetime,
    **options,
) -> DataFrame:
    """Recent posts, of any community, that match both vocabularies.

    Per batch of pain terms: the newest candidates of the last day up to the
    limit, *then* the lookback cutoff and the full-vocabulary match; an id found
    by several batches belongs to the first.  ``(batch, rank)`` is the order.
    """
    found = global_candidates(posts, pains, tools, lookback_hours, now, **options)
    return accepted_posts(found, pains, tools, case_sensitive=options.get("case_sensitive", False))


def accepted_posts(
    found: DataFrame, pains: Sequence[str], tools: Sequence[str], *, case_sensitive: bool = False
) -> DataFrame:
    """The result of a search, from its candidates as :func:`global_candidates` marks them."""
    accepted = first_seen(found.where(F.col("within") & F.col("exact")))
    matched = matched_arrays(accepted, V.nonblank_terms(pains), V.nonblank_terms(tools), case_sensitive)
    return matched.drop("within", "exact")


def batch_funnel(found: DataFrame, n_batches: int) -> DataFrame:
    """Per batch: candidates, those within the lookback, and those newly accepted.

    ``found`` comes from :func:`global_candidates`.  An id counts as new in its
    first batch only; batches without candidates are listed with zeros.
    """
    spot = F.struct("batch", "rank")
    passed = F.col("within") & F.col("exact")
    by_id = Window.partitionBy("post_id")
    marked = found.select(
        "batch",
        "within",
        (F.min(F.when(passed, spot)).over(by_id) == spot).alias("new"),
    )
    counts = marked.groupBy("batch").agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("within").alias("within_lookback"),
        F.count_if("new").alias("new_exact"),
    )
    numbers = found.sparkSession.range(1, n_batches + 1)
    batches = numbers.select(F.col("id").cast("int").alias("batch"))
    names = ["raw", "within_lookback", "new_exact"]
    return batches.join(counts, "batch", "left").select(
        "batch", *[F.coalesce(n, F.lit(0)).alias(n) for n in names]
    )


def funnel_total(found: DataFrame, n_batches: int) -> DataFrame:
    """Distinct posts accepted over all batches, and the number of batches."""
    passed = found.where(F.col("within") & F.col("exact"))
    return passed.agg(F.count_distinct("post_id").alias("distinct_matches")).withColumn(
        "batches", F.lit(n_batches)
    )
