"""Keeping posts that name at least one pain term and at least one tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.functions.text import any_term, find_matches, matching_batches, search_text


def any_and_any(
    posts: DataFrame,
    pains: Sequence[str],
    tools: Sequence[str],
    case_sensitive: bool = False,
) -> DataFrame:
    """Posts with a whole-word hit in both vocabularies: two patterns per post."""
    text = search_text()
    return posts.where(any_term(text, tools, case_sensitive)).where(
        any_term(text, pains, case_sensitive)
    )


def matched_arrays(
    posts: DataFrame,
    pains: Sequence[str],
    tools: Sequence[str],
    case_sensitive: bool = False,
) -> DataFrame:
    """Add the matched terms of both vocabularies, in vocabulary order."""
    text = search_text()
    return posts.withColumns(
        {
            "matched_pain_keywords": find_matches(text, pains, case_sensitive),
            "matched_tools": find_matches(text, tools, case_sensitive),
        }
    )


def matched_posts(
    posts: DataFrame,
    pains: Sequence[str],
    tools: Sequence[str],
    case_sensitive: bool = False,
) -> DataFrame:
    """Qualifying posts with their matched terms; one pattern per term runs on these only."""
    kept = any_and_any(posts, pains, tools, case_sensitive)
    return matched_arrays(kept, pains, tools, case_sensitive)


def batch_cross(
    posts: DataFrame,
    batches: Sequence[Sequence[str]],
    tools: Sequence[str],
    case_sensitive: bool = False,
    whole_word: bool = True,
) -> DataFrame:
    """One row per post and batch with a term of the batch and any tool in the post.

    The batch numbers are worked out per post where its text is read, so no join
    of posts and batches takes place; batches are tested only where a tool is found.
    """
    hits = batch_hits(search_text(), batches, tools, case_sensitive, whole_word)
    return posts.withColumn("batch", F.explode(hits))


def batch_hits(
    text: Column,
    batches: Sequence[Sequence[str]],
    tools: Sequence[str],
    case_sensitive: bool = False,
    whole_word: bool = True,
) -> Column:
    """Numbers of the batches with a term in the text; null where it names no tool."""
    hits = matching_batches(text, batches, case_sensitive, whole_word)
    return F.when(any_term(text, tools, case_sensitive, whole_word), hits)


def term_counts(
    posts: DataFrame,
    terms: Sequence[str],
    case_sensitive: bool = False,
) -> DataFrame:
    """Number of posts that hold each term, terms without a post included."""
    text = search_text()
    sums = [
        F.count_if(F.coalesce(any_term(text, [t], case_sensitive), F.lit(False))).alias(f"t{i}")
        for i, t in enumerate(terms)
    ]
    if not sums:
        raise ValueError("at least one term is needed")
    one_row = posts.agg(*sums)
    cells = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(t).alias("term"),
            F.col(f"t{i}").alias("n_posts"),
        )
        for i, t in enumerate(terms)
    ]
    return one_row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
