"""Default search vocabularies, the community allow-list, and term batches.

Vocabularies are ordered: the order decides which terms share a batch and the
order in which matched terms are listed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default vocabularies, communities, and limits.
PAIN_TERMS = (
    "blocked",
    "blocker",
    "blockers",
    "waiting on",
    "dependencies",
    "other team",
    "another team",
    "cross-team",
    "handoff",
    "bottleneck",
    "stuck",
    "delays",
    "who owns",
    "no owner",
    "ownership",
    "accountable",
    "assignee",
    "decisions",
    "decision log",
    "meeting notes",
    "rationale",
    "reasoning",
    "reconstruct",
    "source of truth",
    "stale",
    "status reporting",
    "project health",
    "visibility",
    "out of sync",
    "follow-up",
    "chasing",
    "action items",
    "scope change",
    "scattered",
    "fragmented",
)

TOOL_TERMS = (
    "jira",
    "slack",
    "notion",
    "github",
    "confluence",
    "asana",
    "monday",
    "clickup",
    "linear",
    "teams",
    "spreadsheet",
    "email",
)

COMMUNITIES = (
    "sysadmin",
    "SaaS",
    "Notion",
    "webdev",
    "startups",
    "devops",
    "projectmanagers",
    "ProductManagement",
    "clickup",
    "EngineeringManagers",
    "projectmanagement",
    "ExperiencedDevs",
    "businessanalysis",
    "github",
    "sre",
    "softwaredevelopment",
    "jira",
    "mondaydotcom",
    "ITManagers",
    "changemanagement",
    "trello",
    "Slack",
    "Linear",
    "kanban",
    "ProductOwner",
    "agile",
    "managers",
    "atlassian",
    "Asana",
    "scrum",
)

COVERAGE_GROUPS = (
    ("blocked", "blocker", "blockers"),
    ("waiting on", "dependencies"),
    ("other team", "another team", "cross-team", "handoff", "bottleneck"),
    ("stuck", "delays"),
    ("ownership",),
    ("who owns", "no owner"),
    ("accountable",),
    ("assignee",),
    ("decisions",),
    ("decision log", "meeting notes"),
    ("rationale", "reasoning"),
    ("reconstruct",),
    ("source of truth", "stale"),
    ("status reporting", "project health", "visibility", "out of sync", "follow-up"),
    ("chasing", "action items", "scope change", "scattered", "fragmented"),
)

BATCH_SIZE = 5
SEARCH_LIMIT = 250
CURATED_LOOKBACK_HOURS = 13
GLOBAL_LOOKBACK_HOURS = 6


def nonblank_terms(terms: Iterable[str]) -> list[str]:
    """The terms that are not empty, in their order; blanks never count for batching."""
    return [t for t in terms if t]


def term_batches(terms: Sequence[str], size: int = BATCH_SIZE) -> list[list[str]]:
    """Consecutive groups of at most ``size`` terms."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    starts = range(0, len(terms), size)
    return [list(terms[s : s + size]) for s in starts]


def vocabulary_frame(
    spark: SparkSession,
    pains: Iterable[str],
    tools: Iterable[str],
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Both vocabularies as one table ``(kind, ord, term, batch)``; tools have no batch.

    The size is that of the two argument lists, so the table is safe to broadcast.
    """
    rows = []
    pain_terms = nonblank_terms(pains)
    for b, group in enumerate(term_batches(pain_terms, batch_size), start=1):
        for t in group:
            rows.append(("pain", len(rows), t, b))
    rows += [("tool", i, t, None) for i, t in enumerate(nonblank_terms(tools))]
    return spark.createDataFrame(rows, "kind string, ord int, term string, batch int")


def batch_frame(spark: SparkSession, batches: Sequence[Sequence[str]]) -> DataFrame:
    """One row per batch: its number, from 1, and its terms."""
    rows = [(i, list(b)) for i, b in enumerate(batches, start=1)]
    return spark.createDataFrame(rows, "batch int, terms array<string>")


def allow_list_frame(spark: SparkSession, communities: Sequence[str]) -> DataFrame:
    """The allow-list with its order and the key communities are compared by.

    Names compare without case. A name given twice is scanned twice.
    """
    rows = [(i, c) for i, c in enumerate(communities)]
    frame = spark.createDataFrame(rows, "list_pos int, community string")
    return frame.withColumn("community_key", F.lower("community"))


def check_groups(terms: Iterable[str], groups: Iterable[Iterable[str]]) -> None:
    """Raise unless every term is in the groups exactly once."""
    if Counter(terms) != Counter(t for g in groups for t in g):
        raise ValueError("the groups must hold every vocabulary term exactly once")
