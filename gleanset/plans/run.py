"""One collection run: snapshot, collect, normalise, de-duplicate, append, count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from gleanset import vocabulary as V
from gleanset.functions.text import search_text
from gleanset.operators.cleaning import clean_posts
from gleanset.operators.dedup import known_keys, ordered_dedup
from gleanset.operators.matching import batch_hits
from gleanset.operators.reports import provenance, run_reports, run_result
from gleanset.operators.search import accepted_posts, check_search, global_candidates
from gleanset.operators.sets import SOURCE_ORDER, check_stream, source_order, stream_union
from gleanset.plans.durable import durable
from gleanset.schemas import BATCH_HITS
from gleanset.sinks.stored import current_version, verified_append
from gleanset.sources.curated import multi_scan
from gleanset.sources.stored import backend_choice, snapshot_keys, snapshot_read


@dataclass(frozen=True)
class RunSettings:
    """What a run collects; checked when made."""

    communities: Sequence[str] = V.COMMUNITIES
    pains: Sequence[str] = V.PAIN_TERMS
    tools: Sequence[str] = V.TOOL_TERMS
    curated_hours: float = V.CURATED_LOOKBACK_HOURS
    global_hours: float = V.GLOBAL_LOOKBACK_HOURS
    case_sensitive: bool = False
    search_enabled: bool = True
    search_options: dict = field(default_factory=dict)
    listings_newest_first: bool = True

    def __post_init__(self) -> None:
        if self.curated_hours <= 0 or self.global_hours <= 0:
            raise ValueError("lookback hours must be positive")
        if self.search_enabled:
            check_search(self.pains, self.tools, self.search_options.get("search_limit", 1))


@dataclass(frozen=True)
class RunOutcome:
    """Kept rows and the one-row counters of a run.

    ``candidates`` only in a dry run; ``reports`` (see ``run_reports``) unless no stream ran.
    """

    kept: DataFrame
    result: DataFrame
    uploaded: bool
    candidates: DataFrame | None = None
    reports: DataFrame | None = None


def scan_streams(
    posts: DataFrame,
    settings: RunSettings,
    now: datetime,
    stream: str = "both",
) -> tuple[DataFrame | None, DataFrame | None]:
    """The curated stream, and the marked candidates of all searches; None what is not to run."""
    check_stream(stream)
    curated = found = None
    if stream in ("both", "curated"):
        curated = multi_scan(
            posts.drop(settings.search_options.get("hits") or ""),
            settings.communities,
            settings.curated_hours,
            now,
            newest_first=settings.listings_newest_first,
        )
    if stream in ("both", "global") and settings.search_enabled:
        found = global_candidates(
            posts,
            settings.pains,
            settings.tools,
            settings.global_hours,
            now,
            case_sensitive=settings.case_sensitive,
            **settings.search_options,
        )
    return curated, found


def searched_posts(found: DataFrame | None, settings: RunSettings) -> DataFrame | None:
    if found is None:
        return None
    return accepted_posts(found, settings.pains, settings.tools, case_sensitive=settings.case_sensitive)


def collect_streams(
    posts: DataFrame,
    settings: RunSettings,
    now: datetime,
    stream: str = "both",
) -> tuple[DataFrame | None, DataFrame | None]:
    """The chosen streams; a stream not chosen, or search switched off, is None."""
    curated, found = scan_streams(posts, settings, now, stream)
    return curated, searched_posts(found, settings)


def by_hits(posts: DataFrame, settings: RunSettings) -> tuple[DataFrame, RunSettings]:
    """Posts with the batches that their texts hit, and settings whose search goes by them.

    The newest are then sought by time and id, and only their texts are read a second time.
    """
    options = settings.search_options
    if not settings.search_enabled or options.get("hits") is not None:
        return posts, settings
    batches = V.term_batches(V.nonblank_terms(settings.pains), options.get("batch_size", V.BATCH_SIZE))
    tools, whole_word = V.nonblank_terms(settings.tools), options.get("whole_word", True)
    hits = batch_hits(search_text(), batches, tools, whole_word=whole_word)
    return posts.withColumn(BATCH_HITS, hits), replace(settings, search_options=options | {"hits": BATCH_HITS})


def new_rows(candidates: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Cleaned candidates that are new, with their source order columns."""
    cleaned = clean_posts(candidates, *SOURCE_ORDER)
    return ordered_dedup(cleaned, stored, SOURCE_ORDER, digest="body_key")


def run_batch(
    spark: SparkSession,
    posts: DataFrame,
    store: str,
    run: str,
    settings: RunSettings,
    now: datetime,
    *,
    stream: str = "both",
    backend: str = "csv",
    dry_run: bool = False,
    stored_posts: bool = False,
) -> RunOutcome:
    """Run once against a store; repeating it with the same ``run`` changes nothing more.

    Where another writer publishes meanwhile, the candidates are de-duplicated again with
    the keys that it has added; the store itself is not read again.

    Every stream is computed once and kept in reliable storage, since the
    counters, the de-duplication and the provenance all read it.  ``stored_posts`` tells that the
    posts are read from such storage already, with digests of their bodies at best: the curated stream, which
    only chooses among them, is then not copied, and bodies are read of kept rows and searched texts alone.
    """
    check_stream(stream)
    backend = backend_choice(backend)
    base = current_version(spark, store)
    at = base.number if base.number >= 0 else None
    stored = snapshot_read(spark, store, backend, except_run=run, version=at)
    if stored_posts:
        posts, settings = by_hits(posts, settings)
    curated, found = scan_streams(posts, settings, now, stream)
    curated = curated if curated is None or stored_posts else durable(curated)
    # Candidates are bounded by the searches' limits; the reports count them, and the search goes on from them.
    found = None if found is None else durable(found)
    searched = None if found is None else durable(searched_posts(found, settings))
    if curated is None and searched is None:
        empty = clean_posts(posts.limit(0))
        stages = {
            "existing_rows": stored,
            "curated_posts": None,
            "global_posts": None,
            "unique_posts": None,
        }
        return RunOutcome(empty, run_result(stages, False), False)

    batch_size = settings.search_options.get("batch_size", V.BATCH_SIZE)
    batches = V.term_batches(V.nonblank_terms(settings.pains), batch_size) if found is not None else []
    reports = run_reports(curated, settings.communities, found, batches)
    candidates = stream_union(curated, searched)
    cleaned = clean_posts(candidates, *SOURCE_ORDER)
    stored_now = snapshot_keys(spark, store, backend, except_run=run, version=at)
    known = known_keys(cleaned, stored_now, digest="body_key")
    fresh = durable(ordered_dedup(cleaned, known, SOURCE_ORDER, digest="body_key"))
    stages = {
        "existing_rows": stored,
        "curated_posts": curated,
        "global_posts": searched,
        "unique_posts": fresh,
    }
    kept = fresh.drop(*SOURCE_ORDER)
    if dry_run:
        nothing = searched if searched is not None else _no_search(curated)
        held = curated if curated is not None else searched.limit(0)
        tagged = source_order(provenance(fresh, held, nothing)).drop(*SOURCE_ORDER)
        return RunOutcome(kept, run_result(stages, False), False, tagged, reports)

    def renew(added: DataFrame) -> DataFrame:
        nonlocal known
        known = known.unionByName(known_keys(cleaned, added, digest="body_key"))
        stages["unique_posts"] = durable(ordered_dedup(cleaned, known, SOURCE_ORDER, digest="body_key"))
        return stages["unique_posts"].drop(*SOURCE_ORDER)

    uploaded = verified_append(kept, store, run, backend, since=base, renew=renew) > 0
    kept = stages["unique_posts"].drop(*SOURCE_ORDER)
    return RunOutcome(kept, run_result(stages, uploaded), uploaded, reports=reports)


def _no_search(curated: DataFrame) -> DataFrame:
    """An empty search result, for a run of the curated stream alone."""
    return curated.limit(0).selectExpr(
        "post_id",
        "cast(array() as array<string>) as matched_pain_keywords",
        "cast(array() as array<string>) as matched_tools",
        "0 as batch",
        "0 as rank",
    )
