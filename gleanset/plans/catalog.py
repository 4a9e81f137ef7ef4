"""Named queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanset import vocabulary as V
from gleanset.functions import text as X
from gleanset.functions import values as N
from gleanset.operators import cleaning, dedup, matching, reports, search, sets
from gleanset.plans import run as R
from gleanset.plans.durable import durable, scratch_path
from gleanset.schemas import BATCH_HITS, BODY_DIGEST
from gleanset.sinks import stored as sink
from gleanset.sources import archive
from gleanset.sources import curated as C
from gleanset.sources import stored as src
from gleanset.sources import testdata as D
from gleanset.streaming import runs as S

Query = Callable[[SparkSession, str], DataFrame]

# Hours that reach past the oldest post, so that a scan takes the whole table.
ALL_HOURS = 24 * 365 * 3
# The stored dataset holds the posts that were this old.
STORED_AGE_HOURS = 36
# Hours of the scan of the archive.
ARCHIVE_HOURS = 40
LIMIT = 20
BATCH = 2

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def bars(column: str) -> Column:
    """A list column as text, for comparison."""
    return F.array_join(column, "|").alias(column)


def stored_posts(spark: SparkSession, sf: str) -> DataFrame:
    cutoff = C.cutoff_epoch(D.clock(spark, sf), STORED_AGE_HOURS)
    return D.posts(spark, sf).where(F.col("created_utc") < cutoff)


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_posts(stored_posts(spark, sf))


def stored_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of :func:`stored_rows`, for which no body is moved."""
    cutoff = C.cutoff_epoch(D.clock(spark, sf), STORED_AGE_HOURS)
    older = D.posts(spark, sf, digests=True).where(F.col("created_utc") < cutoff)
    return dedup.stored_keys(cleaning.clean_posts(older, BODY_DIGEST), BODY_DIGEST)


def keyed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`all_rows` with digests of the bodies."""
    return cleaning.clean_posts(D.posts(spark, sf, digests=True), BODY_DIGEST)


def all_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_posts(D.posts(spark, sf))


def settings(**changes) -> R.RunSettings:
    base = {
        "communities": D.TEST_COMMUNITIES,
        "pains": D.TEST_PAINS,
        "tools": D.TEST_TOOLS,
        "curated_hours": ALL_HOURS,
        "global_hours": ALL_HOURS,
        "search_options": {"batch_size": BATCH, "max_age_hours": None},
    }
    return R.RunSettings(**(base | changes))


def streams(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both streams over all posts; the search result is bounded and computed once."""
    wanted = settings()
    batches = V.term_batches(list(wanted.pains), BATCH)

    def read(ids: DataFrame | None = None) -> DataFrame:
        return D.posts(
            spark,
            sf,
            matching=ids is None,
            digests=True,
            hits=lambda text: matching.batch_hits(text, batches, wanted.tools),
            ids=ids,
        )

    by_hits = settings(search_options=wanted.search_options | {"hits": BATCH_HITS, "lookup": read})
    curated, searched = R.collect_streams(read(), by_hits, D.clock(spark, sf))
    return curated, durable(searched)


def recent_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of the last day, found also inside words, so that the exact check bites."""
    now = D.clock(spark, sf)
    posts = D.posts(spark, sf, since=C.cutoff_epoch(now, 24), matching=True)
    return search.global_candidates(
        posts,
        D.TEST_PAINS,
        D.TEST_TOOLS,
        6,
        now,
        batch_size=BATCH,
        search_limit=LIMIT,
        whole_word=False,
    )


def coverage_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return search.ranked_candidates(
        D.posts(spark, sf, matching=True),
        D.TEST_GROUPS,
        D.TEST_TOOLS,
        all_pains=D.TEST_PAINS,
        search_limit=250,
        whole_word=False,
    )


# --- sources -------------------------------------------------------------------------


@query
def raw_flatten(spark, sf):
    return D.posts(spark, sf)


@query
def curated_scan(spark, sf):
    scan = C.curated_scan(D.posts(spark, sf), "src3", 24, D.clock(spark, sf), newest_first=False)
    return scan.select("post_id", "created_utc")


@query
def multi_scan(spark, sf):
    scan = C.multi_scan(
        D.posts(spark, sf), D.TEST_COMMUNITIES, 24, D.clock(spark, sf), newest_first=False
    )
    return scan.select("list_pos", "subreddit", "post_id", "created_utc")


@query
def archive_scan(spark, sf):
    """A listing scan of the last hours, over an archive of all posts laid out by time."""
    posts, now = D.posts(spark, sf), D.clock(spark, sf)
    path = scratch_path(spark, "archive")
    archive.write_archive(posts, path)
    recent = archive.archive_scan(spark, path, posts.schema, now, ARCHIVE_HOURS)
    kept = C.multi_scan(recent, D.TEST_COMMUNITIES, ARCHIVE_HOURS, now)
    return kept.select("post_id", "list_pos", "created_utc", F.length("text").cast("bigint").alias("n_chars"))


@query
def source_skip(spark, sf):
    return C.source_skip(D.posts(spark, sf), D.TEST_COMMUNITIES)


@query
def global_search(spark, sf):
    now = D.clock(spark, sf)
    found = search.global_search(
        D.posts(spark, sf, since=C.cutoff_epoch(now, 24), matching=True),
        D.TEST_PAINS,
        D.TEST_TOOLS,
        6,
        now,
        batch_size=BATCH,
        search_limit=LIMIT,
    )
    return found.select(
        "batch",
        F.col("rank").cast("bigint").alias("rank"),
        "post_id",
        "created_utc",
        bars("matched_pain_keywords"),
        bars("matched_tools"),
    )


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    sink.create_store(spark, path, "csv", all_rows(spark, sf))
    return src.csv_scan(spark, f"{path}/run={sink.FIRST_RUN}")


@query
def snapshot_version(spark, sf):
    """An older version of a store, read after a later append."""
    path, fresh = _stored_and_new(spark, sf, "sheets")
    sink.verified_append(fresh, path, "second", "sheets")
    return src.snapshot_read(spark, path, "sheets", version=0).select("id", "created_iso")


@query
def serial_writes(spark, sf):
    """Two writers judge the same posts against the same version; the one that comes second adds nothing twice.

    The first takes every other post, so the second still has rows to add.
    """
    path = _store(spark, sf, "csv")
    base = sink.current_version(spark, path)
    order = ["created_utc", "id"]
    rows = keyed_rows(spark, sf)
    known = dedup.known_keys(rows, src.snapshot_keys(spark, path), digest=BODY_DIGEST)
    fresh = durable(dedup.ordered_dedup(rows, known, order, digest=BODY_DIGEST))
    first = fresh.where(F.xxhash64("id") % 2 == 0)
    sink.verified_append(first, path, "first", since=base)

    def renew(added: DataFrame) -> DataFrame:
        return durable(dedup.ordered_dedup(rows, known.unionByName(added), order, digest=BODY_DIGEST))

    sink.verified_append(fresh, path, "second", since=base, renew=renew)
    return src.snapshot_read(spark, path).groupBy("id", "created_iso", "subreddit").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query
def grid_scan(spark, sf):
    """Pages as a grid service returns them: a header row, blank tails left out."""
    posts = D.posts(spark, sf)
    rows = cleaning.clean_posts(posts, F.element_at(F.split("id", "d"), 2).alias("row_no"))
    source = [F.col(c) for c in ("subreddit", "id", "title", "author")]
    cells = F.array(*source, N.epoch_text(F.col("created_utc")), "created_iso", "url", "selftext")
    short = F.when(F.col("selftext") == "", F.slice(cells, 1, 7)).otherwise(cells)
    body = rows.select(F.col("row_no").cast("bigint") + 1, short).toDF("row_no", "cells")
    header = F.array(*[F.lit(c) for c in src.GRID_COLUMNS])
    head = spark.range(1).select(F.col("id").alias("row_no"), header.alias("cells"))
    return src.grid_scan(head.unionByName(body))


@query
def snapshot_read(spark, sf):
    path = scratch_path(spark, "grid")
    sink.create_store(spark, path, "sheets", all_rows(spark, sf))
    return src.snapshot_read(spark, path, "sheets").select("id", "selftext")


@query
def backend_choice(spark, sf):
    """The same rows through both backends."""
    rows = durable(all_rows(spark, sf))
    counts = []
    for name in (" CSV ", "Sheets"):
        path = scratch_path(spark, "backend")
        sink.create_store(spark, path, name, rows)
        back = src.snapshot_read(spark, path, name)
        counts.append(
            back.agg(
                F.lit(src.backend_choice(name)).alias("backend"),
                F.lit(len(back.columns)).alias("n_columns"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("selftext").alias("n_bodies"),
            )
        )
    return counts[0].unionByName(counts[1])


# --- sinks ---------------------------------------------------------------------------


def _stored_and_new(spark: SparkSession, sf: str, backend: str, line_end: str = "\n"):
    """A store of the older posts, and the rows of all posts that are new to it."""
    path = scratch_path(spark, "store")
    sink.create_store(spark, path, backend, stored_rows(spark, sf), line_end)
    stored = src.snapshot_keys(spark, path, backend)
    order = ["created_utc", "id"]
    # Without bodies first; where few rows are new, only their bodies are read.
    keys = keyed_rows(spark, sf).select(*order, F.lit(None).cast("string").alias("selftext"), BODY_DIGEST)
    kept = durable(dedup.ordered_dedup(keys, stored, order, digest=BODY_DIGEST).drop("selftext"))
    n = kept.count()
    ids = kept.select("id") if n <= dedup.BROADCAST_ROWS else None
    rows = cleaning.clean_posts(D.posts(spark, sf, digests=True, ids=ids), BODY_DIGEST)
    own = [*order, BODY_DIGEST]
    wanted = kept.select(*own)
    fresh = rows.join(wanted if ids is None else F.broadcast(wanted), own, "left_semi").dropDuplicates(own)
    return path, durable(fresh.select(*rows.columns).drop(BODY_DIGEST))


@query
def csv_append(spark, sf):
    """A row brings its labels into CSV; absent labels are blank."""
    path, fresh = _stored_and_new(spark, sf, "csv")
    labelled = fresh.withColumn("label1", F.col("subreddit"))
    sink.csv_append(labelled, path, "second")
    return src.snapshot_read(spark, path)


@query
def line_style(spark, sf):
    path, fresh = _stored_and_new(spark, sf, "csv", "\r\n")
    sink.csv_append(fresh, path, "second")
    rows = src.snapshot_read(spark, path, only_run="second")
    style = F.lit(src.line_style(spark, path))
    return rows.select("id", "selftext", F.ascii(style).cast("bigint").alias("first_code"))


@query
def grid_append(spark, sf):
    return sink.grid_append(cleaning.clean_posts(D.posts(spark, sf)))


@query
def verified_append(spark, sf):
    path, fresh = _stored_and_new(spark, sf, "sheets")
    n = sink.verified_append(fresh, path, "second", "sheets")
    rows = sink.run_rows(spark, path, "sheets", "second")
    return rows.select("id", "created_iso", F.lit(n).cast("bigint").alias("appended"))


@query
def noop_append(spark, sf):
    """A second append of the same posts finds nothing new and writes nothing."""
    path, fresh = _stored_and_new(spark, sf, "sheets")
    sink.verified_append(fresh, path, "second", "sheets")
    stored = src.snapshot_keys(spark, path, "sheets")
    again = dedup.ordered_dedup(fresh, stored, ["created_utc", "id"])
    n = sink.verified_append(again, path, "third", "sheets")
    after = src.snapshot_read(spark, path, "sheets")
    return after.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "appended", F.lit(n).cast("bigint")
    )


def _store(spark: SparkSession, sf: str, backend: str) -> str:
    path = scratch_path(spark, "run")
    sink.create_store(spark, path, backend, stored_rows(spark, sf))
    return path


@query
def dry_run(spark, sf):
    path = _store(spark, sf, "sheets")
    outcome = R.run_batch(
        spark,
        D.posts(spark, sf, matching=True),
        path,
        "one",
        settings(),
        D.clock(spark, sf),
        backend="sheets",
        dry_run=True,
    )
    return outcome.candidates.select(
        "id", "subreddit", "source", bars("matched_pain_keywords"), bars("matched_tools")
    )


# --- projections and filters ---------------------------------------------------------


@query
def clean_project(spark, sf):
    return cleaning.clean_posts(D.posts(spark, sf))


@query
def null_to_blank(spark, sf):
    posts = D.posts(spark, sf)
    return posts.select("post_id", N.null_to_blank(F.col("author")).alias("author"))


@query
def required_check(spark, sf):
    """Posts made incomplete by the kind of their event; each shows its first fault."""
    rows = D.table(spark, sf, "events")
    kind = F.col("event_type")
    broken = rows.select(
        "event_id",
        F.when(kind != "error", F.concat(F.lit("e"), "event_id")).alias("post_id"),
        F.when(kind != "signup", kind).alias("subreddit"),
        F.when(kind == "view", F.lit("soon"))
        .when(kind == "click", F.lit("1e300"))
        .when(kind == "purchase", F.col("value").cast("string"))
        .alias("created_utc"),
    )
    passed, rejected = cleaning.required_check(broken)
    columns = ["event_id", "reject_reason"]
    ok = passed.select("event_id", F.lit("").alias("reject_reason"))
    return ok.unionByName(rejected.select(*columns))


@query
def numeric_cast(spark, sf):
    rows = D.table(spark, sf, "events")
    kind = F.col("event_type")
    suffix = (
        F.when(kind == "click", "d").when(kind == "view", "e2").when(kind == "error", "_0")
    )
    raw = F.concat(F.lit(" "), F.col("value").cast("string"), F.coalesce(suffix, F.lit("")))
    return rows.select("event_id", N.numeric_cast(raw).alias("number"))


@query
def drop_transient(spark, sf):
    matched = matching.matched_posts(D.posts(spark, sf, matching=True), D.TEST_PAINS, D.TEST_TOOLS)
    return cleaning.clean_posts(matched)


@query
def lookback_filter(spark, sf):
    now = D.clock(spark, sf)
    posts = D.posts(spark, sf, since=C.cutoff_epoch(now, 13))
    return C.lookback_filter(posts, now, 13).select("post_id", "created_utc")


@query
def day_prefilter(spark, sf):
    """A lookback of 48 hours is capped by the day that candidates may be old."""
    now = D.clock(spark, sf)
    posts = D.posts(spark, sf, since=C.cutoff_epoch(now, 24))
    recent = C.lookback_filter(C.day_prefilter(posts, now), now, 48)
    return recent.select("post_id", "created_utc")


@query
def allow_list(spark, sf):
    return C.allow_list(D.posts(spark, sf), D.TEST_COMMUNITIES).select("post_id", "subreddit")


@query
def any_and_any(spark, sf):
    posts = D.posts(spark, sf, matching=True)
    return matching.any_and_any(posts, D.TEST_PAINS, D.TEST_TOOLS).select("post_id")


@query
def stream_select(spark, sf):
    posts, now = D.posts(spark, sf, matching=True), D.clock(spark, sf)
    parts = []
    for mode, chosen in (
        ("both", settings()),
        ("curated", settings()),
        ("global", settings()),
        ("both, search off", settings(search_enabled=False)),
    ):
        curated, searched = R.collect_streams(posts, chosen, now, mode.split(",")[0])
        union = sets.stream_union(curated, searched)
        parts.append(
            union.groupBy(F.lit(mode).alias("mode"), "stream_no").agg(
                F.count(F.lit(1)).alias("posts")
            )
        )
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


# --- joins ---------------------------------------------------------------------------


@query
def anti_id(spark, sf):
    rows = cleaning.clean_posts(D.posts(spark, sf))
    return dedup.anti_id(rows, stored_keys(spark, sf)).select("id")


@query
def anti_text(spark, sf):
    return dedup.anti_text(keyed_rows(spark, sf), stored_keys(spark, sf), digest=BODY_DIGEST).select("id")


@query
def semi_allow(spark, sf):
    """Conversations whose role is on a list, as another table to semi-join."""
    turns = D.table(spark, sf, "conversations").withColumnRenamed("role", "subreddit")
    return C.allow_list(turns, ["USER", "system"]).select("conv_id", "turn", "subreddit")


@query
def batch_cross(spark, sf):
    batches = [list(D.TEST_PAINS[i : i + BATCH]) for i in range(0, len(D.TEST_PAINS), BATCH)]
    return matching.batch_cross(D.posts(spark, sf, matching=True), batches, D.TEST_TOOLS).select(
        "post_id", "batch"
    )


@query
def provenance(spark, sf):
    curated, searched = streams(spark, sf)
    fresh = durable(R.new_rows(sets.stream_union(curated, searched), stored_keys(spark, sf)).select("id"))
    return reports.provenance(fresh, curated, searched).select(
        "id", "source", bars("matched_pain_keywords"), bars("matched_tools")
    )


# --- aggregates ----------------------------------------------------------------------


@query
def batch_funnel(spark, sf):
    return search.batch_funnel(recent_candidates(spark, sf), 4)


@query
def funnel_total(spark, sf):
    return search.funnel_total(recent_candidates(spark, sf), 4)


@query
def run_result(spark, sf):
    path = _store(spark, sf, "sheets")
    outcome = R.run_batch(
        spark,
        D.posts(spark, sf, matching=True),
        path,
        "one",
        settings(),
        D.clock(spark, sf),
        backend="sheets",
    )
    return outcome.result


@query
def run_reports(spark, sf):
    """What each listing and each search of a run found, searches being loose and of the last day."""
    options = {"batch_size": BATCH, "search_limit": LIMIT, "whole_word": False}
    outcome = R.run_batch(
        spark,
        D.posts(spark, sf, matching=True),
        _store(spark, sf, "sheets"),
        "one",
        settings(curated_hours=13, global_hours=6, search_options=options),
        D.clock(spark, sf),
        backend="sheets",
        dry_run=True,
    )
    return outcome.reports


@query
def community_counts(spark, sf):
    posts, now = D.posts(spark, sf), D.clock(spark, sf)
    kept = C.multi_scan(posts, D.TEST_COMMUNITIES, 13, now)
    return C.community_counts(kept, D.TEST_COMMUNITIES)


@query
def coverage_report(spark, sf):
    return reports.coverage_report(coverage_candidates(spark, sf), len(D.TEST_GROUPS))


@query
def coverage_total(spark, sf):
    return reports.coverage_total(coverage_candidates(spark, sf))


@query
def cooccurrence(spark, sf):
    return reports.cooccurrence(D.posts(spark, sf, matching=True), "er", "la")


@query
def dataset_stats(spark, sf):
    return src.dataset_stats(D.table(spark, sf, "documents")).select(
        "n_rows", "n_columns", (F.col("n_bytes") > F.col("n_rows")).alias("has_bytes")
    )


@query
def store_audit(spark, sf):
    path, fresh = _stored_and_new(spark, sf, "sheets")
    before = durable(src.snapshot_read(spark, path, "sheets").select("id", "selftext"))
    n = sink.verified_append(fresh, path, "second", "sheets")
    after = src.snapshot_read(spark, path, "sheets").select("id", "selftext")
    return reports.store_audit(before, after, n)


@query
def existence_sets(spark, sf):
    ids, texts = dedup.existence_sets(all_rows(spark, sf))
    tagged = [
        ids.select(F.lit("id").alias("kind"), F.col("id_key").alias("key")),
        texts.select(F.lit("text").alias("kind"), F.col("text_key").alias("key")),
    ]
    return tagged[0].unionByName(tagged[1])


@query
def distinct_by_id(spark, sf):
    """The last turn of every conversation."""
    turns = D.table(spark, sf, "conversations")
    return sets.distinct_by_id(turns, ["turn"], "conv_id")


# --- ordered operators ---------------------------------------------------------------


@query
def prefix_stop(spark, sf):
    cutoff = C.cutoff_epoch(D.clock(spark, sf), 24)
    every = [f"src{i}" for i in range(20)]
    kept = C.prefix_stop(D.posts(spark, sf), every, cutoff)
    return kept.select("subreddit", "post_id", "listing_pos")


@query
def topn_per_batch(spark, sf):
    ranked = coverage_candidates(spark, sf)
    return ranked.select("batch", F.col("rank").cast("bigint").alias("rank"), "post_id", "exact")


@query
def first_seen(spark, sf):
    seen = search.first_seen(coverage_candidates(spark, sf).where("exact"))
    return seen.select("post_id", "batch", F.col("rank").cast("bigint").alias("rank"))


@query
def ordered_dedup(spark, sf):
    curated, searched = streams(spark, sf)
    return R.new_rows(sets.stream_union(curated, searched), stored_keys(spark, sf)).select(
        "stream_no", "part_no", "id", "subreddit", "created_iso"
    )


@query
def ordered_dedup_actions(spark, sf):
    """Ids and bodies that both repeat many times."""
    return dedup.ordered_dedup(D.actions(spark, sf), None, ["us", "event_id"]).select(
        "event_id", "id", "selftext"
    )


@query
def ordered_dedup_ties(spark, sf):
    """Actions known by the hour only, so that most rows tie in order."""
    hour = F.floor(F.col("us") / F.lit(3_600_000_000)).alias("hour")
    rows = D.actions(spark, sf).select("id", "selftext", hour)
    return dedup.ordered_dedup(rows, None, ["hour"])


# --- sorts, limits, sets -------------------------------------------------------------


@query
def newest_sort(spark, sf):
    return search.newest_sort(D.posts(spark, sf).select("post_id", "created_utc"))


@query
def source_order(spark, sf):
    curated, searched = streams(spark, sf)
    union = sets.stream_union(curated, searched)
    return sets.source_order(union.select(*sets.SOURCE_ORDER))


@query
def limit_report(spark, sf):
    matched = matching.any_and_any(D.posts(spark, sf, matching=True), D.TEST_PAINS, D.TEST_TOOLS)
    newest = reports.limit_report(matched, 20)
    listed = matching.matched_arrays(newest, D.TEST_PAINS, D.TEST_TOOLS)
    return listed.select(
        "subreddit",
        "post_id",
        N.epoch_to_iso(F.col("created_utc")).alias("created"),
        bars("matched_pain_keywords"),
        bars("matched_tools"),
        "title",
    )


@query
def stream_union(spark, sf):
    curated, searched = streams(spark, sf)
    union = sets.stream_union(curated, searched)
    return union.select("stream_no", "post_id", bars("matched_tools"))


@query
def vocab_partition_check(spark, sf):
    """Matched terms of all posts against the same over groups with one term doubled, one lost."""
    posts = D.posts(spark, sf, matching=True)
    text = X.search_text()
    uneven = [t for g in D.TEST_GROUPS for t in g if t != "thon"] + ["er"]
    # Both lists hold the same terms, so a text is matched once; each list then takes its own, copies included.
    terms = list(dict.fromkeys([*D.TEST_PAINS, *uneven]))
    found = durable(posts.select(X.find_matches(text, terms).alias("found")))

    def listed(vocabulary: Sequence[str]) -> DataFrame:
        all_terms = F.array(*[F.lit(t) for t in vocabulary])
        held_terms = F.filter(all_terms, lambda t: F.array_contains("found", t))
        return found.select(F.explode(held_terms).alias("term"))

    return sets.vocab_partition_check(listed(D.TEST_PAINS), listed(uneven))


# --- scalar functions ----------------------------------------------------------------


@query
def search_text(spark, sf):
    text = X.search_text()
    return D.posts(spark, sf, matching=True).select(
        "post_id", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("n_chars")
    )


@query
def term_matches(spark, sf):
    text = X.search_text()
    return D.posts(spark, sf, matching=True).select(
        "post_id",
        X.term_matches(text, "er").alias("has_er"),
        X.term_matches(text, "La", case_sensitive=True).alias("has_la_cased"),
        X.term_matches(text, "of the").alias("has_phrase"),
        X.term_matches(text, "").alias("has_blank"),
    )


@query
def find_matches(spark, sf):
    terms = [*D.TEST_PAINS, "er"]
    return D.posts(spark, sf, matching=True).select(
        "post_id", F.array_join(X.find_matches(X.search_text(), terms), "|").alias("found")
    )


@query
def find_matches_many(spark, sf):
    """A vocabulary of thousands of terms."""
    terms = [a + b for a in D.TEST_SYLLABLES for b in D.TEST_SYLLABLES]
    return D.posts(spark, sf, matching=True).select(
        "post_id", F.array_join(X.find_matches(X.search_text(), terms), "|").alias("found")
    )


@query
def find_matches_pages(spark, sf):
    """Long texts full of markup."""
    pages = D.texts(spark, sf, "pages")
    terms = [*D.TEST_TOOLS, "utf-8", "div", "</p>"]
    found = X.find_matches(F.col("html"), terms)
    return pages.select("page_id", F.array_join(found, "|").alias("found"))


@query
def matched_arrays(spark, sf):
    """Conversation turns as a second source of texts."""
    turns = D.texts(spark, sf, "conversations").withColumn("title", F.col("role"))
    matched = matching.matched_posts(turns, D.TEST_PAINS, D.TEST_TOOLS)
    return matched.select("conv_id", "turn", bars("matched_pain_keywords"), bars("matched_tools"))


@query
def term_batches(spark, sf):
    """Vocabulary with batch numbers, and the posts that hold each term."""
    from gleanset.vocabulary import vocabulary_frame

    counts = matching.term_counts(D.posts(spark, sf, matching=True), list(D.TEST_PAINS))
    batches = vocabulary_frame(spark, D.TEST_PAINS, [], BATCH)
    return counts.join(F.broadcast(batches.select("ord", "batch")), "ord").select(
        "ord", "term", "batch", "n_posts"
    )


@query
def nonblank_terms(spark, sf):
    """Blank terms go before terms are numbered and batched."""
    from gleanset.vocabulary import nonblank_terms, vocabulary_frame

    spaced = [t for p in D.TEST_PAINS for t in (p, "")]
    counts = matching.term_counts(D.posts(spark, sf, matching=True), nonblank_terms(spaced))
    batches = vocabulary_frame(spark, spaced, [], 3)
    return counts.join(F.broadcast(batches.select("ord", "batch")), "ord").select(
        "ord", "term", "batch", "n_posts"
    )


@query
def epoch_to_iso(spark, sf):
    events = D.table(spark, sf, "events")
    at = D.micros(F.col("ts")) / 1_000_000.0
    return events.select(
        "event_id",
        N.epoch_to_iso(at).alias("created"),
        N.epoch_to_iso(F.floor(at).cast("double")).alias("whole"),
        N.epoch_to_iso(-F.col("value")).alias("before_epoch"),
        N.epoch_text(at).alias("plain"),
    )


@query
def window_hours(spark, sf):
    at = F.col("created_utc")
    return (
        D.posts(spark, sf)
        .groupBy("subreddit")
        .agg(N.window_hours(F.max(at), F.min(at)).alias("hours"))
    )


@query
def percent(spark, sf):
    hit = X.any_term(X.search_text(), D.TEST_TOOLS)
    share = N.percent(F.count_if(hit), F.count(F.lit(1))).alias("tool_pct")
    return D.posts(spark, sf, matching=True).groupBy("subreddit").agg(share)


@query
def author_text(spark, sf):
    return D.submissions(spark, sf).select("id", N.author_text(F.col("author")).alias("author"))


@query
def permalink_url(spark, sf):
    return D.submissions(spark, sf).select("id", N.permalink_url(F.col("permalink")).alias("url"))


@query
def name_in(spark, sf):
    events = D.table(spark, sf, "events")
    padded = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    return events.select("event_id", N.name_in(padded).alias("name"))


# --- streaming -----------------------------------------------------------------------


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event file as a stream."""
    schema = D.table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf)


def post_stream(spark: SparkSession, sf: str) -> DataFrame:
    from gleanset.sources.raw import raw_flatten

    events = event_stream(spark, sf).select(
        F.col("event_id").alias("doc_id"),
        D.micros(F.col("ts")).alias("us"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    return raw_flatten(D.posts_of(events.join(D.table(spark, sf, "documents"), "doc_id")))


@query
def incremental_append(spark, sf):
    now, made = D.clock(spark, sf), D.posts(spark, sf)
    # Texts meet their events once; the store and both passes of the stream read files of whole posts.
    posts, path = scratch_path(spark, "posts"), scratch_path(spark, "run")
    made.write.option("compression", "zstd").parquet(posts)
    older = spark.read.schema(made.schema).parquet(posts).where(
        F.col("created_utc") < C.cutoff_epoch(now, STORED_AGE_HOURS)
    )
    sink.create_store(spark, path, "sheets", cleaning.clean_posts(older))
    for _ in range(2):  # The second pass reads everything again and adds nothing.
        stream = S.incremental_append(
            spark.readStream.schema(made.schema).parquet(posts), path, scratch_path(spark, "progress"),
            backend="sheets", settings=settings(), now=now,
        )
        stream.awaitTermination()
    return src.snapshot_read(spark, path, "sheets").select("id", "created_iso", "subreddit")


@query
def sliding_runs(spark, sf):
    return S.sliding_runs(D.posts(spark, sf), *S.GLOBAL_SCHEDULE)


@query
def sliding_runs_curated(spark, sf):
    return S.sliding_runs(D.posts(spark, sf), *S.CURATED_SCHEDULE)


@query
def late_data(spark, sf):
    return S.late_data(D.posts(spark, sf), *S.GLOBAL_SCHEDULE)


def _drain(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Run a stream over what is there and read back what it wrote."""
    out = scratch_path(spark, "out")
    stream = (
        frame.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start(out)
    )
    stream.awaitTermination()
    return spark.read.schema(frame.schema).parquet(out)


@query
def run_windows(spark, sf):
    events = event_stream(spark, sf).select(
        F.timestamp_micros(D.micros(F.col("ts"))).alias("ts")
    )
    return _drain(spark, S.run_windows(events, *S.CURATED_SCHEDULE))


@query
def stream_first_seen(spark, sf):
    events = event_stream(spark, sf).select(
        F.timestamp_micros(D.micros(F.col("ts"))).alias("ts"),
        F.concat(F.lit("u"), "user_id").alias("post_id"),
    )
    return _drain(spark, S.stream_first_seen(events, "1000 days")).select("post_id")


def _closed(stream: DataFrame, last: DataFrame) -> DataFrame:
    """The stream and one row more, so late that everything before it is told."""
    path = scratch_path(stream.sparkSession, "closing")
    last.write.parquet(path)
    closing = stream.sparkSession.readStream.schema(last.schema).parquet(path)
    return stream.unionByName(closing, allowMissingColumns=True)


@query
def stream_first_copy(spark, sf):
    def seen(events):
        return events.select(
            F.timestamp_micros(D.micros(F.col("ts"))).alias("ts"),
            F.concat(F.lit("u"), "user_id").alias("post_id"),
            F.col("event_type").alias("batch"),
            F.col("event_id").alias("rank"),
        )

    last = seen(D.table(spark, sf, "events")).agg((F.max("ts") + F.expr("INTERVAL 3000 DAYS")).alias("ts"))
    stream = _closed(seen(event_stream(spark, sf)), last)
    return _drain(spark, S.stream_first_copy(stream, "1000 days", "1000 days")).drop("ts")


@query
def late_data_stream(spark, sf):
    columns = ["created_utc", "visible_at"]
    last = D.posts(spark, sf).agg(
        *[(F.max("visible_at") + F.lit(10.0 * S.GLOBAL_SCHEDULE[1])).alias(c) for c in columns]
    )
    stream = _closed(post_stream(spark, sf).select(*columns), last)
    return _drain(spark, S.late_data_stream(stream, *S.GLOBAL_SCHEDULE))
