"""Independent SQL for the named queries, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from gleanset.plans.catalog import ARCHIVE_HOURS, BATCH, LIMIT, STORED_AGE_HOURS
from gleanset.schemas import GRID_COLUMNS, LABEL_COLUMNS, REVIEW_COLUMNS
from gleanset.functions.values import POST_BASE_URL
from gleanset.sources.testdata import TEST_COMMUNITIES, TEST_GROUPS, TEST_PAINS, TEST_SYLLABLES, TEST_TOOLS
from gleanset.streaming.runs import CURATED_SCHEDULE, GLOBAL_SCHEDULE

W = r"[^\p{L}\p{N}_]"

POSTS = f"""
raw_posts AS (
  SELECT 'd' || d.doc_id AS post_id, d.source AS subreddit,
    CASE WHEN strpos(d.text, chr(10)) > 0
      THEN substr(d.text, 1, strpos(d.text, chr(10)) - 1) ELSE d.text END AS title,
    CASE WHEN strpos(d.text, chr(10)) > 0
      THEN substr(d.text, strpos(d.text, chr(10)) + 1) ELSE '' END AS text,
    CASE WHEN e.event_type <> 'error' THEN 'u' || e.user_id END AS author,
    epoch_us(e.ts) / 1000000.0::DOUBLE AS created_utc,
    floor(e.value)::BIGINT AS score,
    regexp_extract(e.props, '"k": ([0-9]+)', 1)::BIGINT AS num_comments,
    '{POST_BASE_URL}/p/' || d.doc_id AS url,
    e.event_type = 'purchase' AS stickied,
    epoch_us(e.ts) AS us,
    epoch_us(e.ts) + round(e.value * 60000000.0::DOUBLE)::BIGINT AS visible_us
  FROM documents d JOIN events e ON d.doc_id = e.event_id),
posts AS MATERIALIZED (
  SELECT *, -visible_us AS listing_pos, visible_us / 1000000.0::DOUBLE AS visible_at,
    title || chr(10) || text AS body FROM raw_posts),
clock AS (SELECT (max(us) // 1000000 + 1)::DOUBLE AS now FROM posts)"""


def iso(us: str) -> str:
    return (
        f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} % 1000000 = 0 "
        f"THEN '' ELSE strftime(make_timestamp({us}), '.%f') END || '+00:00'"
    )


CLEAN = f"""
clean AS (
  SELECT subreddit, post_id AS id, title, coalesce(author, '') AS author, created_utc,
    {iso("us")} AS created_iso, url, text AS selftext FROM posts),
stored AS (
  SELECT * FROM clean WHERE created_utc < (SELECT now - {STORED_AGE_HOURS} * 3600 FROM clock))"""


def word(term: str, text: str = "body", flags: str = "i") -> str:
    safe = "".join(c if c.isalnum() else "\\" + c if c in ".+*?()[]{}^$|\\" else c for c in term)
    return f"regexp_matches({text}, '(^|{W}){safe}({W}|$)', '{flags}')"


def loose(term: str) -> str:
    return f"regexp_matches(body, '{term}', 'i')"


def some(terms: Sequence[str], test=word) -> str:
    return "(" + " OR ".join(test(t) for t in terms) + ")"


def listed(terms: Sequence[str], text: str = "body") -> str:
    cases = ", ".join(f"CASE WHEN {word(t, text)} THEN '{t}' END" for t in terms)
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '|')"


LISTS = f"{listed(TEST_PAINS)} AS matched_pain_keywords, {listed(TEST_TOOLS)} AS matched_tools"

BATCHES = [TEST_PAINS[i : i + BATCH] for i in range(0, len(TEST_PAINS), BATCH)]

COMMUNITY_LIST = "community_list(list_pos, community) AS (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(TEST_COMMUNITIES)
) + ")"


def crossed(batches: Sequence[Sequence[str]], test=word, source: str = "posts") -> str:
    parts = [
        f"SELECT {i} AS batch, * FROM {source} WHERE {some(b, test)} AND {some(TEST_TOOLS, test)}"
        for i, b in enumerate(batches, start=1)
    ]
    return " UNION ALL ".join(parts)


def ranked(batches, limit: int, test=word, source: str = "posts") -> str:
    return f"""ranked AS MATERIALIZED (
  SELECT *, {some(TEST_PAINS)} AND {some(TEST_TOOLS)} AS exact FROM (
    SELECT *, row_number() OVER (PARTITION BY batch ORDER BY created_utc DESC, post_id) AS rank
    FROM ({crossed(batches, test, source)})) WHERE rank <= {limit})"""


RECENT = f"""day AS (SELECT * FROM posts WHERE created_utc >= (SELECT now - 86400 FROM clock)),
{ranked(BATCHES, LIMIT, loose, "day")},
found AS (SELECT *, created_utc >= (SELECT now - 6 * 3600 FROM clock) AS within FROM ranked),
passed AS (SELECT * FROM found WHERE within AND exact),
firsts AS (SELECT * FROM passed QUALIFY
  row_number() OVER (PARTITION BY post_id ORDER BY batch, rank) = 1)"""

COVERAGE = ranked(TEST_GROUPS, 250, loose)

# Both streams over all posts, in source order.
STREAMS = f"""{COMMUNITY_LIST},
curated AS (
  SELECT p.*, c.list_pos FROM posts p JOIN community_list c
  ON lower(p.subreddit) = lower(c.community)),
{ranked(BATCHES, 250)},
searched AS (SELECT * FROM ranked WHERE exact QUALIFY
  row_number() OVER (PARTITION BY post_id ORDER BY batch, rank) = 1),
candidates AS (
  SELECT 0 AS stream_no, list_pos AS part_no, listing_pos::DOUBLE AS place, post_id, text
  FROM curated UNION ALL
  SELECT 1, batch, rank::DOUBLE, post_id, text FROM searched),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY stream_no, part_no, place, post_id) AS ord
  FROM candidates)"""


def one_by_one(rows: str, stored: str | None) -> str:
    """Kept row numbers by walking the rows in order with the keys seen so far.

    ``rows`` has ``ord``, ``id``, ``key``, the key blank for an empty body.
    """
    start = "{'ids': []::VARCHAR[], 'keys': []::VARCHAR[], 'kept': []::BIGINT[]}"
    if stored:
        start = (
            f"(SELECT {{'ids': list(DISTINCT id), 'keys': coalesce(list(DISTINCT key) "
            f"FILTER (key <> ''), []), 'kept': []::BIGINT[]}} FROM {stored})"
        )
    return f"""walk AS (
  SELECT list_reduce(steps, lambda seen, row:
    CASE WHEN list_contains(seen.ids, row.ids[1])
           OR (row.keys[1] <> '' AND list_contains(seen.keys, row.keys[1])) THEN seen
    ELSE {{'ids': list_append(seen.ids, row.ids[1]),
          'keys': list_append(seen.keys, row.keys[1]),
          'kept': list_append(seen.kept, row.kept[1])}} END, first) AS seen
  FROM (SELECT {start} AS first,
    list({{'ids': [id], 'keys': [key], 'kept': [ord]}} ORDER BY ord) AS steps FROM {rows})),
kept AS (SELECT unnest(seen.kept) AS ord FROM walk)"""


def md5_key(text: str) -> str:
    return f"CASE WHEN {text} = '' THEN '' ELSE md5({text}) END"


STORED_KEYS = f"stored_keys AS (SELECT id, {md5_key('selftext')} AS key FROM stored)"

KEPT_STREAMS = f"""{STREAMS}, {STORED_KEYS},
rows AS (SELECT ord, post_id AS id, {md5_key("text")} AS key FROM numbered),
{one_by_one("rows", "stored_keys")}"""

# All posts, oldest first, against the stored ones.
KEPT_POSTS = f"""{STORED_KEYS},
rows AS (
  SELECT row_number() OVER (ORDER BY created_utc, id) AS ord, id,
    {md5_key("selftext")} AS key FROM clean),
{one_by_one("rows", "stored_keys")},
fresh AS (
  SELECT c.* FROM clean c JOIN rows USING (id) JOIN kept USING (ord))"""

SOURCE_LIST = "subreddit, id, title, author, created_utc::VARCHAR AS created_utc, created_iso, url, selftext"
CSV_BLANKS = ", ".join(f"'' AS {c}" for c in LABEL_COLUMNS)
GRID_BLANKS = ", ".join(f"'' AS {c}" for c in LABEL_COLUMNS + REVIEW_COLUMNS)


def prefix_scan(cutoff_hours: int) -> str:
    """Listing scan with its stop rule, as a running flag along each listing."""
    return f"""scan AS (
  SELECT * FROM (
    SELECT *, created_utc >= cut AS young, coalesce(bool_or(created_utc < cut AND NOT stickied)
      OVER (PARTITION BY subreddit ORDER BY listing_pos), false) AS stopped
    FROM posts, (SELECT now - {cutoff_hours} * 3600 AS cut FROM clock))
  WHERE young AND NOT stopped)"""


def runs(schedule: tuple[int, int, int]) -> str:
    cadence, lookback, offset = schedule
    return f"""ticks AS (
  SELECT offset_k::BIGINT AS tick FROM
    (SELECT unnest(generate_series(
      (SELECT floor((min(created_utc) - {offset}) / {cadence})::BIGINT - 1 FROM posts),
      (SELECT ceil((max(created_utc) + {lookback} - {offset}) / {cadence})::BIGINT + 1 FROM posts)
    )) AS offset_k)),
seen_by AS (
  SELECT tick * {cadence} + {offset} AS run_at, post_id FROM ticks JOIN posts
  ON tick * {cadence} + {offset} >= created_utc
  AND tick * {cadence} + {offset} - {lookback} <= created_utc),
first_run AS (SELECT post_id, min(run_at) AS run_at FROM seen_by GROUP BY ALL)"""


RUN_REPORT = """
SELECT s.run_at, count(*) AS seen, count(f.post_id) AS first_seen,
  count(*) - count(f.post_id) AS seen_again
FROM seen_by s LEFT JOIN first_run f ON s.post_id = f.post_id AND s.run_at = f.run_at
GROUP BY s.run_at"""


def with_posts(*parts: str) -> str:
    *ctes, last = parts
    return "WITH " + ",\n".join([POSTS.strip(), *ctes]) + "\n" + last


def span_columns(p: str, flag: str) -> str:
    return f"""max(us) FILTER ({flag}) AS {p}_new, min(us) FILTER ({flag}) AS {p}_old"""


def span_report(p: str) -> str:
    return (
        f"{iso(p + '_new')} AS {p}_newest, {iso(p + '_old')} AS {p}_oldest, "
        f"coalesce(({p}_new / 1000000.0::DOUBLE - {p}_old / 1000000.0::DOUBLE) / 3600.0, 0.0) "
        f"AS {p}_hours"
    )


def term_table(batch_size: int) -> str:
    rows = [
        f"SELECT {i}::INTEGER AS ord, '{t}' AS term, {i // batch_size + 1}::INTEGER AS batch, "
        f"(SELECT count(*) FROM posts WHERE {word(t)}) AS n_posts"
        for i, t in enumerate(TEST_PAINS)
    ]
    return " UNION ALL ".join(rows)


MODES = """
SELECT mode, stream_no, count(*) AS posts FROM candidates JOIN (VALUES
  ('both', 0), ('both', 1), ('curated', 0), ('global', 1), ('both, search off', 0)
) AS m(mode, stream) ON stream_no = stream GROUP BY ALL"""

TEXT_MARKS = "CASE WHEN in_curated AND in_searched THEN 'curated+global' WHEN in_curated THEN 'curated' ELSE 'global' END"

PROVENANCE = f"""
SELECT n.post_id AS id, MORE {TEXT_MARKS} AS source,
  CASE WHEN in_searched THEN {listed(TEST_PAINS)} ELSE '' END AS matched_pain_keywords,
  CASE WHEN in_searched THEN {listed(TEST_TOOLS)} ELSE '' END AS matched_tools
FROM kept JOIN numbered n USING (ord) JOIN (
  SELECT *, post_id IN (SELECT post_id FROM curated) AS in_curated,
    post_id IN (SELECT post_id FROM searched) AS in_searched FROM posts) p
  ON p.post_id = n.post_id"""

CUR_CADENCE, CUR_LOOKBACK, CUR_OFFSET = CURATED_SCHEDULE
GLO_CADENCE, GLO_LOOKBACK, GLO_OFFSET = GLOBAL_SCHEDULE


def all_oracles() -> dict[str, str]:
    return {
        "raw_flatten": with_posts(
            "SELECT post_id, subreddit, title, text, author, created_utc, score, num_comments, "
            "url, stickied, listing_pos, visible_at FROM posts"
        ),
        "curated_scan": with_posts(
            prefix_scan(24), "SELECT post_id, created_utc FROM scan WHERE subreddit = 'src3'"
        ),
        "multi_scan": with_posts(
            COMMUNITY_LIST,
            prefix_scan(24),
            "SELECT list_pos::INTEGER AS list_pos, subreddit, post_id, created_utc FROM scan "
            "JOIN community_list ON lower(community) = lower(subreddit)",
        ),
        "archive_scan": with_posts(
            COMMUNITY_LIST,
            "SELECT post_id, list_pos::INTEGER AS list_pos, created_utc, length(text) AS n_chars FROM posts "
            "JOIN community_list ON lower(community) = lower(subreddit) "
            f"WHERE created_utc >= (SELECT now - {ARCHIVE_HOURS * 3600} FROM clock)",
        ),
        "source_skip": with_posts(
            COMMUNITY_LIST,
            "SELECT list_pos::INTEGER AS list_pos, community FROM community_list "
            "WHERE lower(community) NOT IN (SELECT lower(subreddit) FROM posts)",
        ),
        "global_search": with_posts(
            "day AS (SELECT * FROM posts WHERE created_utc >= (SELECT now - 86400 FROM clock))",
            ranked(BATCHES, LIMIT, word, "day"),
            "passed AS (SELECT * FROM ranked WHERE exact AND created_utc >= "
            "(SELECT now - 6 * 3600 FROM clock))",
            f"SELECT batch::INTEGER AS batch, rank, post_id, created_utc, {LISTS} FROM passed "
            "QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY batch, rank) = 1",
        ),
        "csv_scan": with_posts(CLEAN, f"SELECT {SOURCE_LIST}, {CSV_BLANKS} FROM clean"),
        "grid_scan": with_posts(CLEAN, f"SELECT {SOURCE_LIST}, {GRID_BLANKS} FROM clean"),
        "snapshot_read": with_posts(CLEAN, "SELECT id, selftext FROM clean"),
        "backend_choice": with_posts(
            CLEAN,
            f"SELECT backend, n_columns::INTEGER AS n_columns, count(*) AS n_rows, "
            f"count(DISTINCT selftext) AS n_bodies FROM clean, "
            f"(VALUES ('csv', 13), ('sheets', {len(GRID_COLUMNS)})) AS b(backend, n_columns) "
            "GROUP BY ALL",
        ),
        "csv_append": with_posts(
            CLEAN,
            KEPT_POSTS,
            f"SELECT {SOURCE_LIST}, {CSV_BLANKS} FROM stored UNION ALL "
            f"SELECT {SOURCE_LIST}, "
            + CSV_BLANKS.replace("'' AS label1", "subreddit AS label1")
            + " FROM fresh",
        ),
        "line_style": with_posts(
            CLEAN, KEPT_POSTS, "SELECT id, selftext, 13::BIGINT AS first_code FROM fresh"
        ),
        "grid_append": with_posts(CLEAN, f"SELECT {SOURCE_LIST}, {GRID_BLANKS} FROM clean"),
        "verified_append": with_posts(
            CLEAN,
            KEPT_POSTS,
            "SELECT id, created_iso, (SELECT count(*) FROM fresh) AS appended FROM fresh",
        ),
        "noop_append": with_posts(
            CLEAN,
            KEPT_POSTS,
            "SELECT (SELECT count(*) FROM stored) + (SELECT count(*) FROM fresh) AS n_rows, "
            "0::BIGINT AS appended",
        ),
        "dry_run": with_posts(CLEAN, KEPT_STREAMS, PROVENANCE.replace("MORE", "p.subreddit,")),
        "clean_project": with_posts(CLEAN, "SELECT * FROM clean"),
        "null_to_blank": with_posts("SELECT post_id, coalesce(author, '') AS author FROM posts"),
        "required_check": (
            "SELECT event_id, CASE event_type WHEN 'error' THEN 'post_id is required' "
            "WHEN 'signup' THEN 'subreddit is required' "
            "WHEN 'view' THEN 'created_utc must be numeric' "
            "WHEN 'click' THEN 'created_utc is no date' ELSE '' END AS reject_reason FROM events"
        ),
        "numeric_cast": (
            "SELECT event_id, CASE event_type WHEN 'click' THEN NULL "
            "WHEN 'view' THEN (value::VARCHAR || 'e2')::DOUBLE "
            "WHEN 'error' THEN (value::VARCHAR || '0')::DOUBLE ELSE value END AS number FROM events"
        ),
        "drop_transient": with_posts(
            CLEAN,
            "SELECT c.* FROM clean c JOIN posts p ON p.post_id = c.id "
            f"WHERE {some(TEST_PAINS)} AND {some(TEST_TOOLS)}",
        ),
        "lookback_filter": with_posts(
            "SELECT post_id, created_utc FROM posts "
            "WHERE created_utc >= (SELECT now - 13 * 3600 FROM clock)"
        ),
        "day_prefilter": with_posts(
            "SELECT post_id, created_utc FROM posts "
            "WHERE created_utc >= (SELECT now - 86400 FROM clock)"
        ),
        "allow_list": with_posts(
            COMMUNITY_LIST,
            "SELECT post_id, subreddit FROM posts "
            "WHERE lower(subreddit) IN (SELECT lower(community) FROM community_list)",
        ),
        "any_and_any": with_posts(
            f"SELECT post_id FROM posts WHERE {some(TEST_PAINS)} AND {some(TEST_TOOLS)}"
        ),
        "stream_select": with_posts(STREAMS, MODES),
        "anti_id": with_posts(
            CLEAN, "SELECT id FROM clean WHERE id = '' OR id NOT IN (SELECT id FROM stored)"
        ),
        "anti_text": with_posts(
            CLEAN,
            "SELECT id FROM clean WHERE selftext = '' "
            "OR selftext NOT IN (SELECT selftext FROM stored)",
        ),
        "semi_allow": (
            "SELECT conv_id, turn, role AS subreddit FROM conversations "
            "WHERE lower(role) IN ('user', 'system')"
        ),
        "batch_cross": with_posts(
            f"SELECT post_id, batch::INTEGER AS batch FROM ({crossed(BATCHES)})"
        ),
        "provenance": with_posts(CLEAN, KEPT_STREAMS, PROVENANCE.replace("MORE", "")),
        "batch_funnel": with_posts(
            RECENT,
            "SELECT b.batch::INTEGER AS batch, count(f.post_id) AS raw, "
            "count(*) FILTER (f.within) AS within_lookback, "
            "(SELECT count(*) FROM firsts WHERE firsts.batch = b.batch) AS new_exact "
            "FROM (VALUES (1), (2), (3), (4)) AS b(batch) LEFT JOIN found f "
            "ON f.batch = b.batch GROUP BY b.batch",
        ),
        "funnel_total": with_posts(
            RECENT, "SELECT count(*) AS distinct_matches, 4::INTEGER AS batches FROM firsts"
        ),
        "run_result": with_posts(
            CLEAN,
            KEPT_STREAMS,
            "SELECT (SELECT count(*) FROM stored) AS existing_rows, "
            "(SELECT count(*) FROM curated) AS curated_posts, "
            "(SELECT count(*) FROM searched) AS global_posts, "
            "(SELECT count(*) FROM candidates) AS combined_candidates, "
            "(SELECT count(*) FROM kept) AS unique_posts, true AS uploaded",
        ),
        "run_reports": with_posts(
            RECENT,
            COMMUNITY_LIST,
            "SELECT 'community' AS kind, list_pos::INTEGER AS number, community AS name, "
            "NULL::BIGINT AS raw, NULL::BIGINT AS within_lookback, count(post_id) AS posts "
            "FROM community_list LEFT JOIN posts ON lower(subreddit) = lower(community) "
            "AND created_utc >= (SELECT now - 13 * 3600 FROM clock) GROUP BY ALL "
            "UNION ALL SELECT 'batch', b.batch::INTEGER, b.name, count(f.post_id), "
            "count(*) FILTER (f.within), "
            "(SELECT count(*) FROM firsts WHERE firsts.batch = b.batch) FROM (VALUES "
            + ", ".join(f"({i}, '{', '.join(b)}')" for i, b in enumerate(BATCHES, start=1))
            + ") AS b(batch, name) LEFT JOIN found f ON f.batch = b.batch GROUP BY b.batch, b.name "
            f"UNION ALL SELECT 'search', {len(BATCHES)}::INTEGER, 'all', NULL, NULL, count(*) FROM firsts",
        ),
        "community_counts": with_posts(
            COMMUNITY_LIST,
            "SELECT list_pos::INTEGER AS list_pos, community, count(post_id) AS posts "
            "FROM community_list LEFT JOIN posts ON lower(subreddit) = lower(community) "
            "AND created_utc >= (SELECT now - 13 * 3600 FROM clock) GROUP BY ALL",
        ),
        "coverage_report": with_posts(
            COVERAGE,
            "counted AS (SELECT b.batch, count(post_id) AS raw, "
            f"count(*) FILTER (exact) AS exact, {span_columns('raw', 'post_id IS NOT NULL')}, "
            f"{span_columns('exact', 'exact')} FROM (SELECT unnest(range(1, "
            f"{len(TEST_GROUPS) + 1})) AS batch) b LEFT JOIN ranked r ON r.batch = b.batch "
            "GROUP BY b.batch)",
            "SELECT batch::INTEGER AS batch, raw, exact, CASE WHEN raw = 0 THEN 0.0::DOUBLE "
            "ELSE exact::DOUBLE / raw::DOUBLE * 100.0 END AS exact_pct, "
            f"{span_report('raw')}, {span_report('exact')} FROM counted",
        ),
        "coverage_total": with_posts(
            COVERAGE,
            "totals AS (SELECT count(*) AS summed_raw, count(DISTINCT post_id) AS distinct_raw, "
            "count(*) FILTER (exact) AS summed_exact, "
            "count(DISTINCT post_id) FILTER (exact) AS distinct_exact, "
            f"{span_columns('raw', 'true')}, {span_columns('exact', 'exact')} FROM ranked)",
            "SELECT summed_raw, distinct_raw, summed_exact, distinct_exact, "
            f"{iso('raw_new')} AS raw_newest, {iso('raw_old')} AS raw_oldest, "
            f"{iso('exact_new')} AS exact_newest, {iso('exact_old')} AS exact_oldest FROM totals",
        ),
        "cooccurrence": with_posts(
            f"marks AS (SELECT {word('er')} AS a, {word('la')} AS b FROM posts)",
            "SELECT cell, (SELECT count(*) FROM marks WHERE marks.a = c.a AND marks.b = c.b) "
            "AS posts FROM (VALUES ('both', true, true), ('only_a', true, false), "
            "('only_b', false, true), ('neither', false, false)) AS c(cell, a, b)",
        ),
        "dataset_stats": "SELECT count(*) AS n_rows, 5::INTEGER AS n_columns, true AS has_bytes FROM documents",
        "store_audit": with_posts(
            CLEAN,
            KEPT_POSTS,
            "SELECT true AS same_schema, (SELECT count(*) FROM stored) AS rows_before, "
            "(SELECT count(*) FROM stored) + (SELECT count(*) FROM fresh) AS rows_after, "
            "true AS grew_as_expected, 0::BIGINT AS duplicate_ids",
        ),
        "existence_sets": with_posts(
            CLEAN,
            "SELECT DISTINCT 'id' AS kind, id AS key FROM clean WHERE id <> '' UNION ALL "
            "SELECT DISTINCT 'text', to_base64(unhex(sha256(selftext))) FROM clean "
            "WHERE selftext <> ''",
        ),
        "distinct_by_id": (
            "SELECT conv_id, turn, role, text FROM conversations "
            "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"
        ),
        "prefix_stop": with_posts(
            prefix_scan(24), "SELECT subreddit, post_id, listing_pos FROM scan"
        ),
        "topn_per_batch": with_posts(
            COVERAGE, "SELECT batch::INTEGER AS batch, rank, post_id, exact FROM ranked"
        ),
        "first_seen": with_posts(
            COVERAGE,
            "SELECT post_id, batch::INTEGER AS batch, rank FROM ranked WHERE exact QUALIFY "
            "row_number() OVER (PARTITION BY post_id ORDER BY batch, rank) = 1",
        ),
        "ordered_dedup": with_posts(
            CLEAN,
            KEPT_STREAMS,
            "SELECT stream_no::INTEGER AS stream_no, part_no::INTEGER AS part_no, "
            "post_id AS id, c.subreddit, c.created_iso FROM kept JOIN numbered USING (ord) "
            "JOIN clean c ON c.id = post_id",
        ),
        "ordered_dedup_actions": (
            "WITH actions AS MATERIALIZED (SELECT event_id, 'u' || user_id AS id, "
            "props || '|' || event_type AS selftext, "
            "row_number() OVER (ORDER BY ts, event_id) AS ord FROM events), "
            f"rows AS (SELECT ord, id, md5(selftext) AS key FROM actions), "
            f"{one_by_one('rows', None)} "
            "SELECT event_id, id, selftext FROM actions JOIN kept USING (ord)"
        ),
        "ordered_dedup_ties": (
            "WITH alike AS (SELECT DISTINCT 'u' || user_id AS id, props || '|' || event_type AS selftext, "
            "epoch_us(ts) // 3600000000 AS hour FROM events), "
            "actions AS MATERIALIZED (SELECT *, row_number() OVER "
            "(ORDER BY hour, id, to_base64(unhex(sha256(selftext)))) AS ord FROM alike), "
            f"rows AS (SELECT ord, id, md5(selftext) AS key FROM actions), {one_by_one('rows', None)} "
            "SELECT id, selftext, hour FROM actions JOIN kept USING (ord)"
        ),
        "newest_sort": with_posts("SELECT post_id, created_utc FROM posts"),
        "source_order": with_posts(
            STREAMS,
            "SELECT stream_no::INTEGER AS stream_no, part_no::INTEGER AS part_no, place, "
            "post_id, to_base64(unhex(sha256(text))) AS body_key FROM candidates",
        ),
        "limit_report": with_posts(
            f"SELECT subreddit, post_id, {iso('us')} AS created, {LISTS}, title FROM posts "
            f"WHERE {some(TEST_PAINS)} AND {some(TEST_TOOLS)} "
            "ORDER BY created_utc DESC, post_id LIMIT 20"
        ),
        "stream_union": with_posts(
            STREAMS,
            f"SELECT stream_no::INTEGER AS stream_no, c.post_id, CASE WHEN stream_no = 1 THEN "
            f"{listed(TEST_TOOLS)} END AS matched_tools FROM candidates c "
            "JOIN posts p ON p.post_id = c.post_id",
        ),
        "vocab_partition_check": with_posts(
            "SELECT 'thon' AS term, 'missing' AS side, count(*) AS copies FROM posts "
            f"WHERE {word('thon')} UNION ALL "
            f"SELECT 'er', 'surplus', count(*) FROM posts WHERE {word('er')}"
        ),
        "search_text": with_posts(
            "SELECT post_id, md5(body) AS text_md5, length(body) AS n_chars FROM posts"
        ),
        "term_matches": with_posts(
            f"SELECT post_id, {word('er')} AS has_er, {word('La', flags='c')} AS has_la_cased, "
            f"{word('of the')} AS has_phrase, false AS has_blank FROM posts"
        ),
        "find_matches": with_posts(
            f"SELECT post_id, {listed([*TEST_PAINS, 'er'])} AS found FROM posts"
        ),
        "find_matches_many": with_posts(
            "syllables AS (SELECT unnest(list_zip(range(0, len(a)), a)) AS s FROM (SELECT ["
            + ", ".join(f"'{x}'" for x in TEST_SYLLABLES) + "] AS a)), "
            "terms AS (SELECT x.s[2] || y.s[2] AS term, x.s[1] AS i, y.s[1] AS j FROM syllables x, syllables y), "
            "told AS (SELECT DISTINCT post_id, unnest(string_split_regex(lower(title || chr(10) || text), "
            f"'{W}+')) AS term FROM posts), "
            "hits AS (SELECT post_id, string_agg(term, '|' ORDER BY i, j) AS found FROM told JOIN terms USING (term) "
            "GROUP BY post_id)",
            "SELECT post_id, coalesce(found, '') AS found FROM posts LEFT JOIN hits USING (post_id)",
        ),
        "find_matches_pages": (
            f"SELECT page_id, {listed([*TEST_TOOLS, 'utf-8', 'div', '</p>'], 'html')} AS found "
            "FROM pages"
        ),
        "matched_arrays": (
            "WITH turns AS (SELECT *, role || chr(10) || text AS body FROM conversations) "
            f"SELECT conv_id, turn, {LISTS} FROM turns "
            f"WHERE {some(TEST_PAINS)} AND {some(TEST_TOOLS)}"
        ),
        "term_batches": with_posts(term_table(BATCH)),
        "nonblank_terms": with_posts(term_table(3)),
        "epoch_to_iso": (
            f"SELECT event_id, {iso('epoch_us(ts)')} AS created, "
            "strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS whole, "
            f"{iso('(-round(value * 1000000.0::DOUBLE)::BIGINT)')} AS before_epoch, "
            "(epoch_us(ts) / 1000000.0::DOUBLE)::VARCHAR AS plain FROM events"
        ),
        "window_hours": with_posts(
            "SELECT subreddit, (max(created_utc) - min(created_utc)) / 3600.0::DOUBLE AS hours "
            "FROM posts GROUP BY subreddit"
        ),
        "percent": with_posts(
            f"SELECT subreddit, (count(*) FILTER ({some(TEST_TOOLS)}))::DOUBLE / count(*)::DOUBLE "
            "* 100.0 AS tool_pct FROM posts GROUP BY subreddit"
        ),
        "author_text": with_posts("SELECT post_id AS id, author FROM posts"),
        "permalink_url": with_posts("SELECT post_id AS id, url FROM posts"),
        "name_in": "SELECT event_id, event_type AS name FROM events",
        "incremental_append": with_posts(
            CLEAN,
            KEPT_STREAMS,
            "SELECT id, created_iso, subreddit FROM stored UNION ALL "
            "SELECT c.id, c.created_iso, c.subreddit FROM kept JOIN numbered USING (ord) "
            "JOIN clean c ON c.id = post_id",
        ),
        "serial_writes": with_posts(
            CLEAN,
            KEPT_POSTS,
            "SELECT id, created_iso, subreddit, 1::BIGINT AS copies FROM (SELECT id, created_iso, subreddit "
            "FROM stored UNION ALL SELECT id, created_iso, subreddit FROM fresh)",
        ),
        "snapshot_version": with_posts(
            CLEAN, KEPT_POSTS, "SELECT id, created_iso FROM stored"
        ),
        "sliding_runs": with_posts(runs(GLOBAL_SCHEDULE), RUN_REPORT),
        "sliding_runs_curated": with_posts(runs(CURATED_SCHEDULE), RUN_REPORT),
        "late_data": with_posts(
            f"""marks AS (
  SELECT floor((visible_at - created_utc) / 3600.0)::BIGINT AS delay_hours,
    EXISTS (SELECT 1 FROM (SELECT unnest(range(0, 40)) AS k) WHERE
      (floor(visible_at / {GLO_CADENCE}) + k) * {GLO_CADENCE} + {GLO_OFFSET} >= visible_at AND
      (floor(visible_at / {GLO_CADENCE}) + k) * {GLO_CADENCE} + {GLO_OFFSET} - {GLO_LOOKBACK}
        <= created_utc) AS caught FROM posts)""",
            "SELECT delay_hours, count(*) AS posts, count(*) FILTER (caught) AS caught, "
            "count(*) FILTER (NOT caught) AS missed FROM marks GROUP BY delay_hours",
        ),
        "run_windows": f"""WITH times AS (SELECT epoch_us(ts) / 1000000.0::DOUBLE AS s FROM events),
ends AS (SELECT (k * {CUR_CADENCE} + {CUR_OFFSET})::BIGINT AS run_at FROM (SELECT unnest(
  generate_series((SELECT floor(min(s) / {CUR_CADENCE})::BIGINT - 1 FROM times),
    (SELECT ceil(max(s) / {CUR_CADENCE})::BIGINT + 3 FROM times))) AS k))
SELECT run_at, count(*) AS seen FROM ends JOIN times
  ON s >= run_at - {CUR_LOOKBACK} AND s < run_at
WHERE run_at <= (SELECT max(s) - {CUR_LOOKBACK} FROM times) GROUP BY run_at""",
        "stream_first_seen": "SELECT DISTINCT 'u' || user_id AS post_id FROM events",
        "stream_first_copy": (
            "SELECT 'u' || user_id AS post_id, event_type AS batch, event_id AS rank FROM events "
            "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1"
        ),
        "late_data_stream": with_posts(
            f"""marks AS (
  SELECT created_utc, visible_at, floor((visible_at - created_utc) / 3600.0)::BIGINT AS delay_hours,
    ceil((visible_at - {GLO_OFFSET}) / {GLO_CADENCE})::BIGINT * {GLO_CADENCE} + {GLO_OFFSET} AS run_at FROM posts)""",
            "SELECT run_at, delay_hours, count(*) AS posts, count(*) FILTER (created_utc >= run_at - "
            f"{GLO_LOOKBACK}) AS caught, count(*) FILTER (created_utc < run_at - {GLO_LOOKBACK}) AS missed "
            "FROM marks GROUP BY run_at, delay_hours",
        ),
    }
