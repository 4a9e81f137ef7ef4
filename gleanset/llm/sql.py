"""Independent SQL for the queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH pages AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
told AS (
    SELECT DISTINCT doc_id, source, line
    FROM (SELECT doc_id, source, unnest(lines) AS line FROM pages)
    WHERE trim(line, E' \t\r\f\v') <> ''
),
totals AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
bad AS (
    SELECT told.source, line
    FROM told JOIN totals ON told.source IS NOT DISTINCT FROM totals.source
    GROUP BY told.source, line, host_pages
    HAVING count(*) >= 3 AND count(*) * 10 > host_pages
),
bad_lists AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
cut AS (
    SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
    FROM pages LEFT JOIN bad_lists ON pages.source IS NOT DISTINCT FROM bad_lists.source
)
SELECT doc_id,
       coalesce(len(lines), 0)::BIGINT AS n_lines,
       coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       CASE WHEN lines IS NOT NULL THEN sha256(array_to_string(kept, chr(10))) END AS text_sha256
FROM cut
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES
        (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'),
        (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped AS (
    SELECT *, regexp_replace(
        text, '(<|\[)(\\*)(/?s>|/?(?:SYS|INST|ROLE)\]|SEP\])', '\1\\\2\3', 'g') AS safe,
        lag(role) OVER w IS DISTINCT FROM role AS opens,
        lead(role) OVER w IS DISTINCT FROM role AS closes
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
sized AS (
    SELECT *, length(safe)
        + CASE WHEN NOT opens THEN 5
               WHEN role = 'system' THEN 5 WHEN role = 'user' THEN 6 WHEN role = 'assistant' THEN 3
               ELSE 11 + length(role) END
        + CASE WHEN NOT closes THEN 0
               WHEN role = 'system' THEN 6 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 4
               ELSE 7 END AS chars
    FROM escaped
)
SELECT conv_id,
       count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _merkle_up(prefix: str, levels: int) -> list[str]:
    """Levels ``{prefix}1`` ... over ``{prefix}0 (g, place, n, digest)``; a lone node stays as it is."""
    return [
        f"""{prefix}{k} AS (
    SELECT g, place // 8 AS place, (n + 7) // 8 AS n,
           CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,
           list(digest ORDER BY place) AS kids
    FROM (SELECT g, place, n, digest FROM {prefix}{k - 1}) GROUP BY g, place // 8, n
)"""
        for k in range(1, levels + 1)
    ]


def _merkle_down(prefix: str, start: str, levels: int, name: str) -> list[str]:
    """Per row of ``start (g, place, proof, folded)`` the siblings of every level and the folded digest."""
    steps, last = [], start
    for k in range(1, levels + 1):
        left = "array_to_string(kids[1 : (s.place % 8)::INT], '')"
        right = "array_to_string(kids[(s.place % 8)::INT + 2 :], '')"
        steps.append(f"""{name}{k} AS (
    SELECT s.* REPLACE (s.place // 8 AS place,
        CASE WHEN s.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
        CASE WHEN s.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded,
        (s.n + 7) // 8 AS n)
    FROM {last} s JOIN {prefix}{k} p ON s.g = p.g AND s.place // 8 = p.place
)""")
        last = f"{name}{k}"
    return steps


# Levels written out: eight to the eighth rows in a language, eight to the fourth languages.
_ROW_LEVELS, _GROUP_LEVELS = 8, 4
_BITS = "list_reduce([n] || repeat([0], 8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OTHER_FIELDS = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

MERKLE = ",\n".join([
    f"""WITH crc_table AS (SELECT list({_BITS}::BIGINT ORDER BY n) AS crcs FROM range(256) t(n)),
told AS (
    SELECT doc_id, coalesce('+' || lang, '') AS g,
           sha256({_OTHER_FIELDS} || {_field("text")}) AS leaf,
           sha256({_OTHER_FIELDS} || {_field(_LOWERED)}) AS lowered,
           list_reduce(
               [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
               lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])
           ) AS rest
    FROM documents, crc_table
),
leaves AS (
    SELECT *, CASE WHEN doc_id IS NOT NULL AND xor(rest, 4294967295) % 3 = 0 THEN lowered ELSE leaf END AS claim,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY g) AS n
    FROM told
),
up0 AS (SELECT g, place, n, leaf AS digest FROM leaves)""",
    *_merkle_up("up", _ROW_LEVELS),
    f"""subroots AS (
    SELECT g AS lang_key, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS spot, count(*) OVER () AS langs
    FROM up{_ROW_LEVELS}
),
top0 AS (SELECT 0 AS g, spot AS place, langs AS n, subroot AS digest FROM subroots)""",
    *_merkle_up("top", _GROUP_LEVELS),
    "down0 AS (SELECT doc_id, leaf, g, place, n, '' AS proof, claim AS folded FROM leaves)",
    *_merkle_down("up", "down0", _ROW_LEVELS, "down"),
    f"""over0 AS (
    SELECT d.doc_id, d.leaf, subroot, 0 AS g, spot AS place, langs AS n, proof, folded
    FROM down{_ROW_LEVELS} d JOIN subroots ON g = lang_key
)""",
    *_merkle_down("top", "over0", _GROUP_LEVELS, "over"),
]) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = digest AS verified
FROM over{_GROUP_LEVELS} CROSS JOIN (SELECT digest FROM top{_GROUP_LEVELS})
"""


def llm_oracles() -> dict[str, str]:
    return {"op2_line_dedup": LINE_DEDUP, "op3_chat_format": CHAT_FORMAT, "op12_merkle": MERKLE}
