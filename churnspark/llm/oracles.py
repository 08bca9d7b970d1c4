"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

_BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

OP1 = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS position FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_BLANK_CHARS}), {_UPPER}, {_LOWER}) AS key FROM placed
), shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(k.doc_id <> s.holder, false) AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP5 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
), sized AS (
  SELECT *, length(regexp_replace(text, '[\\<>]', '..', 'g')) + length(regexp_replace(role, '[\\<>]', '..', 'g'))
    + length('<turn >') + length('</turn>') AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# Sets of 4 words, all pairs that share one, links by the sizes of sets, reachable documents.
OP6 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) END AS shingles
  FROM split
), sizes AS (
  SELECT doc_id, len(shingles) AS n FROM sets
), members AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS common
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT one, two FROM pairs JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = two
  WHERE 100 * common >= 80 * (x.n + y.n - common)
), edges AS (
  SELECT one, two FROM links UNION ALL SELECT two, one FROM links
), reached AS (
  SELECT doc_id, doc_id AS start FROM sizes
  UNION
  SELECT edges.two, reached.start FROM reached JOIN edges ON edges.one = reached.doc_id
)
SELECT doc_id, max(n) AS n_shingles, min(start) AS component_id, doc_id = min(start) AS kept
FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP9 = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS s,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2 * s / w AS cap_level, sum(2 * s) OVER o AS held, sum(w) OVER o AS used,
    1.5 * (SELECT sum(s) FROM ranked) AS total, (SELECT sum(w) FROM ranked) AS weights
  FROM ranked WINDOW o AS (ORDER BY 2 * s / w RANGE UNBOUNDED PRECEDING)
), candidates AS (
  SELECT CAST(1.5 * (SELECT sum(s) FROM ranked) AS DOUBLE) / (SELECT sum(w) FROM ranked) AS level, -1.0 AS cap_level
  UNION ALL
  SELECT (total - held) / (weights - used), cap_level FROM levels WHERE weights > used
), chosen AS (
  SELECT arg_min(level, cap_level) AS level FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM levels l WHERE l.cap_level > c.cap_level AND l.w * c.level > 2 * l.s)
), targets AS (
  SELECT source, s, least(w * (SELECT level FROM chosen), 2 * s) AS target,
    CASE WHEN s > 0 THEN CAST(floor(least(w * (SELECT level FROM chosen), 2 * s) / s) AS BIGINT) ELSE 0 END AS whole
  FROM ranked
), running AS (
  SELECT d.*, t.s, t.target, t.whole, t.target - t.whole * t.s AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash RANGE UNBOUNDED PRECEDING) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.hash) AS own
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), picked AS (
  SELECT *, CASE WHEN upto <= budget THEN 1 WHEN upto - own <= budget AND upto - budget < budget - (upto - own) THEN 1
    ELSE 0 END AS extra
  FROM running
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target,
  CAST(size * (whole + extra) AS BIGINT) AS taken
FROM picked
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1, "op5_chat_format": OP5, "op6_near_dedup": OP6, "op9_mixing": OP9}
