"""SQL for the queries that SQL can express, for an engine that reads the same tables."""

from __future__ import annotations

from tapelake.llm import chat_format, hard_negatives, line_dedup, quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS k, {_WORDS} AS w FROM documents),
win AS (SELECT k, i, w[i:i + 4] AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1))) AS t(i)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM win) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT i + j) AS n FROM twice, range(0, 5) AS r(j) GROUP BY k),
lines AS (
  SELECT k, i, l, trim(l, {_SPACES}) AS t FROM (SELECT k, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
),
measured AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS lw, length(t) AS n, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS s FROM lines
),
judged AS (
  SELECT k, i, l, t, length(t) > 0 AND (
    s > n * {quality_rules.MAX_SYMBOLS}
    OR (len([x for x in lw if suffix(x, '!!')]) >= 2 AND len([x for x in lw if suffix(x, '!!')]) > len(lw) * {quality_rules.MAX_SHOUTS})
    OR (len([x for x in lw if x IN ({", ".join(f"'{s}'" for s in quality_rules.SEPARATORS)})]) >= 2
        AND len([x for x in lw if x IN ({", ".join(f"'{s}'" for s in quality_rules.SEPARATORS)})]) > len(lw) * {quality_rules.MAX_SEPARATORS})
    OR (len(lw) >= {quality_rules.MIN_WORDS} AND len([i for i in range(2, len(lw) + 1) if lw[i] = lw[i - 1]]) > len(lw) * {quality_rules.MAX_STUTTER})
    OR (len(lw) < {quality_rules.MIN_OPEN_WORDS} AND NOT regexp_matches(t, '{quality_rules._SENTENCE_END.replace("'", "''")}'))
    OR (len(lw) <= {quality_rules.MAX_STOCK_WORDS} AND regexp_matches(t, '{quality_rules._STOCK}'))
  ) AS fails FROM measured
),
per AS (
  SELECT k, count(*) FILTER (length(t) > 0) - count(DISTINCT l) FILTER (length(t) > 0) AS dup,
    coalesce(sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (fails), 0) AS lost
  FROM judged GROUP BY k
),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    dup::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, lost::BIGINT AS lost_chars
  FROM d LEFT JOIN covered USING (k) LEFT JOIN per USING (k)
)
SELECT *, (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words) AND lost_chars <= {quality_rules.MAX_LOST} * word_chars AS kept
FROM base
"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(/?s>|\||/?INST\])', '\1\2\\\3', 'g')"

OP5 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat_format.START + chat_format.SEPARATOR + chat_format.END)} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars,
  0::BIGINT AS expanded_tokens
FROM t GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM items),
places AS (SELECT k, i, n, w[i:i + n - 1] AS g FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
met AS (SELECT k, i, places.n AS n, item_id FROM places JOIN items USING (n, g)),
hit AS (SELECT k, count(DISTINCT i + j) AS n FROM met, unnest(range(0, n)) AS r(j) GROUP BY k),
found AS (SELECT k, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM met GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN found USING (k)
"""

OP12 = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor({hard_negatives.SCALE} * x::DOUBLE) for x in embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r AS a JOIN r AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hard_negatives.TOP}),
n AS (
  SELECT anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
    s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND {hard_negatives.LEAST_PERCENT} * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT * FROM n WHERE rank <= {hard_negatives.TOP}
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT k, doc_id, i, line, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT k, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d)
),
crowded AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= {line_dedup.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INTEGER) >= {line_dedup.MIN_DOCUMENTS}
),
judged AS (SELECT k, i, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS lost FROM lines LEFT JOIN crowded USING (key)),
left_over AS (SELECT k, count(*) FILTER (lost) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost) AS kept FROM judged GROUP BY k)
SELECT doc_id, len(l)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM d JOIN left_over USING (k)
"""

ORACLE_SQL = {"op2_quality_rules": OP2, "op5_chat_format": OP5, "op6_decontaminate": OP6, "op12_hard_negatives": OP12, "op13_line_dedup": OP13}
