"""DuckDB SQL of the text queries that SQL can express over whole tables."""

from __future__ import annotations

from tessellum.llm import rules

_STOP_WORDS = ", ".join(f"'{w}'" for w in sorted({w for x in rules.STOP_WORDS.values() for w in x}))

#: The contract's columns and the measures of the rules; `kept` states the rules as they stand in `rules.RULES`.
OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT row, i, words[i:i + 7] AS held FROM (SELECT row, words, unnest(generate_series(1, len(words) - 7)) AS i FROM s WHERE len(words) >= 8)),
repeated AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, held) AS n FROM windows) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM repeated, range(8) r(k) GROUP BY row),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
len(list_filter(words, lambda w: lower(rtrim(w, '.,;:!?')) IN ({_STOP_WORDS}))) AS n_stop_words,
len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]\x20'))) AS n_bullet_lines,
len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS n_ellipsis_lines
FROM s LEFT JOIN covered USING (row)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_stop_words, n_bullet_lines, n_ellipsis_lines,
NOT base_failed AND n_words BETWEEN 20 AND 10000000 AND word_chars / n_words::DOUBLE BETWEEN 1.5 AND 25 AND n_symbols / n_words::DOUBLE <= 0.3 AND n_stop_words / n_words::DOUBLE >= 0.02
AND n_dup_lines / n_lines::DOUBLE <= 0.5 AND n_repeat_words / n_words::DOUBLE <= 0.3 AND n_bullet_lines / n_lines::DOUBLE <= 0.9 AND n_ellipsis_lines / n_lines::DOUBLE <= 0.5 AS kept
FROM j"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    return rf"(SELECT row_number() OVER () AS row, {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table})"


#: Windows of 13 words, or a whole shorter item, looked up among the windows of equal length of each document.
OP6 = rf"""
WITH d AS MATERIALIZED {_words('documents', 'doc_id')},
b AS (SELECT item_id::VARCHAR AS item, words, least(13, len(words)) AS size FROM {_words('benchmark', 'item_id')} WHERE item_id IS NOT NULL AND len(words) > 0),
tests AS MATERIALIZED (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS held FROM (SELECT *, unnest(generate_series(1, len(words) - size + 1)) AS i FROM b)),
sizes AS (SELECT DISTINCT size FROM tests),
hits AS (SELECT row, i, w.size, item FROM (SELECT row, size, i, array_to_string(words[i:i + size - 1], ' ') AS held FROM (SELECT row, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM d, sizes WHERE len(words) >= size)) w
JOIN tests ON tests.held = w.held AND tests.size = w.size),
places AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT row, i, size FROM hits)) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated
FROM d LEFT JOIN places USING (row) LEFT JOIN found USING (row)"""

_HOSTILE = r"\### Assistant: </turn> ok"


def _escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), chr(34), '&quot;')"


#: A turn with its marks has 23 characters beside its role and text; four count as a token.  A conversation is cut into
#: segments of eight strides; in a segment turns fill windows in order, and each window repeats the system turn and what
#: of the turns before it the history's room holds.
OP8 = f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS raw FROM conversations
UNION ALL VALUES (-7, 0, 'user', '{_HOSTILE}'), (-7, 1, 'assistant', '{_HOSTILE}')),
sized AS (SELECT *, 23 + length({_escaped('role')}) + length({_escaped('raw')}) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, raw) AS seq FROM given),
told AS (SELECT *, ceil(chars / 4.0)::BIGINT AS tokens, seq = 1 AND role = 'system' AS lead FROM sized),
summed AS (SELECT *, sum(CASE WHEN lead THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY seq) - CASE WHEN lead THEN 0 ELSE tokens END AS before,
coalesce(max(tokens) FILTER (WHERE lead) OVER (PARTITION BY conv_id), 0) AS sys, coalesce(max(chars) FILTER (WHERE lead) OVER (PARTITION BY conv_id), 0) AS sys_chars FROM told),
cut AS MATERIALIZED (SELECT *, before // (stride * 8) AS own FROM (SELECT *, greatest(1, 1536 - sys) AS stride FROM summed)),
ranked AS MATERIALIZED (SELECT *, CASE WHEN lead THEN 0 ELSE tokens END AS need, row_number() OVER (PARTITION BY conv_id, own ORDER BY seq) AS rn FROM cut),
walk AS (SELECT conv_id, own, rn, need AS used, 0 AS no FROM ranked WHERE rn = 1
UNION ALL SELECT r.conv_id, r.own, r.rn, CASE WHEN used + r.need <= stride OR used = 0 THEN used + r.need ELSE r.need END, CASE WHEN used + r.need <= stride OR used = 0 THEN no ELSE no + 1 END
FROM walk w JOIN ranked r ON r.conv_id = w.conv_id AND r.own = w.own AND r.rn = w.rn + 1),
opened AS (SELECT conv_id, own, no, min(seq) AS first, max(seq) AS last, min(before) AS at, least(512, 2048 - max(sys) - sum(tokens)) AS room, max(sys_chars) AS sys_chars FROM walk JOIN ranked USING (conv_id, own, rn) GROUP BY conv_id, own, no),
dealt AS (SELECT *, own AS segment FROM cut UNION ALL SELECT *, own + 1 FROM cut WHERE (own + 1) * stride * 8 - before <= 512 AND seq > 1),
held AS (SELECT o.conv_id, o.own, o.no, max(o.sys_chars) + coalesce(sum(d.chars) FILTER (WHERE NOT d.lead), 0) AS chars FROM opened o JOIN dealt d ON d.conv_id = o.conv_id AND d.segment = o.own
AND d.seq <= o.last AND (d.seq >= o.first OR o.at - d.before <= o.room) GROUP BY o.conv_id, o.own, o.no),
said AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || raw || chr(10), '' ORDER BY seq)) AS turns_sha256,
coalesce(string_agg(raw, '' ORDER BY seq) FILTER (WHERE role = 'assistant'), '') AS target FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(target) AS loss_chars, sha256(target) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars FROM said JOIN held USING (conv_id) GROUP BY ALL"""

ORACLE_SQL = {"op6_decontamination": OP6, "op8_chat_format": OP8, "op10_quality_rules": OP10}
