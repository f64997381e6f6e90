"""DuckDB SQL for the queries whose whole result SQL can say."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 80 * (len(a.s) + len(b.s) - c)),
n AS MATERIALIZED (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, n.b FROM r JOIN n ON r.seen = n.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id FROM s JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) m ON m.node = s.doc_id
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
v AS MATERIALIZED (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0) x),
lengths AS (SELECT DISTINCT n FROM v),
g AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths) x),
h AS MATERIALIZED (SELECT g.doc_id, g.n, g.i, v.item FROM g JOIN v ON g.g = v.g AND g.n = v.n),
places AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) x GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM h) x GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: alpha, delta, cost and steps of ``quality.Risk``; four rules
QUALITY = r"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t) x) y),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM g WHERE c > 1) x GROUP BY 1),
f AS MATERIALIZED (SELECT t.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id),
base AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
score AS MATERIALIZED (SELECT doc_id, lang, base_failed, unnest([
  {'rule': 'symbols', 'at': least(CAST(1 AS DOUBLE), CAST(n_symbols AS DOUBLE) / greatest(word_chars, 1))}, {'rule': 'lines', 'at': least(CAST(1 AS DOUBLE), CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1))},
  {'rule': 'repeats', 'at': least(CAST(1 AS DOUBLE), CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1))}, {'rule': 'long_words', 'at': least(CAST(1 AS DOUBLE), CAST(word_chars AS DOUBLE) / greatest(n_words, 1) / 40)}]) AS s FROM base),
step AS MATERIALIZED (SELECT doc_id, lang, base_failed, s.rule AS rule, CAST(floor(s.at * 50) AS INTEGER) AS step FROM score),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
counts AS (SELECT lang, rule, step, count(*) FILTER (good = 1) AS good, count(*) FILTER (good <> 1) AS bad FROM step JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY 1, 2, 3),
tried AS (SELECT *, sum(good) OVER (PARTITION BY lang, rule) AS n, sum(good) OVER (PARTITION BY lang, rule ORDER BY step DESC) AS k, sum(bad) OVER (PARTITION BY lang, rule ORDER BY step DESC) AS caught FROM counts),
held AS (SELECT *, CASE WHEN step > 0 AND k < n * 0.005 AND list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995))))
  <= 0.05 / (4 * greatest(1, (SELECT count(DISTINCT coalesce('=' || lang, '')) FROM counts))) THEN 0 ELSE 1 END AS failed FROM tried),
sure AS (SELECT *, caught - 20 * k AS gain FROM (SELECT *, sum(failed) OVER (PARTITION BY lang, rule ORDER BY step DESC) AS so_far FROM held) x WHERE so_far = 0),
cut AS (SELECT lang, rule, step FROM (SELECT *, row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step DESC) AS i FROM sure WHERE gain > 0) x WHERE i = 1),
hit AS (SELECT DISTINCT s.doc_id FROM step s JOIN cut c ON s.lang IS NOT DISTINCT FROM c.lang AND s.rule = c.rule AND s.step >= c.step)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM hit) AS kept FROM base
"""
