"""DuckDB SQL with the rows of the queries that SQL can express, by plain means: all windows, all shared shingles, all diagonals."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY_RULES_SQL = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NOT NULL THEN lower(regexp_extract(source, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/?#]*)', 1)) END AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), win AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT * FROM win SEMI JOIN twice USING (doc_id, k)), (SELECT unnest(range(5)) AS j) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id
), base AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
), hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS k FROM judged GROUP BY host
), sums AS (
  SELECT sum(n)::DOUBLE AS n, sum(k)::DOUBLE / sum(n) AS mean, count(*) AS h, sum(n::DOUBLE * n) AS n2, sum(k::DOUBLE * k / n) AS k2 FROM hosts
), spreads AS (
  SELECT mean, CASE WHEN n - n2 / n - (h - 1) <> 0 THEN (k2 - n * mean * mean - (h - 1) * mean * (1 - mean)) / (n - n2 / n - (h - 1)) END AS spread FROM sums
), prior AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1.0), 1e6) ELSE 1e6 END AS weight FROM spreads
), rates AS (
  SELECT host, (k + mean * weight) / (n + weight) AS rate FROM hosts, prior
)
SELECT doc_id, j.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 6) AS host_rate, NOT base_failed AND NOT rate > 0.5 AS kept
FROM judged j JOIN rates r ON j.host IS NOT DISTINCT FROM r.host
"""

NEAR_JOIN_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 4)) AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT DISTINCT x AS doc_id, x AS c FROM both_ways UNION SELECT y, c FROM reach JOIN both_ways ON x = doc_id
), least_of AS (
  SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS h FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS h FROM benchmark
), dt AS (
  SELECT doc_id, unnest(h) AS t, generate_subscripts(h, 1) AS p FROM d
), bt AS (
  SELECT item_id, len(h) AS n, unnest(h) AS t, generate_subscripts(h, 1) AS q FROM b
), e AS (
  SELECT doc_id, item_id, p - q AS shift, n, q FROM dt JOIN bt USING (t)
), many AS (
  SELECT doc_id, item_id, shift FROM e GROUP BY ALL HAVING count(*) >= least(any_value(n), 3)
), far AS (
  SELECT e.*, lead(q, 6) OVER w - q < 10 AS dense, lead(q, 10) OVER w - q < 13 AS stretch FROM e SEMI JOIN many USING (doc_id, item_id, shift) WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY q)
), diagonals AS (
  SELECT doc_id, item_id, shift, any_value(n) AS n, count(*) / any_value(n) AS own, coalesce(bool_or(dense), false) AS dense, coalesce(bool_or(stretch), false) OR count(*) / any_value(n) >= 0.5 AS alone
  FROM far GROUP BY doc_id, item_id, shift
), marked AS (
  SELECT * FROM diagonals WHERE (dense OR alone) AND own * n >= least(n, 3)
), together AS (
  SELECT doc_id, item_id, count(DISTINCT q) AS k FROM e SEMI JOIN (SELECT * FROM marked WHERE dense) USING (doc_id, item_id, shift) GROUP BY doc_id, item_id
), covers AS (
  SELECT doc_id, item_id, greatest(max(own), coalesce(any_value(k) / any_value(n), 0)) AS cover, bool_or(alone) AS alone FROM marked LEFT JOIN together USING (doc_id, item_id) GROUP BY doc_id, item_id
), leaks AS (
  SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item, max(cover) AS cover FROM covers WHERE alone OR cover >= 0.5 GROUP BY doc_id
)
SELECT doc_id, n_items IS NOT NULL AS contaminated, n_items IS NULL AS kept, coalesce(n_items, 0)::BIGINT AS n_items, first_item, round(coalesce(cover, 0.0), 6) AS cover FROM d LEFT JOIN leaks USING (doc_id)
"""
