"""SQL twins, for DuckDB, of the queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_line_dedup"] = """
WITH RECURSIVE lines AS (
  SELECT doc_id, i - 1 AS line, parts[i] AS t FROM (
    SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i FROM (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
runs AS (
  SELECT doc_id, line, 1 AS n, md5(t) AS name FROM lines QUALIFY count(*) OVER (PARTITION BY t) > 1
  UNION ALL
  SELECT doc_id, line, n, name FROM (
    SELECT r.doc_id, r.line, r.n + 1 AS n, md5(r.name || l.t) AS name
    FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.line = r.line + r.n)
  QUALIFY count(*) OVER (PARTITION BY name) > 1),
marked AS (
  SELECT doc_id, line, t, regexp_matches(t, '[^ \t-\r]') AND row_number() OVER (PARTITION BY t ORDER BY doc_id, line) > 1 AS gone FROM lines),
ends AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY line), false) AS head FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_runs,
  coalesce(any_value(longest), 0)::BIGINT AS longest_run,
  sha256(coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM ends LEFT JOIN (SELECT doc_id, max(n) AS longest FROM runs GROUP BY doc_id) USING (doc_id) GROUP BY doc_id"""

ORACLES["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

_WORDS = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def _shingles(key: str, table: str) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(words[i:i + 4], ' ') AS s FROM (
      SELECT {key}, words, unnest(generate_series(1, len(words) - 4)) AS i FROM (SELECT {key}, {_WORDS} AS words FROM {table}))"""


CONTAMINATED = f"""
WITH items AS ({_shingles("item_id", "benchmark")}), docs AS ({_shingles("doc_id", "documents")}),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id),
met AS (SELECT doc_id, item_id, count(*) AS shared FROM docs JOIN items USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
FROM met JOIN sizes USING (item_id) WHERE shared >= 0.8 * item_shingles"""

ORACLES["op8_decontamination"] = CONTAMINATED

ORACLES["op12_filter_audit"] = """
WITH measured AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS words FROM documents),
failing AS (
  SELECT m.doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(m.doc_id > min(m.doc_id) OVER (PARTITION BY t), false) AS e,
    coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
  FROM measured m LEFT JOIN (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON m.doc_id = l.doc_id),
cells AS (
  SELECT part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS x
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT p.l || q.l || r.l || s.l || u.l AS filter_order
  FROM letters p JOIN letters q ON q.l <> p.l JOIN letters r ON r.l NOT IN (p.l, q.l)
  JOIN letters s ON s.l NOT IN (p.l, q.l, r.l) JOIN letters u ON u.l NOT IN (p.l, q.l, r.l, s.l)),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
fails AS (
  SELECT part, l, f, n, g, x, CASE l WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END AS hit,
    (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
    || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS hits
  FROM cells JOIN letters ON true),
applied AS (
  SELECT part, filter_order, step, l, n, g, x, hit, hits,
    hits <> '' AND regexp_matches(substr(filter_order, 1, step - 1), '[' || hits || '_]') AS gone
  FROM fails JOIN steps ON l = substr(filter_order, step, 1)),
counted AS (
  SELECT part, filter_order, step, any_value(l) AS l, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND hit), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND hit), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (hits = l), 0)::BIGINT AS unique_fails, coalesce(sum(g) FILTER (NOT gone AND hit), 0)::BIGINT AS good_lost,
    coalesce(sum(x) FILTER (NOT gone AND hit), 0)::BIGINT AS toxic_lost
  FROM applied GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, l)::BIGINT AS shapley
FROM counted"""
