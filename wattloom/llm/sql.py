"""The same results in DuckDB SQL, for the operators that SQL can express."""

OP3 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
rules(verdict, rule, rhost, rpath) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')),
m AS (
  SELECT p.*, r.rule, r.verdict, row_number() OVER (
           PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS n
  FROM p LEFT JOIN rules r
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""

WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
         r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

OP4 = rf"""
WITH iw AS (SELECT item_id, {WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM iw, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM items),
found AS (
  SELECT doc_id, i, d.m, item_id
  FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM dw, sizes, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)) d
  JOIN items USING (m, g)),
hit AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS at FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(t, ',' ORDER BY t) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit h USING (doc_id) LEFT JOIN named k USING (doc_id)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS l
           FROM documents),
totals AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
counts AS (SELECT source, line, count(*) AS n
           FROM (SELECT source, unnest(list_distinct(l)) AS line FROM d) GROUP BY source, line),
common AS (
  SELECT c.source, list(line) AS lines FROM counts c JOIN totals t
    ON c.source IS NOT DISTINCT FROM t.source
  WHERE n > pages * CAST(0.08 AS DOUBLE)
    AND NOT regexp_full_match(line, '[\x20\x09-\x0D]*')
  GROUP BY c.source),
k AS (
  SELECT doc_id, d.source, text, l,
         list_filter(l, lambda x: NOT list_contains(coalesce(lines, []), x)) AS kept
  FROM d LEFT JOIN common c ON c.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
       CAST(len(l) - len(kept) AS BIGINT) AS n_removed
FROM k
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
w AS (SELECT row, lang, source, term, count(*) AS n
      FROM (SELECT row, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS of FROM w GROUP BY ALL HAVING count(*) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(of) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, sum(n) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
g AS (SELECT lang, source, coalesce(t.n, 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN totals t USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.of + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (
         PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS w
  FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
          FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, MAP {
           'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
           'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t),
           'D': regexp_matches(t, '[#$%&*|]'),
           'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)} AS f
  FROM d LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, f),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
played AS (
  SELECT part, o, step, o[step] AS x, f[o[step]] AS fails, n, good, toxic,
         len(list_filter(range(1, step), lambda i: f[o[i]])) = 0 AS here,
         len(list_filter(map_values(f), lambda b: b)) = 1 AS alone
  FROM cells, steps),
summed AS (
  SELECT part, o, step, x, sum(n) FILTER (here AND NOT fails) AS kept,
         sum(n) FILTER (here AND fails) AS removed, sum(n) FILTER (NOT here AND fails) AS redundant,
         sum(n) FILTER (fails AND alone) AS unique_fails, sum(good) FILTER (here AND fails) AS good_lost,
         sum(toxic) FILTER (here AND fails) AS toxic_lost
  FROM played GROUP BY ALL)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley
FROM summed
"""

ORACLE = {"op3_url_filter": OP3, "op4_decontaminate": OP4, "op8_line_dedup": OP8,
          "op11_source_divergence": OP11, "op12_filter_interaction": OP12}
