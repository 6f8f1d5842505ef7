WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d
),
used AS MATERIALIZED (
  SELECT r, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*)::HUGEINT AS n
  FROM words GROUP BY ALL
),
kept AS MATERIALIZED (SELECT lang, term FROM used GROUP BY lang, term HAVING count(*) >= 3),
grp AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT u.lang, u.source, u.term, sum(u.n)::HUGEINT AS n FROM used u JOIN kept USING (lang, term) GROUP BY ALL),
cnt AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0)::HUGEINT AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN occ o USING (lang, source, term)
),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM cnt GROUP BY ALL),
p AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000::HUGEINT * (c.n + 1)) // (t.total + t.v) AS p FROM cnt c JOIN tot t USING (lang, source)
),
whole AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM cnt GROUP BY ALL),
wtot AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM whole GROUP BY lang),
q AS MATERIALIZED (
  SELECT w.lang, w.term, 1 + (1000000000::HUGEINT * (w.n + 1)) // (t.total + t.v) AS q FROM whole w JOIN wtot t USING (lang)
),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::HUGEINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
