"""SQL (DuckDB dialect) of the queries that SQL can express over whole tables."""

from __future__ import annotations

#: Windows of 100 bytes over hexadecimal texts; of equal ones all but the first
#: count, and windows at most 100 apart cover one run.
OP1 = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
runs AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM later)),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS e FROM runs GROUP BY doc_id, run),
parts AS (
  SELECT doc_id, e AS f, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), -1) AS t FROM spans
  UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(h, 2 * f + 1, 2 * (CASE WHEN t < 0 THEN n ELSE t END - f)), '' ORDER BY f) AS h
  FROM parts p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id),
sums AS (SELECT doc_id, sum(e - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

#: Pairs through an inverted index of shingles, components by reachability.
OP2 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(x, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT links.y, reach.c FROM reach JOIN links ON links.x = reach.x WHERE reach.c < links.y)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(reach.c) AS component_id, s.doc_id = min(reach.c) AS kept
FROM s JOIN reach ON reach.x = s.doc_id GROUP BY s.doc_id, s.s"""

#: Scores of all documents that share a term with an item, ranked.
OP11 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
c AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
t AS MATERIALIZED (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * c.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, c GROUP BY term, c.docs),
a AS (
  SELECT t.doc_id, t.term, f.weight * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + CAST((50 * t.n * c.docs) // c.terms AS BIGINT)))) AS v
  FROM t JOIN f ON f.term = t.term, c),
s AS (SELECT i.item_id, a.doc_id, CAST(sum(a.v) AS BIGINT) AS score FROM i JOIN a ON a.term = i.term GROUP BY i.item_id, a.doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""

#: All n-grams counted, cut, compared with the longer ones and ranked.
OP12 = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS s FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(s, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
  GROUP BY lang, phrase),
r AS (
  SELECT m.lang, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank, m.phrase, a, l, r, score
  FROM m LEFT JOIN inner_parts i ON i.lang = m.lang AND i.phrase = m.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n,
  CAST(score AS BIGINT) AS score
FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000"""

SQL: dict[str, str] = {"op1_suffix_dedup": OP1, "op2_hyperminhash": OP2, "op11_ranked_search": OP11, "op12_collocations": OP12}
