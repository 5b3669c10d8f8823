"""DuckDB SQL for the queries that SQL can express, written apart from the Spark side."""

OP3_NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS grams FROM d),
c AS (SELECT grams, len(grams) AS n, min(doc_id) AS low, row_number() OVER () AS c FROM s WHERE len(grams) > 0 GROUP BY grams),
e AS (SELECT c, n, unnest(grams) AS gram FROM c),
half AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.gram = b.gram AND a.c < b.c AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
         GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
link AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT c AS a, c AS b FROM c UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
lowest AS (SELECT reach.a AS c, min(c.low) AS low FROM reach JOIN c ON reach.b = c.c GROUP BY reach.a),
degree AS (SELECT a AS c, count(*) AS n_links FROM link GROUP BY a)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, coalesce(lowest.low, s.doc_id) AS component_id, coalesce(degree.n_links, 0) AS n_links
FROM s LEFT JOIN c ON s.grams = c.grams LEFT JOIN lowest ON lowest.c = c.c LEFT JOIN degree ON degree.c = c.c
"""

OP10_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR))), 1, 12) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / CAST(weight AS DOUBLE), source NULLS LAST) AS k FROM s),
f AS (SELECT a.source, a.source_size, a.weight, a.k,
        CAST((SELECT sum(source_size) FROM o) - coalesce((SELECT sum(3 * b.source_size) FROM o b WHERE b.k < a.k), 0) AS DOUBLE) / CAST((SELECT sum(b.weight) FROM o b WHERE b.k >= a.k) AS DOUBLE) AS level
      FROM o a),
first_open AS (SELECT min(k) AS k FROM f WHERE level * weight <= 3 * source_size),
t AS (SELECT f.source, f.source_size, CASE WHEN f.k < p.k OR p.k IS NULL THEN CAST(3 * f.source_size AS DOUBLE) ELSE (SELECT g.level FROM f g WHERE g.k = p.k) * f.weight END AS target FROM f, first_open p),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * source_size AS rest FROM p),
q AS (SELECT d.*, r.source_size, r.target, r.whole, r.rest, least(r.rest * CAST(1 AS DOUBLE) / CAST(r.source_size AS DOUBLE), CAST(1 AS DOUBLE) - CAST(1e-12 AS DOUBLE)) AS chance FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
z AS (SELECT *, (u / (1 - u)) / (chance / (1 - chance)) AS odds FROM q),
g AS (SELECT source, odds / (1 + odds) AS rank, coalesce(doc_id, -9223372036854775808) AS id, size, CAST(sum(size) AS BIGINT) AS words, any_value(rest) AS rest
      FROM z WHERE rest > 0 AND size > 0 GROUP BY ALL),
o2 AS (SELECT source, any_value(rest) AS rest, list([words] ORDER BY rank, id, size) AS words FROM g GROUP BY source),
-- the words still missing before each document of the order and after the last: what fits is taken
gaps AS (SELECT source, rest, list_reduce(words, lambda a, w: list_append(a, CASE WHEN w[1] <= a[-1] THEN a[-1] - w[1] ELSE a[-1] END), [CAST(floor(rest) AS BIGINT)]) AS left_over FROM o2),
w AS (SELECT g.*, gaps.left_over[row_number() OVER (PARTITION BY g.source ORDER BY g.rank, g.id, g.size)] >= g.words AS fits, gaps.left_over[-1] + gaps.rest - floor(gaps.rest) AS gap
      FROM g JOIN gaps ON g.source IS NOT DISTINCT FROM gaps.source),
x AS (SELECT source, min(row(abs(gap - size), rank, id, size)) AS c FROM w WHERE NOT fits AND gap > 0 AND abs(gap - size) < gap GROUP BY source),
k AS (SELECT z.*, CAST(z.whole + CASE WHEN coalesce(w.fits, false) OR coalesce(row(x.c[2], x.c[3], x.c[4]) = row(w.rank, w.id, w.size), false) THEN 1 ELSE 0 END AS BIGINT) AS copies
      FROM z LEFT JOIN w ON z.source IS NOT DISTINCT FROM w.source AND coalesce(z.doc_id, -9223372036854775808) = w.id AND z.size = w.size AND z.rest > 0
      LEFT JOIN x ON z.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, copies FROM k
"""

OP11_LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT r, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
f AS (SELECT key, min(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.r, k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.low AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""

OP12_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""
