"""Plain SQL of the training-data queries that SQL can express."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

# Line rules: the counts of a line, then the first rule it fails (see quality_rules.py).
OP1 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, {WORDS.format('text')} AS w FROM docs),
windows AS (SELECT r, i, w[i:i + 4] AS g FROM words, unnest(range(1, len(w) - 3)) AS u(i)),
repeated AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
marked AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM repeated, unnest(range(0, 5)) AS u(k) GROUP BY r),
lines AS (
  SELECT r, i, ls[i] AS line FROM (SELECT r, string_split(text, chr(10)) AS ls FROM docs), unnest(range(1, len(ls) + 1)) AS u(i)
),
counted AS (
  SELECT r, i, line, len({WORDS.format('line')}) AS n,
    length(line) - length(translate(line, '#*$%&|<>', '')) AS sym,
    (length(line) - length(replace(line, '!!', ''))) // 2 AS bangs,
    len(list_filter({WORDS.format('line')}, lambda x: x IN ('|', '•', '·', '»', '>', '/', '->', '::'))) AS seps,
    len(list_filter({WORDS.format('line')}, lambda x: regexp_matches(x, '[.!?…]["''”»)\]]*$'))) AS ends,
    regexp_matches(line, '[.!?…]["''”»)\]]*[\x20\x09-\x0D]*$') AS ended,
    regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      'accept cookies|all rights reserved|back to top|click here|cookie policy|enable javascript|log in|lorem ipsum|powered by|privacy policy|read more|share this|sign up|skip to content|subscribe to|terms of service|terms of use|uses cookies') AS furniture
  FROM lines
),
ruled AS (
  SELECT r, i, line, n, CASE
    WHEN n = 0 THEN NULL
    WHEN 3 * sym > n AND NOT contains(line, '|') THEN 'symbols'
    WHEN n >= 3 AND 5 * bangs > n THEN 'shouting'
    WHEN (contains(line, '|') OR n <= 60) AND seps >= 2 AND 5 * seps >= n THEN 'navigation'
    WHEN 3 * sym > n THEN 'symbols'
    WHEN n <= 30 AND furniture THEN 'boilerplate'
    WHEN ended OR (50 * ends >= n AND n > 5) THEN NULL
    ELSE 'punctuation' END AS rule,
    CASE WHEN n > 0 AND row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 THEN 1 ELSE 0 END AS dup
  FROM counted
),
summed AS (
  SELECT r, sum(dup)::BIGINT AS n_dup_lines, sum(CASE WHEN rule IS NULL THEN 0 ELSE n END)::BIGINT AS lost_words,
    sum(CASE WHEN rule = 'symbols' THEN n ELSE 0 END)::BIGINT AS lost_symbols,
    sum(CASE WHEN rule = 'shouting' THEN n ELSE 0 END)::BIGINT AS lost_shouting,
    sum(CASE WHEN rule = 'navigation' THEN n ELSE 0 END)::BIGINT AS lost_navigation,
    sum(CASE WHEN rule = 'boilerplate' THEN n ELSE 0 END)::BIGINT AS lost_boilerplate,
    sum(CASE WHEN rule = 'punctuation' THEN n ELSE 0 END)::BIGINT AS lost_punctuation
  FROM ruled GROUP BY r
),
base AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(d.text) - length(translate(d.text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(m.n_repeat_words, 0)::BIGINT AS n_repeat_words, s.*
  FROM docs d JOIN words w USING (r) JOIN summed s USING (r) LEFT JOIN marked m USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost_words <= n_words AS kept,
  lost_words, lost_symbols, lost_shouting, lost_navigation, lost_boilerplate, lost_punctuation
FROM base
"""

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""

OP6 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS s, coalesce(len({WORDS.format('text')}), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'null')) AS digest
  FROM documents
),
sources AS (
  SELECT s, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY s) - 1) % 3 AS n FROM docs GROUP BY s
),
weighed AS (
  SELECT *, n + 1 AS weight, [1.0, 1.5, 0.5][n + 1]::DOUBLE AS early, [1.0, 0.5, 1.5][n + 1]::DOUBLE AS late,
    source_size::DOUBLE / (n + 1) AS per_weight FROM sources
),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed WINDOW before AS (ORDER BY per_weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT s, source_size, early, late, CASE WHEN level * weight >= 3 * source_size THEN (3 * source_size)::DOUBLE
    ELSE (SELECT level FROM levels WHERE level * weight < 3 * source_size ORDER BY per_weight, s LIMIT 1) * weight END AS target
  FROM levels
),
placed AS (
  SELECT d.*, source_size, early, late, target,
    coalesce(sum(size) OVER (PARTITION BY s ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS passes
  FROM docs d JOIN targets USING (s)
),
remaining AS (SELECT *, CASE WHEN passes < 3 THEN floor(target - passes * source_size)::BIGINT ELSE 0 END AS rest FROM placed),
opened AS (SELECT *, size > 0 AND size <= rest AS open FROM remaining),
-- Documents that the last pass can hold are taken in order while they fit.
fitted AS (
  SELECT *, sum(CASE WHEN open THEN size ELSE 0 END) OVER (PARTITION BY s ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS open_end
  FROM opened
),
-- Then the largest sizes first, as many of each as fit: a step per distinct size of what was left out.
sums AS (SELECT s, max(rest) - coalesce(sum(size) FILTER (open AND open_end <= rest), 0)::BIGINT AS room, coalesce(sum(size) FILTER (open AND open_end <= rest), 0)::BIGINT AS used FROM fitted GROUP BY s),
sizes AS (
  SELECT f.s, size, count(*) AS docs, row_number() OVER (PARTITION BY f.s ORDER BY size DESC) AS n
  FROM fitted f JOIN sums USING (s) WHERE open AND open_end > rest AND size <= room GROUP BY f.s, size
),
steps(s, n, size, wanted, place, left_over) AS (
  SELECT s, 0::BIGINT, 0::BIGINT, 0::BIGINT, used, room FROM sums
  UNION ALL
  SELECT t.s, z.n, z.size, least(z.docs, t.left_over // z.size), t.place + t.wanted * t.size, t.left_over - least(z.docs, t.left_over // z.size) * z.size
  FROM steps t JOIN sizes z ON z.s = t.s AND z.n = t.n + 1
),
ranked AS (
  SELECT f.s, f.digest, f.start, f.size, t.wanted, t.place, row_number() OVER (PARTITION BY f.s, f.size ORDER BY f.start) - 1 AS rank
  FROM fitted f JOIN steps t ON f.s = t.s AND f.size = t.size WHERE open AND open_end > rest AND t.n > 0
),
copied AS (
  SELECT f.*, CASE WHEN f.size > 0 THEN passes + ((open AND open_end <= rest) OR r.s IS NOT NULL)::BIGINT ELSE 0 END AS copies,
    CASE WHEN passes > 0 THEN f.start WHEN open AND open_end <= rest THEN open_end - f.size WHEN r.s IS NOT NULL THEN r.place + r.rank * r.size ELSE f.start END AS demand
  FROM fitted f LEFT JOIN (SELECT * FROM ranked WHERE rank < wanted) r ON f.s = r.s AND f.digest = r.digest AND f.start = r.start AND f.size = r.size
),
shares AS (SELECT *, least(demand / target, 1.0) AS share, (early + late) / 2 AS area FROM copied)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
  CASE WHEN copies > 0 THEN 2 * area * share / (early + sqrt(greatest(early * early + 2 * (late - early) * area * share, 0))) END AS first_position
FROM shares
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
typed AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT // [32768, 1024, 32, 1][i % 4 + 1] % 32 + 1)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM typed
"""


OP12 = """
WITH RECURSIVE r AS (SELECT row_number() OVER () AS i, vec_id, label::VARCHAR AS label, embedding::DOUBLE[] AS v FROM embeddings),
valid AS (
  SELECT * FROM r WHERE label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
scaled AS (SELECT i, vec_id, label, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) AS v FROM valid),
unit AS (SELECT i, vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM scaled),
links AS (
  SELECT a.i AS a, b.i AS b FROM unit a JOIN unit b ON a.label = b.label AND a.i <> b.i
  WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))) / (a.n * b.n) >= 0.98
),
reach(a, b) AS (SELECT i, i FROM r UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT reach.a AS i, min(r.vec_id) AS component_id FROM reach JOIN r ON r.i = reach.b GROUP BY reach.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = r.i)::BIGINT AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM r JOIN lowest USING (i)
"""

OP13 = """
WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.i AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor, anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, rank, other AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, s.other, s.score, row_number() OVER (PARTITION BY p.anchor, positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank
  FROM positive p JOIN scored s USING (anchor)
  WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
) AS p WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": OP1, "op3_topk": OP3, "op6_mixing": OP6, "op9_warc": OP9, "op12_vector_dedup": OP12, "op13_hard_negatives": OP13,
    }
