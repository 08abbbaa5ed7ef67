"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per_source AS (
  SELECT source, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS pos
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [1, 2, 3][pos % 3 + 1]::HUGEINT AS w, 3 * source_size AS cap,
         3 * source_size * 6 // [1, 2, 3][pos % 3 + 1] AS ratio FROM per_source),
levels AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS w_rest
  FROM weighed WINDOW earlier AS (ORDER BY ratio, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first AS (
  SELECT ratio, pos, rest, w_rest FROM levels WHERE NOT cap * w_rest < rest * w ORDER BY ratio, pos LIMIT 1),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN (l.ratio, l.pos) >= (f.ratio, f.pos) THEN f.rest::DOUBLE * l.w::DOUBLE / f.w_rest::DOUBLE
              ELSE l.cap::DOUBLE END AS target
  FROM levels l CROSS JOIN first f),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0 AS coin
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       ((floor(rate)::BIGINT + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""

TOP_PRODUCTS = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

WARC = """
WITH paid AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
told AS (
  SELECT *, row_number() OVER same AS nth, first_value(page_id) OVER same AS first_id FROM paid
  WINDOW same AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN first_id END AS refers_to
FROM told
"""

PHRASES = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM texts),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
words AS (SELECT lang, id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
runs AS (SELECT lang, w, lead(w) OVER next AS w2, lead(w, 2) OVER next AS w3 FROM words WINDOW next AS (PARTITION BY id ORDER BY pos)),
grams AS (
  SELECT lang, 1 AS k, w AS phrase FROM runs
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, k AS m, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
parted AS (
  SELECT lang, m, phrase, a, 1 AS k, ws[1] AS head, array_to_string(ws[2:], ' ') AS tail FROM cand
  UNION ALL SELECT lang, m, phrase, a, 2, array_to_string(ws[1:2], ' '), ws[3] FROM cand WHERE m = 3),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.c AS l, y.c AS r, (1000000::HUGEINT * c.a * c.a) // (x.c::HUGEINT * y.c) AS score
  FROM parted c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cuts) WHERE nth = 1),
inside AS (
  SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM cand WHERE m = 3
  UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM cand WHERE m = 3),
absorbed AS (SELECT lang, phrase, max(a) AS around FROM inside GROUP BY ALL),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, encode(w.phrase)) AS rank,
         w.phrase, w.a, w.l, w.r, w.score
  FROM lowest w LEFT JOIN absorbed i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE NOT coalesce(100 * i.around >= 50 * w.a, false))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
