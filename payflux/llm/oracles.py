"""DuckDB SQL for the corpus queries that SQL can express.

Not here: line dedup (SimHash), collision-counting search (approximate), packing
(tokenizer and best fit), toxicity (a fitted model) and token counts (greedy
matching); the tests hold those against brute force, held-out labels or round trips.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

MIX = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS skey,
         len({WORDS.format(text='text')})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         2 * source_size AS full_size, sum(source_size) OVER () AS total
  FROM s),
l AS (
  SELECT *, full_size / w AS ratio,
         3 * total - 2 * coalesce(sum(full_size) OVER (ORDER BY full_size / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lnum,
         2 * sum(w) OVER (ORDER BY full_size / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lden
  FROM w),
f AS (
  SELECT ratio, skey, lnum, lden FROM l WHERE lnum::HUGEINT * w <= lden::HUGEINT * full_size ORDER BY ratio, skey LIMIT 1),
t AS (
  SELECT l.skey, l.source_size,
         CASE WHEN l.ratio > f.ratio OR l.ratio = f.ratio AND l.skey >= f.skey
              THEN (f.lnum * l.w)::DOUBLE / f.lden::DOUBLE ELSE l.full_size::DOUBLE END AS target
  FROM l, f),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216 + 0.5)::BIGINT ELSE 0 END AS step,
         ('0x' || substr(md5('mix:' || skey), 1, 6))::BIGINT AS start
  FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY size, h, doc_id) AS p FROM d),
c AS (
  SELECT p.doc_id, p.size, r.source_size, r.target,
         ((p.p * r.step + r.start) >> 24) - (((p.p - 1) * r.step + r.start) >> 24) AS copies
  FROM p JOIN r USING (skey))
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""

# components: every id with the ids that it reaches
REACH = """
reach AS (
  SELECT a AS id, b AS other FROM both_ways
  UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
parts AS (SELECT id, least(min(other), id) AS component FROM reach GROUP BY id)
"""

EMBED = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
both_ways AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
{REACH},
n AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(p.component, e.vec_id) AS component_id,
       e.vec_id = coalesce(p.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.id = e.vec_id LEFT JOIN parts p ON p.id = e.vec_id
"""

ARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
         array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, (5 * (k // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31)::INT, 1)), '') AS payload_digest
  FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < best THEN best END AS refers_to
FROM m
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * i.i >= 80 * (x.n + y.n - i.i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{REACH}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(p.component, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN parts p ON p.id = d.doc_id
"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text='text')} AS w FROM documents),
s AS (
  SELECT doc_id, p, hash(array_to_string(w[p:p + 34], ' ')) AS g, md5(array_to_string(w[p:p + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM w WHERE len(w) >= 35)),
dup AS (SELECT doc_id, p FROM s WHERE (g, h) IN (SELECT (g, h) FROM s GROUP BY g, h HAVING count(*) > 1)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
y AS (
  SELECT x.doc_id, x.p, x.word,
         max(dup.p) OVER (PARTITION BY x.doc_id ORDER BY x.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM x LEFT JOIN dup ON dup.doc_id = x.doc_id AND dup.p = x.p),
k AS (
  SELECT doc_id, count(*)::BIGINT AS n, count(*) FILTER (gone)::BIGINT AS r,
         coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS t
  FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n, 0)::BIGINT AS n_words, coalesce(k.r, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)
"""

# CRC-32 bit by bit: every byte is followed by seven zeros, one step each
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(octet_length(encode({text}))),
  lambda i: [('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"""

# a letter of U+00C0 to U+00FF as one byte (33 to 96), for levenshtein(), which counts bytes
_WIDE = "".join(chr(0xC0 + i) for i in range(64))
_NARROW = "".join(chr(33 + i) for i in range(64)).replace("'", "''")

SPELLING = f"""
WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run
  FROM documents WHERE text IS NOT NULL),
d AS (SELECT id || ':' || run AS t, run, count(*) AS k FROM r GROUP BY ALL),
h AS (SELECT run, k, {CRC.format(text='t')} AS h FROM d),
w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n, translate(word, '{_WIDE}', '{_NARROW}') AS t FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
x AS (
  SELECT word, n, t, unnest(list_distinct(list_prepend(t, list_transform(range(1, length(t) + 1), lambda i: substr(t, 1, (i - 1)::INT) || substr(t, (i + 1)::INT))))) AS k
  FROM v),
p AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM x a JOIN x b ON a.k = b.k AND a.word <> b.word
  WHERE levenshtein(a.t, b.t) = 1),
q AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS rank, count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS (
  SELECT v.word, v.n, coalesce(q.n_near, 0)::BIGINT AS n_near, CASE WHEN q.m >= 10 * v.n THEN q.other END AS form,
         CASE WHEN q.m >= 10 * v.n THEN q.m END AS form_n
  FROM v LEFT JOIN q ON q.word = v.word AND q.rank = 1),
c AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN c ON c.word = f.word JOIN f e ON e.word = c.at AND e.form IS NULL
"""

RUNS = f"""
WITH o AS (SELECT doc_id, text, {CRC.format(text='doc_id::VARCHAR')} AS h FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, text, 1 FROM documents WHERE doc_id IS NULL),
l AS (SELECT row_number() OVER () AS id, doc_id, {WORDS.format(text='text')} AS w, h FROM o),
b AS (SELECT *, len(w) AS n, h // 10 AS g FROM l),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM b),
e AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
t AS (
  SELECT id, doc_id, n, CASE WHEN p IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
  FROM e),
x AS (SELECT id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
-- equal words q apart, and stretches of them
y AS (SELECT x.id, x.i, z.i - x.i AS q FROM x JOIN x z ON z.id = x.id AND z.word = x.word AND z.i > x.i AND 3 * (z.i - x.i) <= x.n),
s AS (
  SELECT id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM y)
  GROUP BY id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT id, start, length, min(q) AS period FROM s GROUP BY id, start, length),
k AS (
  SELECT id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed FROM r GROUP BY id),
m AS (
  SELECT id, start, length, period FROM (
    SELECT a.*, row_number() OVER (PARTITION BY id ORDER BY length::DOUBLE / period DESC, start, period) AS rank FROM r a) WHERE rank = 1),
gone AS (SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (
  SELECT x.id, string_agg(x.word, ' ' ORDER BY x.i) AS words FROM x LEFT JOIN gone g ON g.id = x.id AND g.i = x.i WHERE g.i IS NULL GROUP BY x.id)
SELECT t.doc_id, coalesce(k.n_runs, 0)::BIGINT AS n_runs, m.start::BIGINT AS start, m.length::BIGINT AS length, m.period::BIGINT AS period,
       (1000 * m.length // m.period)::BIGINT AS exponent_milli, sha256(coalesce(k.listed, '')) AS runs_sha256, sha256(coalesce(kept.words, '')) AS collapsed_sha256
FROM t LEFT JOIN k USING (id) LEFT JOIN m USING (id) LEFT JOIN kept USING (id)
"""

URLS = r"""
WITH rules(h, p, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
a AS (
  SELECT row_number() OVER () AS id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
f AS (
  SELECT a.id, arg_max(rules.h || rules.p, length(rules.h || rules.p)) AS rule, arg_max(verdict, length(rules.h || rules.p)) AS verdict
  FROM a JOIN rules ON (a.host = rules.h OR ends_with(a.host, '.' || rules.h)) AND starts_with(a.path, rules.p) GROUP BY a.id)
SELECT a.page_id, coalesce(a.host, '') AS host, coalesce(a.path, '') AS path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM a LEFT JOIN f USING (id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": MIX,
    "op2_e8_lattice": EMBED,
    "op4_arc_to_warc": ARC,
    "op6_heavy_light_jaccard": JACCARD,
    "op8_difference_cover": SUBSTRING,
    "op11_spelling_variants": SPELLING,
    "op12_periodic_runs": RUNS,
    "op13_url_rules": URLS,
}
