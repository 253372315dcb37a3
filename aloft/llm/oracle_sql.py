"""DuckDB statements for the corpus queries that SQL can express.

Language ID (a learned model) and token counts (a tokenizer's vocabulary) are not
expressible; tests compare them with held-out labels and with the library.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: (x IS NULL OR NOT isfinite(x))::INT), 'sum') = 0
    AND list_aggregate(list_transform(embedding, lambda x: x * x), 'sum') > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(id, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(c) AS component_id FROM r GROUP BY id),
n AS (SELECT a AS id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON e.vec_id = c.id LEFT JOIN n ON e.vec_id = n.id
"""

_BENCH_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH i AS (SELECT item_id, {_BENCH_WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
iw AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS t
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM iw)),
d AS (SELECT doc_id, {_BENCH_WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS t
       FROM (SELECT d.*, l.n, unnest(range(1, len(w) - l.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) l)),
hit AS (SELECT dw.doc_id, dw.n, dw.p, win.item_id FROM dw JOIN win ON dw.n = win.n AND dw.t = win.t),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(cov.n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(it.ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(it.ids, ','), '')) AS items_sha256,
       coalesce(cov.n_hit, 0) > 0 AND 20 * coalesce(cov.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP3 = f"""
WITH d AS (SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")})::BIGINT AS size,
                  left(md5(concat_ws('|', '42', doc_id::VARCHAR, text)), 16) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
o AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
             row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source) AS k,
             coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / w, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
             (sum(source_size) OVER ())::DOUBLE AS total FROM s),
lv AS (SELECT arg_min((total - fixed) / free, k) AS level FROM o WHERE (total - fixed) / free * w <= cap),
t AS (SELECT source, source_size, CASE WHEN level * w > 3.0::DOUBLE * source_size THEN 3.0::DOUBLE * source_size
                                       ELSE level * w END AS target FROM s, lv),
b AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken FROM e
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
f AS (SELECT t, min(doc_id) AS first FROM win GROUP BY t),
cov AS (SELECT DISTINCT doc_id, q FROM (SELECT win.doc_id, unnest(range(p, p + 50)) AS q
        FROM win JOIN f USING (t) WHERE f.first < win.doc_id)),
gone AS (SELECT doc_id, list(q) AS qs FROM cov GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.q) AS t
         FROM words LEFT JOIN cov ON cov.doc_id = words.doc_id AND cov.q = words.q
         WHERE cov.q IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(gone.qs), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
           FROM documents),
win AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS t
        FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS p FROM d WHERE n >= 200)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY t) AS c FROM win) WHERE c > 1),
isl AS (SELECT doc_id, min(p) AS s, max(p) + 200 AS e FROM (
          SELECT doc_id, p, sum(brk) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (
            SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS brk
            FROM rep)) GROUP BY doc_id, g),
seg AS (SELECT doc_id, s, e, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS nxt,
               row_number() OVER (PARTITION BY doc_id ORDER BY s) AS k FROM isl),
kept AS (SELECT d.doc_id, max(CASE WHEN k = 1 THEN substr(h, 1, 2 * s) END)
           || string_agg(substr(h, 2 * e + 1, 2 * (coalesce(nxt, n) - e)), '' ORDER BY s) AS h,
           sum(e - s) AS gone, count(*) AS spans
         FROM d JOIN seg USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(kept.gone, 0)::BIGINT AS n_removed,
       coalesce(kept.spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS t
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id <> b.doc_id
       GROUP BY ALL),
l AS (SELECT pr.a, pr.b FROM pr JOIN n x ON x.doc_id = pr.a JOIN n y ON y.doc_id = pr.b
      WHERE 100 * pr.c >= 75 * (x.n + y.n - pr.c)),
r(id, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.id = d.doc_id
"""

OP9 = f"""
WITH u AS (SELECT page_id, coalesce({LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1), '') AS path,
                  row_number() OVER () AS k FROM pages),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT u.k, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS verdict
      FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p) GROUP BY u.k)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (k)
"""

OP10 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents),
w AS (SELECT doc_id, x, line, len({WORDS.format("x")}) AS n FROM l),
s AS (SELECT doc_id, line, x, n, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS p FROM w WHERE n > 0),
pairs AS (SELECT a.doc_id, a.p, a.n, b.doc_id AS other, a.p - b.p AS d FROM s a JOIN s b
          ON a.x = b.x AND (b.doc_id, b.p) < (a.doc_id, a.p)),
island AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, other, d ORDER BY p) AS g FROM pairs),
run AS (SELECT doc_id, min(p) AS first, max(p) AS last FROM island GROUP BY doc_id, other, d, g HAVING sum(n) >= 20),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS q FROM run),
left_ AS (SELECT w.doc_id, string_agg(w.x, chr(10) ORDER BY w.line) AS t, count(s.p) AS n FROM w
          LEFT JOIN s ON s.doc_id = w.doc_id AND s.line = w.line
          LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.q = s.p WHERE gone.q IS NULL GROUP BY w.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_lines, (coalesce(n.n, 0) - coalesce(left_.n, 0))::BIGINT AS n_deleted,
       sha256(coalesce(left_.t, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN left_ USING (doc_id)
"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, sum(len(w))::BIGINT AS nt FROM d),
tf AS (SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(w) AS t FROM d) GROUP BY ALL),
wt AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t),
m AS (SELECT k, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * nd) // nt) AS m FROM d, s WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS i, item_id,
             list_distinct({_TERMS.format(LOWER.format("coalesce(text, '')"))}) AS w FROM benchmark),
it AS (SELECT i, item_id, unnest(w) AS t FROM i),
sc AS (SELECT it.i, it.item_id, m.doc_id, m.k,
              sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m)))::BIGINT AS score
       FROM it JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (k) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

OP12 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND coalesce(list_aggregate(list_transform(embedding, lambda x: (x IS NULL OR NOT isfinite(x))::INT), 'sum'), 0) = 0),
p AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
             coalesce(list_aggregate(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]), 'sum'), 0)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
pos AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k FROM p WHERE same),
n AS (SELECT pos.a, pos.b, pos.anchor_id, pos.vec_id AS positive_id, p.vec_id AS negative_id, pos.score AS positive_score,
             p.score AS negative_score, row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.score DESC, p.vec_id)::INT AS rank
      FROM pos JOIN p ON p.a = pos.a AND NOT p.same AND 80 * pos.score <= 100 * p.score AND 100 * p.score <= 100 * pos.score
      WHERE pos.k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLE_SQL = {
    "op1_embedding_near_dedup": OP1,
    "op2_decontamination": OP2,
    "op3_mixing": OP3,
    "op6_substring_dedup": OP6,
    "op7_suffix_array_dedup": OP7,
    "op8_minhash_near_dedup": OP8,
    "op9_url_filter": OP9,
    "op10_line_dedup": OP10,
    "op11_ranked_search": OP11,
    "op12_hard_negatives": OP12,
}
