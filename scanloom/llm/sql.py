"""The results of some queries in SQL, as another engine finds them by plain means.

Taggers, tokenizers, page parsers and media formats have no SQL; their queries
are tested against brute force, round trips or held-out rows.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text,''),'[^\x20\x09-\x0D]+')"

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+2],' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w)-2, least(len(w),1))+1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g=b.g AND a.doc_id<>b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id=a JOIN n y ON y.doc_id=b WHERE 100*c>=90*(x.n+y.n-c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a=r.b)
SELECT d.doc_id, coalesce(n.n,0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) c USING (doc_id)"""

EMBEDDING_SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64*x::double)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)))=0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v,c.v)::bigint AS score FROM v q JOIN v c ON q.vec_id<>c.vec_id WHERE q.vec_id%20=0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s) WHERE rank<=20"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i+12],' ') AS g FROM (SELECT doc_id, w, unnest(range(1,len(w)-11)) AS i FROM d)),
o AS (SELECT g, min(doc_id) AS first FROM x GROUP BY 1),
h AS (SELECT DISTINCT doc_id, i+k AS i FROM (SELECT doc_id, i FROM x JOIN o USING (g) WHERE doc_id>first), (SELECT unnest(range(13)) AS k)),
e AS (SELECT doc_id, i, w[i] AS t FROM (SELECT doc_id, w, unnest(range(1,len(w)+1)) AS i FROM d)),
k AS (SELECT e.doc_id, string_agg(t,' ' ORDER BY i) AS t, count(*) AS n FROM e ANTI JOIN h USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(w)::bigint AS n_words, len(w)-coalesce(k.n,0)::bigint AS n_removed, sha256(coalesce(k.t,'')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""


def mixing(fills: int, seed: int = 7) -> str:
    rounds = ""
    for k in range(fills + 1):
        fits = "open" if k == 0 else "open AND NOT drawn AND size<=lack"
        lack = "greatest(lack,0)" if k == 0 else "lack"
        rounds += f""",
l{k} AS (SELECT * REPLACE ({lack} AS lack) FROM (SELECT *, target-sum(size*(whole+drawn::int)) OVER (PARTITION BY source) AS lack FROM r{k})),
h{k} AS (SELECT r, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size, r ROWS UNBOUNDED PRECEDING)<=lack AS more FROM l{k} WHERE {fits}),
r{k + 1} AS (SELECT l.* EXCLUDE (lack, drawn), drawn OR coalesce(more,false) AS drawn FROM l{k} l LEFT JOIN h{k} USING (r))"""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len({WORDS})::bigint AS size, coalesce(doc_id::varchar, 'text:'||md5(coalesce(text,''))) AS draws_by FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY 1),
t AS (SELECT *, ([5.0,2.0,1.0]::double[])[(row_number() OVER (ORDER BY source NULLS LAST)-1)%3+1] AS w, source_size*3.0::double AS most FROM s),
v AS (SELECT *, (sum(source_size) OVER ()-coalesce(sum(most) OVER (ORDER BY most/w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0))/
 sum(w) OVER (ORDER BY most/w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM t),
c AS (SELECT min({{'a': most/w, 'b': level}}) FILTER (most>=level*w) AS c FROM v),
g AS (SELECT source, source_size, least(most, c.c.b*w) AS target FROM v, c),
b AS (SELECT d.*, source_size, target, CASE WHEN source_size>0 THEN least(3.0::double, target/source_size) ELSE 0 END AS due,
 (('0x'||substr(md5('{seed}:'||draws_by),1,13))::bigint::double+0.5)/4503599627370496::double AS u FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, floor(due+1e-12)::bigint AS whole, greatest(due-floor(due+1e-12),0) AS f FROM b),
r0 AS (SELECT * EXCLUDE (o), CASE WHEN open THEN o/(1+o) ELSE 1 END AS q, false AS drawn FROM (SELECT *, f>1e-12 AND size>0 AS open, (u/(1-u))/(f/(1-f)) AS o FROM f)){rounds}
SELECT doc_id, size, source_size, target, (size*least(whole+drawn::int,3))::bigint AS taken, least(whole+drawn::int,3)::bigint AS copies FROM r{fills + 1}"""

LEXICAL_SEARCH = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
 s AS (SELECT count(*) FILTER (len(ts) > 0) AS n, coalesce(sum(len(ts)), 0)::BIGINT AS l FROM d),
 p AS (SELECT r, any_value(doc_id) AS doc_id, t, count(*) AS tf, any_value(len(ts)) AS size FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY r, t),
 w AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * n + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY t, n),
 q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL),
 g AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * size * n) // l)))))::BIGINT AS score FROM q JOIN p USING (t) JOIN w USING (t), s GROUP BY item_id, r)
SELECT * FROM (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM g WHERE score > 0) WHERE rank <= 50
"""
