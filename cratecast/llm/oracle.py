"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE: dict[str, str] = {}

ORACLE["op4_source_mixing"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size, length(text) AS n FROM documents),
q AS (SELECT *, n / greatest(size, 1)::DOUBLE AS mean FROM d),
k AS (
  SELECT doc_id, source, size, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':0'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
    / coalesce(CASE WHEN size = 0 THEN 0.5::DOUBLE WHEN mean < 3 THEN 0.5::DOUBLE + mean / 6 WHEN mean > 9 THEN 0.5::DOUBLE + 4.5::DOUBLE / mean ELSE 1::DOUBLE END, 0.5::DOUBLE) AS key
  FROM q),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3] AS w, 3.0::DOUBLE * source_size AS cap FROM s),
-- share what is left by weight among the sources that are not full, until none is above its cap
r AS (
  SELECT 0 AS i, source, source_size, w, cap, false AS is_full FROM w
  UNION ALL
  SELECT i + 1, source, source_size, w, cap, is_full OR w * ((sum(source_size) OVER () - coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0)) / sum(w) FILTER (WHERE NOT is_full) OVER ()) >= cap
  FROM r WHERE i <= (SELECT count(*) FROM w)),
e AS (SELECT * FROM r WHERE i = (SELECT max(i) FROM r)),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * ((sum(source_size) OVER () - coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0)) / sum(w) FILTER (WHERE NOT is_full) OVER ()) END AS target FROM e),
p AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size AND (target > epochs * source_size OR epochs = 0) THEN 1 ELSE 0 END AS INT) AS copies,
  CAST((epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size AND (target > epochs * source_size OR epochs = 0) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p
"""

ORACLE["op8_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS i, x[i] AS line, CAST('0x' || substr(md5(x[i]), 1, 8) AS BIGINT) AS h, CASE WHEN i > 1 THEN CAST('0x' || substr(md5(x[i - 1]), 1, 8) AS BIGINT) ELSE 0 END AS e, len(x) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL) t, range(1, len(x) + 1) r(i)),
p AS (SELECT *, (31 * e + h) % 4294967291 AS roll FROM l),
q AS (SELECT *, coalesce(roll < lag(roll) OVER (PARTITION BY doc_id ORDER BY i), false) AS falls FROM p),
b AS (SELECT *, falls AND NOT coalesce(lag(falls) OVER (PARTITION BY doc_id ORDER BY i), false) AND i <> n - 2 AS ends FROM q),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ch FROM b),
g AS (SELECT doc_id, ch, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n_lines FROM c GROUP BY doc_id, ch),
f AS (SELECT *, row_number() OVER (PARTITION BY chunk, n_lines ORDER BY doc_id, ch) > 1 AND n_lines > 1 AS gone FROM g),
o AS (SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY ch) FILTER (WHERE NOT gone), '') AS text, CAST(count(*) AS INT) AS n_chunks, CAST(count(*) FILTER (WHERE gone) AS INT) AS n_removed FROM f GROUP BY doc_id)
SELECT d.doc_id, o.text, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(length(o.text), 0) AS BIGINT) AS n_chars FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id
"""

ORACLE["op10_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLE["op2_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a, u b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
c AS (SELECT vec_id, vec_id AS comp FROM v UNION SELECT l.b, c.comp FROM c JOIN l ON c.vec_id = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
m AS (SELECT vec_id, min(comp) AS comp FROM c GROUP BY vec_id)
SELECT m.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, comp AS component_id, m.vec_id = comp AS kept FROM m LEFT JOIN n ON n.a = m.vec_id
"""

ORACLE["op12_url_filter"] = r"""
WITH r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
b AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM b
"""

ORACLE["op13_ranked_search"] = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
m AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM d, s),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
x AS (
  SELECT item_id, t.doc_id, CAST(sum(f.w * ((1000000000 * tf) // (1000 * tf + 12 * m.m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN f USING (term) JOIN m ON m.doc_id = t.doc_id GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every round of the codebooks spelled out."""
    near = """SELECT i, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT x.i, x.p, c.e, CAST(list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) AS d FROM x JOIN {} c ON c.p = x.p) GROUP BY i, p"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS ({near.format(f'c{r}')})")
        steps.append(f"s{r} AS (SELECT p, e, j, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (SELECT a.p, a.e, unnest(range(len(x.x))) AS j, unnest(x.x) AS v FROM a{r} a JOIN x ON x.i = a.i AND x.p = a.p) GROUP BY ALL)")
        steps.append(f"m{r} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS x FROM s{r} GROUP BY p, e)")
        steps.append(f"c{r + 1} AS (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.p = c.p AND m.e = c.e)")
    return f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS i, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT i, p, q[p * (len(q) // {parts}) + 1 : (p + 1) * (len(q) // {parts})] AS x FROM v, range({parts}) r(p)),
c0 AS (SELECT p, i AS e, x FROM x WHERE i < {entries}),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
z AS ({near.format(f"c{rounds}")}),
o AS (SELECT i, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY i),
h AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM (SELECT p, e, unnest(range(len(x))) AS j, unnest(x) AS v FROM c{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN v USING (i), h
"""


ORACLE["op11_vector_codes"] = _vector_codes()
