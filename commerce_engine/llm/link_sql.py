"""DuckDB SQL of the two operators on pairs: all pairs compared exactly, components by recursion. For small tables."""

from __future__ import annotations

#: (id, component_id) from a table links(a, b) with both directions.
REACH = """reach AS (
  SELECT a AS id, a AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r),
component AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

VECTORS_SQL = f"""
WITH RECURSIVE
v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS MATERIALIZED (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE list_inner_product(e, e) > 0),
links AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q ON p.vec_id <> q.vec_id
  WHERE list_inner_product(p.e, q.e) / (p.norm * q.norm) >= 0.9),
{REACH},
degree AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN degree ON degree.id = vec_id LEFT JOIN component ON component.id = vec_id
"""

DOCUMENTS_SQL = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
  ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM w),
sizes AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM s),
one AS MATERIALIZED (SELECT s.doc_id, hash(x.shingle) AS shingle FROM s, unnest(shingles) x(shingle)),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM one p JOIN one q ON p.shingle = q.shingle AND p.doc_id < q.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{REACH}
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM sizes LEFT JOIN component ON component.id = doc_id
"""
