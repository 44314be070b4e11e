"""SQL counterparts (DuckDB) of the queries that SQL can express.

The others hold a trained model, draws by hash or a tokenizer; the tests compare them with plain Python.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Smallest node reachable over ``links`` (a, b), for ``nodes`` (id).
_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT id AS node, id AS root FROM nodes
  UNION
  SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.node),
components AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)"""

ORACLE: dict[str, str] = {
    "op3_decontaminate": rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
    SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM item_words WHERE len(w) > 0 AND item_id IS NOT NULL)),
doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
doc_windows AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM doc_words, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
hits AS (SELECT d.doc_id, d.i, d.m, t.item_id FROM doc_windows d JOIN item_windows t USING (m, k)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)""",
    "op6_near_dup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components ON node = d.doc_id LEFT JOIN sizes USING (doc_id)""",
    "op7_embedding_dedup": f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM vectors
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) >= 0.95 * x.size * y.size),
nodes AS (SELECT vec_id AS id FROM vectors),{_REACH}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN components ON node = vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM both_ways GROUP BY 1) ON a = vec_id""",
    "op8_warc": """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS f FROM payloads WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f IS NULL OR f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> page_id THEN f END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)""",
}
