"""SQL for the operators that SQL can express, for the small sample tables."""

WORDS = r"[^\x20\x09-\x0D]+"

NEAR_DUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM sets
  UNION SELECT l.y, reach.r FROM reach JOIN both_ways l ON l.x = reach.v)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept
FROM sets s JOIN reach ON reach.v = s.doc_id GROUP BY s.doc_id, s.s
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size,
         sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON f.digest = p.digest AND p.size >= 100
"""
