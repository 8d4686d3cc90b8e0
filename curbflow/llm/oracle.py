"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_url_filter"] = r"""
WITH split AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM split),
urls AS (
  SELECT page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM parts),
rules(r_host, r_path, r_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT page_id, host, path, max({'n': length(r_host) + length(r_path), 'rule': r_host || r_path, 'v': r_verdict}) AS best
  FROM urls JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY ALL)
SELECT u.page_id, u.host, u.path, f.best.rule AS rule, coalesce(f.best.v, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND u.host = f.host AND u.path = f.path
"""

ORACLE["op8_minhash_dedup"] = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
      WHEN len(w) = 0 THEN []::VARCHAR[]
      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM toks),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN comp ON node = doc_id
"""

ORACLE["op7_warc_archive"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS keeper
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM q
"""

ORACLE["op4_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON node = vec_id LEFT JOIN degree ON x = vec_id
"""
