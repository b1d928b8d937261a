"""DuckDB SQL of the corpus queries that SQL can express over whole tables."""

_WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS d FROM pages
), r AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY d) AS last,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((CAST('0x' || substr(d, CAST((i // 8) * 10 + 1 AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31)::INT + 1, 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM r
"""

_NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(CASE WHEN len(ws) < 2 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id
"""

_LEAKS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(ws), 10) AS width, array_to_string(ws[i:i + 9], ' ') AS g
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b WHERE len(ws) > 0)
), grams AS (
  SELECT doc_id, i, l.width, array_to_string(ws[i:i + l.width - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) t, (SELECT DISTINCT width FROM windows) l
  WHERE i + l.width - 1 <= len(ws)
), found AS (
  SELECT grams.doc_id, grams.i, grams.width, windows.item FROM grams JOIN windows ON windows.width = grams.width AND windows.g = grams.g
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id
), passages AS (
  SELECT DISTINCT item, a, least(len(ws), 10) AS width, ws[a:a + least(len(ws), 10) - 1] AS p
  FROM (SELECT item, ws, unnest(list_concat(range(1, greatest(len(ws) - 9, 1) + 1, 10), [greatest(len(ws) - 9, 1)])) AS a FROM b WHERE len(ws) > 0)
), needs AS (
  SELECT item, a, width, len(list_distinct(p)) AS k, t, count(*) AS need FROM (SELECT *, unnest(p) AS t FROM passages) GROUP BY ALL
), words AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS t FROM d
), able AS (
  SELECT doc_id, item, a FROM (SELECT DISTINCT doc_id, t FROM words) JOIN needs USING (t) GROUP BY doc_id, item, a, k HAVING count(*) = k
), places AS (
  SELECT doc_id, item, a, width, k, need, t, i FROM able JOIN needs USING (item, a) JOIN words USING (doc_id, t)
), full_terms AS (
  SELECT x.doc_id, x.item, x.a, x.i, x.k FROM places x JOIN places y ON y.doc_id = x.doc_id AND y.item = x.item AND y.a = x.a AND y.i BETWEEN x.i AND x.i + x.width + 1
  GROUP BY x.doc_id, x.item, x.a, x.i, x.k, y.t, y.need HAVING count(*) >= y.need
), near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near FROM (SELECT doc_id, item FROM full_terms GROUP BY doc_id, item, a, i, k HAVING count(*) = k) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""

SQL = {"op4_warc": _WARC, "op7_near_dedup": _NEAR, "op8_decontamination": _LEAKS}
