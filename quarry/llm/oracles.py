"""DuckDB SQL of operators that work by hashing, sampling or sorting: the plain, quadratic computation of the same rows."""

from __future__ import annotations

#: Every 200-byte window of every text, as its md5; bytes are handled as pairs of hexadecimal digits.
REPEATS = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
sized AS (SELECT doc_id, x, length(x) // 2 AS n FROM d),
win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h
        FROM (SELECT *, unnest(range(n - 199)) AS i FROM sized WHERE n >= 200)),
met AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
fresh AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS f FROM met),
numbered AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM fresh),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM numbered GROUP BY doc_id, run),
edges AS (SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, n, n FROM sized),
gaps AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS a, s AS b FROM edges),
kept AS (SELECT g.doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k
         FROM gaps g JOIN sized USING (doc_id) GROUP BY g.doc_id),
total AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT s.doc_id, s.n AS n_bytes, coalesce(t.removed, 0)::BIGINT AS n_removed, coalesce(t.n_spans, 0) AS n_spans,
       sha256(unhex(k.k)) AS kept_sha256
FROM sized s JOIN kept k USING (doc_id) LEFT JOIN total t USING (doc_id)
"""

_REACH = """
edges_both AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS id, b AS other FROM edges_both UNION SELECT r.id, p.b FROM reach r JOIN edges_both p ON p.a = r.other),
tops AS (SELECT id, least(min(other), id) AS top FROM reach GROUP BY id),
links AS (SELECT a AS id, count(*) AS n FROM edges_both GROUP BY a)
"""

#: Sets of five-word shingles, every pair of documents that shares one.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_\x{80}-\x{10FFFF}]+') AS ws FROM documents WHERE text IS NOT NULL),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE c / (p.n + q.n - c) >= 0.8),
""" + _REACH + """
SELECT d.doc_id, coalesce(top, d.doc_id) AS class_id, coalesce(n, 0) AS n_links, coalesce(top, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN tops ON tops.id = d.doc_id LEFT JOIN links ON links.id = d.doc_id
"""

#: Cosine of every pair of vectors.
VECTOR_LINKS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v
         WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
          WHERE list_dot_product(x.e, y.e) / (x.l * y.l) >= 0.95),
""" + _REACH + """
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(top, vec_id) AS component_id, coalesce(top, vec_id) = vec_id AS kept
FROM v LEFT JOIN tops ON tops.id = vec_id LEFT JOIN links ON links.id = vec_id
"""
