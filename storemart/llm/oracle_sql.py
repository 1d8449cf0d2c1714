"""DuckDB statements of the corpus queries that SQL can express."""

from . import centroid_native, chat_pairs, fim_arrow, pstable_cosine

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0) x),
gram AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
         FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM win) s WHERE len(w) >= k) x),
hit AS (SELECT r, p, gram.k, item_id FROM gram JOIN win ON gram.g = win.g AND gram.k = win.k),
cover AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hit) x GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover ON d.r = cover.r LEFT JOIN item ON d.r = item.r
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p:p + least(4, len(w)) - 1], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0) x),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pair AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
link AS (SELECT x, y FROM pair JOIN n u ON u.r = x JOIN n v ON v.r = y WHERE 100 * c >= 80 * (u.n + v.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT r, r AS other FROM d UNION SELECT reach.r, edge.y FROM reach JOIN edge ON edge.x = reach.other),
least_id AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.other GROUP BY reach.r)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN n ON n.r = d.r JOIN least_id ON least_id.r = d.r
"""

SQL = {"op3_chat_formatting": chat_pairs.SQL, "op9_benchmark_decontamination": DECONTAMINATION, "op10_minhash_near_dedup": NEAR_DUPLICATES,
       "op11_embedding_near_dedup": pstable_cosine.SQL, "op12_fim_transformation": fim_arrow.SQL,
       "op13_centroid_clustering": centroid_native.duckdb_sql()}
