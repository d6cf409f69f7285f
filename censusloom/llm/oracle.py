"""SQL counterparts of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS ws FROM documents),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k FROM w, unnest(range(1, len(ws) - 33)) AS t(i)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM rep, range(0, 35) AS r(j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM benchmark),
item AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS k
  FROM b, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS t(i) WHERE len(ws) > 0
),
win AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM item), unnest(range(1, len(ws) - n + 2)) AS t(i)
),
hit AS (SELECT doc_id, i, win.n, item_id FROM win JOIN item ON win.n = item.n AND win.k = item.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(named, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS k
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s AS x JOIN s AS y USING (k) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.n + q.n - shared)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) AS r USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": OP2, "op4_decontamination": OP4, "op10_jaccard_join": OP10}
