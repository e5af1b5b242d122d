"""DuckDB SQL for the rows of those queries that SQL can express, by plain definitions: all windows, all
shared words, all shingles, all scores. None of it follows the operators' methods."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Every window of 400 bytes by its MD5; bytes are pairs of hexadecimal digits. Windows are taken from
#: stretches of 256 starts, as a place far inside a long string is slow to reach.
REPEATS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), b AS (
  SELECT doc_id, h, len(h) // 2 AS n FROM d
), w AS (
  SELECT doc_id, i, md5_number(substr(part, 2 * (i - c) + 1, 800)) AS k
  FROM (SELECT doc_id, part, c, unnest(range(c, least(c + 256, n - 399))) AS i
        FROM (SELECT doc_id, n, c, substr(h, 2 * c + 1, 1310) AS part
              FROM (SELECT doc_id, h, n, unnest(range(0, n - 399, 256)) AS c FROM b WHERE n >= 400)))
), again AS (
  SELECT k FROM w GROUP BY k HAVING count(*) > 1
), r AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w SEMI JOIN again USING (k)
), runs AS (
  SELECT doc_id, min(i) AS s, max(i) + 400 AS e
  FROM (SELECT *, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM r)
  GROUP BY doc_id, g
), cut AS (
  SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS after FROM runs
), kept AS (
  SELECT c.doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(h, 2 * after + 1, 2 * (s - after)), '' ORDER BY s) AS k
  FROM cut c JOIN b USING (doc_id) GROUP BY c.doc_id
)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE k || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""

#: Lines as sets of words; sets meet by every word they share.
LINES = f"""
WITH d AS (
  SELECT doc_id, string_split(text, chr(10)) AS p FROM documents
), l AS (
  SELECT doc_id, i AS line, p[i] AS line_text, list_sort(list_distinct(regexp_extract_all(p[i], {_WORD}))) AS w
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM d)
), sets AS (
  SELECT w, min((doc_id, line)) AS first, row_number() OVER (ORDER BY min((doc_id, line))) AS id FROM l WHERE len(w) > 0 GROUP BY w
), t AS (
  SELECT id, len(w) AS n, unnest(w) AS word FROM sets
), near AS (
  SELECT DISTINCT b FROM (
    SELECT x.id AS a, y.id AS b, count(*) AS shared, any_value(x.n) + any_value(y.n) AS total
    FROM t x JOIN t y ON x.word = y.word AND x.id < y.id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
    GROUP BY x.id, y.id
  ) WHERE 100 * shared >= 75 * (total - shared)
), judged AS (
  SELECT l.doc_id, l.line, l.line_text, coalesce((l.doc_id, l.line) <> s.first, false) AS equal,
         coalesce((l.doc_id, l.line) <> s.first OR s.id IN (SELECT b FROM near), false) AS gone
  FROM l LEFT JOIN sets s USING (w)
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (equal) AS n_equal,
         string_agg(line_text, chr(10) ORDER BY line) FILTER (NOT gone) AS k
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(p), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_equal, 0)::BIGINT AS n_equal, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: Every score of every query; the components are integers, so doubles hold the products exactly.
TOP = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id, c.r) AS rank
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM s WHERE rank <= 20
"""

#: All pairs that share a shingle, on full sets, and everything reachable over the links.
NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM d WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), near AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLES = {"op3_suffix_dedup": REPEATS, "op5_line_dedup": LINES, "op9_topk": TOP, "op10_near_dup": NEAR}
