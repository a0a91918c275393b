"""DuckDB SQL for the operators that SQL can express."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def _fold(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_fold('text')}, '{_WORD}') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_fold('text')}, '{_WORD}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM sized),
grams AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc JOIN lengths ON len(w) >= n)),
hits AS (SELECT rid, i, g.n, item_id FROM grams g JOIN win ON g.n = win.n AND g.k = win.k),
marked AS (SELECT rid, count(DISTINCT j) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS j FROM hits) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN marked USING (rid) LEFT JOIN listed USING (rid)"""

TOP_K = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid)
SELECT query_id, rank, vec_id, score FROM (SELECT query_id, vec_id, score,
  row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_fold('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
seqs AS (SELECT w, min(doc_id) AS id FROM doc WHERE len(w) > 0 GROUP BY w),
sh AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT id, w, unnest(generate_series(1, greatest(1, len(w)::BIGINT - 4))) AS i FROM seqs)),
n AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM sh a JOIN sh b ON a.k = b.k AND a.id < b.id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link UNION SELECT id, id FROM n),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM doc LEFT JOIN seqs ON doc.w = seqs.w LEFT JOIN n ON n.id = seqs.id LEFT JOIN comp ON comp.id = seqs.id"""


HARD_NEGATIVES = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.rid <> c.rid),
pos AS (SELECT * FROM (SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
neg AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM pos p JOIN s ON s.rid = p.rid AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3"""
