"""DuckDB SQL for the queries that SQL can express, over whole tables."""

_WORDS = r"""list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_COMPONENTS = """
ends AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM ends UNION SELECT r.x, b.y FROM reach r JOIN ends b ON r.y = b.x),
component AS (SELECT x AS id, least(x, min(y)) AS component_id FROM reach GROUP BY x)
"""

OP2 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
    d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN component ON id = d.doc_id
"""

OP4 = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
        ON a.vec_id < b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
),
{_COMPONENTS},
degree AS (SELECT x AS id, count(*) AS n FROM ends GROUP BY x)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
    e.vec_id = coalesce(component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree g ON g.id = e.vec_id LEFT JOIN component c ON c.id = e.vec_id
"""

OP6 = f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
),
earliest AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
covered AS (
    SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN earliest USING (g), range(0, 13) AS r(k) WHERE first < doc_id
),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
left_over AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM each ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN left_over o ON o.doc_id = w.doc_id
"""

OP12 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS a, a.label AS own, b.vec_id AS b, b.label AS other, list_inner_product(a.q, b.q)::BIGINT AS s
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positive AS (
    SELECT a, b AS p, s AS ps FROM scores WHERE own = other
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5
)
SELECT a AS anchor_id, p AS positive_id, row_number() OVER w ::INT AS rank, b AS negative_id, ps AS positive_score, s AS negative_score
FROM positive JOIN scores USING (a) WHERE own <> other AND 50 * ps <= 100 * s AND 100 * s <= 95 * ps
WINDOW w AS (PARTITION BY a, p ORDER BY s DESC, b)
QUALIFY row_number() OVER w <= 3
"""

_KEY = r"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM split),
keyed AS (SELECT *, CASE WHEN length({_KEY}) >= 20 THEN {_KEY} END AS key FROM lines),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> keeper) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""

ORACLES = {
    "op2_minhash_dedup": OP2,
    "op4_vector_dedup": OP4,
    "op6_substring_dedup": OP6,
    "op12_hard_negatives": OP12,
    "op13_line_dedup": OP13,
}
