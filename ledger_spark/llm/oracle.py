"""DuckDB SQL of the queries that SQL can express, written from the definitions."""

CHAT = """
WITH said AS (
    SELECT DISTINCT conv_id, turn, role AS speaker, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL
), parts AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'
), headed AS (
    SELECT *, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
        ELSE 'user name=' || speaker END AS header
    FROM said JOIN parts USING (conv_id)
), rendered AS (
    SELECT *, '<|im_start|>' || header || chr(10) || text || '<|im_end|>' || chr(10) AS segment
    FROM headed
), placed AS (
    SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective
        ORDER BY turn, speaker, text ROWS UNBOUNDED PRECEDING) AS stop FROM rendered
)
SELECT conv_id, perspective, turn, speaker, segment,
    CAST(stop - length(segment) AS BIGINT) AS "begin", CAST(stop AS BIGINT) AS "end",
    CAST(CASE WHEN speaker = perspective
        THEN stop - length(segment) + 13 + length(header) END AS BIGINT) AS mask_begin,
    CAST(CASE WHEN speaker = perspective THEN stop - 1 END AS BIGINT) AS mask_end
FROM placed
"""

TOPK = """
WITH vectors AS (
    SELECT DISTINCT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

CONTAMINATION = """
WITH items AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), starts AS (
    SELECT item_id, w, least(len(w), 13) AS k,
        unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS place
    FROM items WHERE len(w) > 0
), grams AS (
    SELECT DISTINCT item_id, k, array_to_string(w[place : place + k - 1], ' ') AS gram FROM starts
), docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM documents
), lengths AS (
    SELECT DISTINCT k FROM grams
), places AS (
    SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS place
    FROM docs JOIN lengths ON len(w) >= k
), found AS (
    SELECT doc_id, place, g.k, item_id
    FROM places p JOIN grams g ON g.k = p.k AND array_to_string(w[place : place + p.k - 1], ' ') = gram
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(place, place + k - 1)) AS word FROM found) GROUP BY ALL
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY ALL
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

RANKED = """
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
    FROM documents WHERE text IS NOT NULL
), counted AS (
    SELECT doc_id, doc, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), corpus AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM counted
), items AS (
    SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), postings AS (
    SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM items) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term
), scored AS (
    SELECT item_id, item, doc_id, doc, CAST(sum(w * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // length)))) AS BIGINT) AS score
    FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN counted USING (doc), corpus
    GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Two rounds, and the last assignment, of the same step: every part meets every entry.
_NEAREST = """
n{r} AS (
    SELECT vec_id, part, p, min(d2) AS d, arg_min(entry, d2 * 256 + entry) AS entry
    FROM (
        SELECT a.vec_id, a.part, a.p, b.entry,
            list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(a.p, b.e)]) AS d2
        FROM parts a JOIN b{r} b USING (part)
    ) GROUP BY ALL
)"""
_MOVED = """
b{next} AS (
    SELECT part, entry, coalesce(m.e, b.e) AS e FROM b{r} b LEFT JOIN (
        SELECT part, entry, list(c ORDER BY place) AS e FROM (
            SELECT part, entry, place, CAST(floor(sum(p[place]) / count(*)) AS BIGINT) AS c
            FROM n{r}, range(1, 5) AS places(place) GROUP BY ALL
        ) GROUP BY ALL
    ) m USING (part, entry)
)"""

CODES = (
    """
WITH vectors AS (
    SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
    SELECT vec_id, part, v[4 * part + 1 : 4 * part + 4] AS p FROM vectors, range(16) AS r(part)
), b0 AS (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e
    FROM parts WHERE vec_id IN (SELECT vec_id FROM vectors ORDER BY vec_id LIMIT 64)
), """
    + ", ".join(
        (_NEAREST + ("," + _MOVED if r < 2 else "")).format(r=r, next=r + 1) for r in range(3)
    )
    + """, coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error
    FROM n2 GROUP BY ALL
), labelled AS (
    SELECT label, CAST(sum(error) AS BIGINT) AS label_error
    FROM coded JOIN vectors USING (vec_id) GROUP BY ALL
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, label_error, (
    SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b2
) AS codebooks_sha256
FROM coded JOIN vectors USING (vec_id)
JOIN labelled ON vectors.label IS NOT DISTINCT FROM labelled.label
"""
)

ORACLE: dict[str, str] = {
    "op3_chat_rotation": CHAT,
    "op6_topk": TOPK,
    "op8_decontamination": CONTAMINATION,
    "op11_lexical_search": RANKED,
    "op12_vector_codes": CODES,
}
