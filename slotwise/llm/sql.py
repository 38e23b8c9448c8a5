"""SQL for the operators that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS body,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), g AS (
    SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id NULLS LAST) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


EXACT_TOP_K = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id != c.vec_id
    WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


RANKED_SEARCH = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), t AS (
    SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM d WHERE len(terms) > 0
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), c AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0
), f AS (
    SELECT row_id, doc_id, n, term, count(*) AS tf FROM t
    WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM f, c GROUP BY term
), p AS (
    SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
    FROM f JOIN w USING (term), c
), s AS (
    SELECT item_id, row_id, doc_id, CAST(sum(part) AS BIGINT) AS score
    FROM q JOIN p USING (term) GROUP BY item_id, row_id, doc_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS units
    FROM documents
), k AS (
    SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM d
), c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM k
), x AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
        array_to_string(units[b + 1:n], '') AS suffix
    FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form != 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form != 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(body) AS restored_sha256
FROM x
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_top_k": EXACT_TOP_K, "op8_exact_dedup": EXACT_DEDUP, "op12_ranked_search": RANKED_SEARCH,
        "op13_fill_in_middle": FILL_IN_MIDDLE,
    }
