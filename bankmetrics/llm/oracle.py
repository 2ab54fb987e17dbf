"""Plain SQL for those queries of the operators that SQL can express; the others are tested against brute force."""

from __future__ import annotations

QUERIES = {
    "op2_metric_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS vec FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 20 = 0),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op7_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(CASE
                    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * o >= 75 * (a.n + b.n - o)),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, y FROM reached JOIN links ON x = other)
        SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
    "op11_fill_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        t AS (
            SELECT doc_id, text,
                regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
                list_transform(range(0, 4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS h
            FROM d),
        f AS (
            SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n,
                least(h[1] % (len(tokens) + 1), h[2] % (len(tokens) + 1)) AS a,
                greatest(h[1] % (len(tokens) + 1), h[2] % (len(tokens) + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM t),
        p AS (
            SELECT doc_id, text, n, form, coalesce(array_to_string(tokens[1:a], ''), '') AS prefix,
                coalesce(array_to_string(tokens[a + 1:b], ''), '') AS middle,
                coalesce(array_to_string(tokens[b + 1:], ''), '') AS suffix
            FROM f)
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM p""",
}


def all_sql() -> dict[str, str]:
    return dict(QUERIES)
