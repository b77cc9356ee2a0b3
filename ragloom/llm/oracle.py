"""DuckDB SQL of the queries that SQL can express on whole tables.

``op10`` and ``op9`` have none: SQL would list all pairs of documents that
share a shingle, and cannot cluster words; brute force on small tables checks
them in tests/llm.  ``op13``'s does list these pairs, which is bearable on the
tables that the SQL runs on.
"""

from __future__ import annotations

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
             m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
        FROM m""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
                          list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
                   FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op12_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
             h AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
                          t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 AS plain,
                          ('0x' || h[25:32])::BIGINT % 100 < 20 AS spm FROM d),
             c AS (SELECT *, least(x, y) AS a, greatest(x, y) - least(x, y) AS m FROM h),
             o AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, m) AS mid, substr(t, a + m + 1) AS suf FROM c)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN m END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                           ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM o""",
    "op13_setsketch": r"""
        WITH RECURSIVE
             w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                                       ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS sh FROM w),
             n AS (SELECT doc_id, len(sh) AS n FROM s),
             e AS MATERIALIZED (SELECT doc_id, unnest(sh) AS t FROM s),
             c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
             l AS MATERIALIZED (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
             r AS (SELECT doc_id AS x, doc_id AS c FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.c)
        SELECT x AS doc_id, any_value(n.n) AS n_shingles, min(c) AS component_id, x = min(c) AS kept
        FROM r JOIN n ON n.doc_id = x GROUP BY x""",
}
