"""DuckDB statements of the text operators that SQL can express."""

from __future__ import annotations

OP7_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT k, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), items AS (
    SELECT k, unnest(s) AS item FROM sets
), shared AS (
    SELECT a.k AS a, b.k AS b, count(*) AS n_both FROM items a JOIN items b USING (item) WHERE a.k <> b.k GROUP BY ALL
), links AS (
    SELECT x.a, x.b FROM shared x JOIN sets a ON a.k = x.a JOIN sets b ON b.k = x.b
    WHERE 100 * n_both >= 85 * (len(a.s) + len(b.s) - n_both)
), reach AS (
    SELECT k AS a, k AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counted AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
), smallest AS (
    SELECT r.a, min(s.doc_id) AS component_id FROM reach r JOIN sets s ON s.k = r.b GROUP BY r.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM sets JOIN smallest m ON m.a = k LEFT JOIN counted c ON c.a = k
"""

OP11_EMBEDDING_DEDUP = """
WITH RECURSIVE given AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL
), valid AS (
    SELECT vec_id, e FROM given
    WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM given
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = reach.a) AS n_links,
       min(b) AS component_id, min(b) = a AS kept
FROM reach GROUP BY a
"""

OP12_FILTER_AUDIT = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
    FROM documents
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), masks AS (
    SELECT doc_id, part,
           (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
    FROM docs
), counts AS (
    SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM masks LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT CAST(i AS INTEGER) AS i, chr(CAST(65 + i AS INTEGER)) AS c FROM range(5) r(i)
), orders AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS f
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
    SELECT filter_order, CAST(s AS INTEGER) AS step, f[s] AS filter, CAST(pow(2, f[s]) AS INTEGER) AS bit,
           CAST(coalesce(list_sum(list_transform(f[1:s - 1], lambda x: pow(2, x))), 0) AS INTEGER) AS before
    FROM orders, range(1, 6) r(s)
), each AS (
    SELECT part, filter_order, step, filter,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * toxic ELSE 0 END) AS toxic_lost
    FROM counts, steps GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM each
"""

ORACLE = {
    "op7_jaccard_join": OP7_JACCARD_JOIN, "op11_embedding_dedup": OP11_EMBEDDING_DEDUP, "op12_filter_audit": OP12_FILTER_AUDIT,
}
