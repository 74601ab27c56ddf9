"""DuckDB SQL for the queries of this subpackage that SQL can express."""

DECONTAMINATION = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), starts AS (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS words FROM starts
), places AS (
    SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s
    FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), hits AS (
    SELECT p.r, p.s, p.n, x.item_id
    FROM (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS words FROM places) p JOIN windows x USING (n, words)
), covered AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(s, s + n)) AS place FROM hits) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

QUALITY = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), line AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM doc)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), place AS (
    SELECT r, w, unnest(range(1, len(w) - 1)) AS s FROM doc WHERE len(w) >= 3
), counted AS (
    SELECT r, s, count(*) OVER (PARTITION BY r, words) AS n
    FROM (SELECT r, s, array_to_string(w[s:s + 2], ' ') AS words FROM place)
), repeated AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest([s, s + 1, s + 2]) AS p FROM counted WHERE n > 1) GROUP BY r
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
    FROM doc LEFT JOIN line USING (r) LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, CAST(
        CAST(n_words < 50 AS INT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS INT)
        + 4 * CAST(10 * n_symbols > n_words AS INT) + 8 * CAST(2 * n_dup_lines > n_lines AS INT)
        + 16 * CAST(word_chars < 2 * n_words AS INT) + 32 * CAST(word_chars > 30 * n_words AS INT) AS BIGINT) AS failures
    FROM measured
)
SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM judged
"""

DIVERGENCE = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), token AS (
    SELECT r, lang, source, unnest(w) AS term FROM doc
), kept AS (
    SELECT lang, term, count(*) AS total FROM token GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), grp AS (
    SELECT DISTINCT lang, source FROM doc
), size AS (
    SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang
), counted AS (
    SELECT lang, source, term, count(*) AS c FROM token SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), cell AS (
    SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c, k.total
    FROM grp g JOIN kept k USING (lang)
    LEFT JOIN counted x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), own AS (
    SELECT lang, source, sum(c)::HUGEINT AS n FROM cell GROUP BY lang, source
), share AS (
    SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (own.n + 5 * v) AS p,
        1 + (1000000000::HUGEINT * (total + 5)) // (size.n + 5 * v) AS q
    FROM cell JOIN own USING (lang, source) JOIN size USING (lang)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT lang, source, 'term', term, p - q FROM share WHERE c > 0 AND p > q)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

TOP_K = """
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id,
        coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1] * z[2], 0))), 0) AS score
    FROM usable q JOIN usable c ON q.r <> c.r WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION,
    "op8_quality_rules": QUALITY,
    "op12_source_divergence": DIVERGENCE,
    "op13_top_k": TOP_K,
}
