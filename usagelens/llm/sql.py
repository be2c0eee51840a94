"""The registered queries as SQL for an independent engine, where SQL can express them."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op6_mixing"] = r"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(concat_ws(':', 'mix', doc_id::VARCHAR)) AS key
    FROM documents
), src AS (
    SELECT source, source_size, 2 * source_size AS cap,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source)
), fill(step, budget, left_w) AS (
    SELECT 0, 150 * sum(source_size)::BIGINT, sum(w)::BIGINT FROM src
    UNION ALL
    SELECT f.step + 1,
           (SELECT 150 * sum(source_size) FROM src)::BIGINT
             - 100 * coalesce(sum(CASE WHEN cap * 100 * f.left_w < w * f.budget THEN cap END), 0)::BIGINT,
           coalesce(sum(CASE WHEN cap * 100 * f.left_w < w * f.budget THEN 0 ELSE w END), 0)::BIGINT
    FROM fill f, src
    WHERE f.step < 60 AND f.left_w > 0
    GROUP BY f.step, f.budget, f.left_w
), level AS (
    SELECT budget, left_w FROM fill ORDER BY step DESC LIMIT 1
), targets AS (
    SELECT source, source_size,
           CASE WHEN left_w = 0 OR cap * 100 * left_w < w * budget THEN cap::DOUBLE
                ELSE (w * budget)::DOUBLE / (100 * left_w)::DOUBLE END AS target
    FROM src, level
), placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS whole,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                             ROWS UNBOUNDED PRECEDING) - d.size AS before
    FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)))::BIGINT
         AS taken
FROM placed
"""

SQL["op5_decontamination"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT item_id, least(len(w), 10) AS n,
           unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                   FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS phrase
    FROM items WHERE len(w) > 0
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w
    FROM docs, lengths WHERE len(w) >= n
), found AS (
    SELECT p.r, p.i, p.n, x.item_id
    FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places) p
    JOIN windows x ON p.n = x.n AND p.phrase = x.phrase
), hits AS (
    SELECT r, count(DISTINCT pos) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(m.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)
"""

SQL["op10_embedding_dedup"] = r"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links,
       least(e.vec_id, coalesce(s.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(s.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN smallest s ON s.a = e.vec_id
"""

SQL["op1_lines"] = r"""
WITH RECURSIVE places AS (
    SELECT doc_id, i - 1 AS line_no, trim(l[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
         unnest(range(1, len(l) + 1)) AS u(i)
), lines AS (
    SELECT * FROM places WHERE line <> ''
), texts AS (
    SELECT line, min((doc_id, line_no)) AS first, length(line) AS n FROM lines GROUP BY line
), links AS (
    SELECT a.line AS a, b.line AS b
    FROM texts a JOIN texts b ON b.n BETWEEN a.n - 2 AND a.n + 2 AND a.line <> b.line
    WHERE a.n >= 20 AND b.n >= 20
      AND abs(strlen(a.line) - strlen(replace(a.line, 'e', '')) - strlen(b.line) + strlen(replace(b.line, 'e', ''))) <= 2
      AND abs(strlen(a.line) - strlen(replace(a.line, 'n', '')) - strlen(b.line) + strlen(replace(b.line, 'n', ''))) <= 2
      AND levenshtein(a.line, b.line) <= 2
), reach(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
    SELECT t.line, min(o.first) AS first
    FROM texts t JOIN (SELECT a, b FROM reach UNION SELECT line, line FROM texts) r ON r.a = t.line
    JOIN texts o ON o.line = r.b
    GROUP BY t.line
), degree AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT l.doc_id, l.line_no::INTEGER AS line_no, c.first[1] AS class_doc, c.first[2]::INTEGER AS class_line,
       (l.doc_id, l.line_no) = c.first AS kept, coalesce(d.n, 0)::BIGINT AS n_links
FROM lines l JOIN classes c ON c.line = l.line LEFT JOIN degree d ON d.a = l.line
"""

SQL["op11_hard_negatives"] = r"""
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id,
           list_dot_product(a.e, b.e)::BIGINT AS score
    FROM usable a JOIN usable b ON a.r <> b.r AND len(a.e) = len(b.e)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, k
    FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k
          FROM scored WHERE alike)
    WHERE k <= 5
), negatives AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score,
           n.score AS negative_score,
           row_number() OVER (PARTITION BY p.r, p.k ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n
      ON n.r = p.r AND NOT n.alike
     AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 5
"""
