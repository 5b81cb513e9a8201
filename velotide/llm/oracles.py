"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                     lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              ELSE list_distinct(list_transform(range(greatest(len(w) - 3, 1)),
                                                lambda i: array_to_string(w[i + 1 : i + 4], ' '))) END AS grams
  FROM words
), grams AS (
  SELECT doc_id, unnest(grams) AS gram FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b
  WHERE 100 * n >= 85 * (len(x.grams) + len(y.grams) - n)
), either_way AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN either_way l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = s.doc_id
"""

OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat('0/', coalesce(CAST(doc_id AS VARCHAR), ''))) AS ticket
  FROM documents
), placed AS (
  SELECT source, source_size, 2 * source_size AS cap,
         ([3, 1, 2])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
), filling AS (
  SELECT *, row_number() OVER fill AS rank,
         (sum(source_size) OVER ()) * 150 / 100.0::DOUBLE AS budget,
         coalesce(sum(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         (sum(weight) OVER ()) - coalesce(sum(weight) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM placed WINDOW fill AS (ORDER BY cap / weight::DOUBLE, place)
), levels AS (
  SELECT *, (budget - full_before) / weight_left AS level FROM filling
), plan AS (
  SELECT source, source_size,
         CASE WHEN lvl * weight < cap THEN lvl * weight ELSE cap::DOUBLE END AS target
  FROM levels, (SELECT min_by(level, rank) FILTER (WHERE level * weight <= cap) AS lvl FROM levels)
), copies AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target, s.ticket, c.copy,
         ((sum(s.size) OVER (PARTITION BY s.source, c.copy ORDER BY s.ticket, s.doc_id, s.size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) + c.copy * p.source_size)
         / CASE WHEN p.target > 0 THEN p.target END AS finish
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source, (VALUES (0), (1)) c(copy)
), running AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source, ticket, copy, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM copies WHERE finish IS NOT NULL
), taken AS (
  SELECT doc_id, source, sum(size) AS taken FROM running
  WHERE through <= (SELECT sum(size) FROM sized) * 150 / 100.0::DOUBLE GROUP BY ALL
)
SELECT s.doc_id, s.source, CAST(s.size AS BIGINT) AS size, p.source_size, p.target,
       CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN taken t ON t.doc_id IS NOT DISTINCT FROM s.doc_id AND t.source IS NOT DISTINCT FROM s.source
"""

OP3 = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e
JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.vec_id
"""

OP4 = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), original AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original
  FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > original THEN original END AS refers_to
FROM original
"""

OP11 = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL
), lengths AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id
), totals AS (
  SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths
), strata AS (
  SELECT doc_id, 75 + (25 * n * big_n) // big_l AS m FROM lengths, totals
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, big_n
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT a.item_id, p.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked a JOIN postings p USING (term) JOIN weights USING (term) JOIN strata s ON s.doc_id = p.doc_id
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP12 = r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, list_reduce(list_prepend(range, [0, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
  FROM range(256)
), crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM bits
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(concat(CAST(doc_id AS VARCHAR), ':', run))) AS digits
  FROM runs GROUP BY ALL
), summed AS (
  SELECT run, n,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                         list_transform(range(len(digits) // 2), lambda i: CAST(concat('0x', digits[2 * i + 1 : 2 * i + 2]) AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h
  FROM counted, crc_table
), edited AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
  FROM summed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
  SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
  FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, word AS root, form AS following FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.following
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root
FROM forms f JOIN chain c ON c.word = f.word WHERE c.following IS NULL
"""

OP13 = r"""
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard_join": OP2,
    "op3_pivot_range_join": OP3,
    "op4_warc_normaliser": OP4,
    "op10_weighted_fair_mix": OP10,
    "op11_stratified_search": OP11,
    "op12_spelling_variants": OP12,
    "op13_one_bit_neighbours": OP13,
}
