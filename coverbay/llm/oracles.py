"""DuckDB SQL with the meaning of the registered queries, where SQL can express it."""

from __future__ import annotations

_OP1 = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), wanted AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i:i + 12], ' ') AS window
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM item WHERE len(words) > 0)
), sizes AS (
    SELECT DISTINCT size FROM wanted
), places AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS window
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM doc, sizes WHERE len(words) >= size)
), hits AS (
    SELECT doc_id, i, p.size, item_id FROM places p JOIN wanted w ON p.size = w.size AND p.window = w.window
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= coalesce(len(words), 0) AS contaminated
FROM doc LEFT JOIN covered c USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

_OP9 = """
WITH page AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
), first AS (
    SELECT digest, min(page_id) AS page_id FROM page WHERE bytes >= 100 GROUP BY digest
)
SELECT p.page_id, CAST(p.bytes AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.page_id IS DISTINCT FROM p.page_id AND f.page_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id IS DISTINCT FROM p.page_id THEN f.page_id END AS refers_to
FROM page p LEFT JOIN first f ON p.digest = f.digest
"""

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP2 = f"""
WITH doc AS (
    SELECT doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL
), term AS (
    SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM doc) GROUP BY ALL
), size AS (
    SELECT doc_id, len(words) AS n FROM doc
), total AS (
    SELECT count(*) AS docs, (SELECT sum(n) FROM size) / count(*) AS mean FROM documents
), idf AS (
    SELECT word, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM term, total GROUP BY word, docs
), scored AS (
    SELECT q.doc_id AS query_id, d.doc_id,
           round(sum(idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
    FROM term q JOIN term d ON d.word = q.word JOIN idf ON idf.word = q.word JOIN size ON size.doc_id = d.doc_id, total
    WHERE q.doc_id % 50 = 0 GROUP BY q.doc_id, d.doc_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""

# CRC-32 from its definition: a table of 256 remainders, then one step per byte
_OP4 = """
WITH RECURSIVE steps(n, c, k) AS (
    SELECT i, i, 0 FROM (SELECT CAST(unnest(range(256)) AS UBIGINT) AS i)
    UNION ALL
    SELECT n, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), remainders AS (
    SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8
), doc AS (
    SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size,
           list_prepend(CAST(4294967295 AS UBIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'),
               lambda pair: CAST('0x' || pair AS UBIGINT))) AS bytes
    FROM documents
), summed AS (
    SELECT doc_id, size, CAST(xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])),
                                  CAST(4294967295 AS UBIGINT)) AS BIGINT) AS text_crc32 FROM doc, remainders
), line AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto,
           (SELECT sum(size) FROM summed) AS total FROM summed
), placed AS (
    SELECT *, CAST((2 * upto - size) * 8 // (2 * total) AS INTEGER) AS shard FROM line
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard FROM placed
"""

# every pair that shares a shingle, then the components of all links
_OP10 = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, {_WORDS} AS words, min(doc_id) OVER (PARTITION BY text) AS text_id FROM documents
), shingle AS (
    SELECT doc_id, text_id, array_to_string(words[i:i + 4], ' ') AS s, count(*) AS n
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM doc WHERE len(words) > 0) GROUP BY ALL
), weight AS (
    SELECT s, CASE WHEN count(*) > 0.01 * docs THEN 0.5 + 0.5 * greatest(0, least(1, ln(docs / count(*)) / ln(100))) ELSE 1 END AS idf
    FROM shingle, (SELECT count(*) AS docs FROM documents) GROUP BY s, docs
), weighed AS (
    SELECT doc_id, s, n * idf AS w FROM shingle JOIN weight USING (s) WHERE doc_id = text_id
), total AS (
    SELECT doc_id, sum(w) AS w FROM weighed GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.w, b.w)) AS w
    FROM weighed a JOIN weighed b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM shared JOIN total x ON x.doc_id = a JOIN total y ON y.doc_id = b
    WHERE shared.w / (x.w + y.w - shared.w) >= 0.8
), reach AS (
    SELECT text_id AS node, text_id AS root FROM doc
    UNION
    SELECT CASE WHEN reach.node = a THEN b ELSE a END, root FROM reach JOIN link ON reach.node = a OR reach.node = b
)
SELECT doc.doc_id, (SELECT min(root) FROM reach WHERE node = text_id) AS class_id, text_id FROM doc
"""

# each level hashes runs of eight; then every leaf is walked up, its siblings listed and its claim folded
_OP11 = """
WITH RECURSIVE steps(n, c, k) AS (
    SELECT i, i, 0 FROM (SELECT CAST(unnest(range(256)) AS UBIGINT) AS i)
    UNION ALL
    SELECT n, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), remainders AS (
    SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8
), doc AS (
    SELECT doc_id, lang, text,
           coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
           || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
           xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
               lambda pair: CAST('0x' || pair AS UBIGINT))), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])),
               CAST(4294967295 AS UBIGINT)) % 3 = 0 AS tamper
    FROM documents, remainders
), hashed AS (
    SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(octet_length(encode(text)) || ':' || CASE WHEN tamper
               THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claimed
    FROM doc
), leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf, claimed) AS row,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS size FROM hashed
), nodes(tree, level, idx, size, digest) AS (
    SELECT tree, 0, idx, size, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE size > 1 GROUP BY tree, level, idx // 8, size
), subroots AS (
    SELECT tree, digest, count(*) OVER () AS size FROM nodes WHERE size = 1
), tops(level, idx, size, digest) AS (
    SELECT 0, tree, size, digest FROM subroots
    UNION ALL
    SELECT level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE size > 1 GROUP BY level, idx // 8, size
), runs AS (
    SELECT tree, level, idx // 8 AS run, list(digest ORDER BY idx) AS members FROM nodes WHERE size > 1 GROUP BY ALL
    UNION ALL
    SELECT -1, level, idx // 8, list(digest ORDER BY idx) FROM tops WHERE size > 1 GROUP BY ALL
), climbed(row, own, level, idx, proof, fold) AS (
    SELECT row, tree, 0, idx, '', claimed FROM leaves
    UNION ALL
    SELECT c.row, own, c.level + 1, idx // 8,
           proof || array_to_string(members[:idx % 8] || members[idx % 8 + 2:], ''),
           sha256(array_to_string(members[:idx % 8] || [fold] || members[idx % 8 + 2:], ''))
    FROM climbed c JOIN runs r ON r.tree = c.own AND r.level = c.level AND r.run = c.idx // 8
), arrived AS (
    SELECT row, own, proof, fold FROM climbed QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
), above(row, level, idx, proof, fold) AS (
    SELECT row, 0, own, proof, fold FROM arrived
    UNION ALL
    SELECT a.row, a.level + 1, idx // 8,
           proof || array_to_string(members[:idx % 8] || members[idx % 8 + 2:], ''),
           sha256(array_to_string(members[:idx % 8] || [fold] || members[idx % 8 + 2:], ''))
    FROM above a JOIN runs r ON r.tree = -1 AND r.level = a.level AND r.run = a.idx // 8
), ended AS (
    SELECT row, proof, fold FROM above QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = t.digest AS verified
FROM leaves JOIN ended USING (row) JOIN subroots s USING (tree), (SELECT digest FROM tops WHERE size = 1) t
"""

# all rows against all anchors
_OP13 = """
WITH vec AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vec a, vec b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT * FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

ORACLES = {"op1_decontaminate": _OP1, "op2_topk": _OP2, "op4_shard": _OP4, "op9_warc": _OP9, "op10_near_duplicates": _OP10, "op11_merkle": _OP11, "op13_hard_negatives": _OP13}
