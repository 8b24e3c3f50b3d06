"""DuckDB SQL for the queries that SQL can express."""

#: Windows of 50 words, brute force; space-separated words numbered from 1.
REPEATS = r"""
WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
           FROM documents),
h AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
m AS (SELECT k, min(doc_id) AS m FROM h GROUP BY k),
gone AS (SELECT DISTINCT h.doc_id, unnest(range(h.s, h.s + 50)) AS i FROM h JOIN m USING (k) WHERE m.m < h.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.word, ' ' ORDER BY w.i) AS t
         FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

#: Words of documents and items, windows by text, brute force.
LEAKS = r"""
WITH lowered AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
t AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM lowered),
item AS (SELECT id, w, least(10, len(w)) AS m FROM t WHERE kind = 1 AND len(w) > 0),
win AS (SELECT DISTINCT id AS item, m, array_to_string(w[s:s + m - 1], ' ') AS k
        FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM item)),
sizes AS (SELECT DISTINCT m FROM win),
place AS (SELECT id, s, m, array_to_string(w[s:s + m - 1], ' ') AS k
          FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM t, sizes WHERE kind = 0 AND len(w) >= m)),
hit AS (SELECT place.id, place.s, place.m, win.item FROM place JOIN win USING (m, k)),
n AS (SELECT id, count(DISTINCT i) AS n FROM (SELECT id, unnest(range(s, s + m)) AS i FROM hit) GROUP BY id),
items AS (SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l
          FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hit) GROUP BY id)
SELECT t.id AS doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.l, '')) AS items_sha256,
       coalesce(n.n, 0) > 0 AS contaminated
FROM t LEFT JOIN n USING (id) LEFT JOIN items USING (id) WHERE kind = 0
"""

#: Base 32 from hexadecimal: each 5 bits from the three digits that hold them.
ARCHIVES = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) || '00' AS x,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           (instr('0123456789abcdef', substr(x, 1 + (5 * i) // 4, 1)) - 1) * 256
           + (instr('0123456789abcdef', substr(x, 2 + (5 * i) // 4, 1)) - 1) * 16
           + (instr('0123456789abcdef', substr(x, 3 + (5 * i) // 4, 1)) - 1)) // (1 << (7 - (5 * i) % 4)) % 32 AS BIGINT), 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""

#: BM25 (k1 1.2, b 0.75) of each query's distinct words against every document.
SEARCH = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(len(w)) / count(*) AS a FROM d),
tf AS (SELECT doc_id, t, CAST(count(*) AS DOUBLE) AS tf, any_value(l) AS l
       FROM (SELECT doc_id, unnest(w) AS t, len(w) AS l FROM d) GROUP BY doc_id, t),
idf AS (SELECT t, ln(1 + (any_value(n.n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, n GROUP BY t),
s AS (SELECT q.doc_id AS query_id, tf.doc_id,
             round(sum(idf.idf * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.l / n.a))), 6) AS score
      FROM tf q JOIN tf USING (t) JOIN idf USING (t), n WHERE q.doc_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

#: Words by runs, each distinct run of a document with its CRC 32 (table by rule, bytes from
#: hexadecimal); near words share what is left when one code point goes.
VARIANTS = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                                  ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
found AS (SELECT doc_id, run, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents) GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM found),
hashed AS (SELECT run, n, xor(list_reduce([CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) FOR i IN range(len(x) // 2)],
                  lambda c, b: xor(c >> 8, crc.t[CAST(xor(c, b) & 255 AS BIGINT) + 1]), 4294967295), 4294967295) AS h
           FROM hexed, crc),
changed AS (SELECT CASE WHEN h % 31 <> 0 THEN run ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gone AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
longer AS (SELECT DISTINCT w.word AS a, gone.word AS b FROM w JOIN gone ON w.word = gone.rest),
near AS (SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT a, b FROM longer UNION SELECT b, a FROM longer),
best AS (SELECT near.word, count(*) AS n_near, min((-w.n, near.other)) AS best FROM near JOIN w ON w.word = near.other GROUP BY near.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 10 * w.n THEN best[2] END AS form,
                 CASE WHEN -best[1] >= 10 * w.n THEN -best[1] END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM forms
          UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chain USING (word) JOIN forms last ON last.word = chain.at WHERE last.form IS NULL
"""

#: Every row scored for every anchor.
NEGATIVES = r"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS anchor, b.id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.id % 50 = 0),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) <= 3
"""

ORACLE: dict[str, str] = {
    "op11_spelling_variants": VARIANTS,
    "op13_hard_negatives": NEGATIVES,
    "op10_topk_search": SEARCH,
    "op7_warc": ARCHIVES,
    "op9_decontamination": LEAKS,
    "op5_substring_dedup": REPEATS,
}
