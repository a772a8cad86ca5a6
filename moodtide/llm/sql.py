"""DuckDB twins of the registered queries, where SQL can express them."""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), sized AS (
  SELECT *, 24 + length(replace(replace(replace(role, '\', '\b'), '<|', '<\|'), chr(10), '\n'))
              + length(replace(replace(text, '\', '\b'), '<|', '<\|')) AS chars,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), queries AS (
  SELECT row_number() OVER () AS q, vec_id, v FROM (SELECT DISTINCT vec_id, v FROM vectors WHERE vec_id % 50 = 0)
), scored AS (
  SELECT q.q, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM queries q JOIN vectors c ON q.vec_id IS DISTINCT FROM c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS "rank"
  FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""

# Every window of an item's length around each shared shingle, by brute force.
LEAKS = r"""
WITH tokens AS (
  SELECT doc_id, text, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id, text, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM benchmark
), doc_runs AS (
  SELECT doc_id, text, p - 1 AS p, array_to_string(w[p:p + 4], ' ') AS run
  FROM (SELECT DISTINCT doc_id, text, w, unnest(range(1, len(w) - 3)) AS p FROM tokens WHERE len(w) >= 5)
), item_runs AS (
  SELECT item_id, text AS item, len(w) AS n, q - 1 AS q, array_to_string(w[q:q + 4], ' ') AS run
  FROM (SELECT item_id, text, w, unnest(range(1, len(w) - 3)) AS q FROM items WHERE len(w) >= 5)
), wanted AS (SELECT DISTINCT run FROM item_runs
), held AS (SELECT * FROM doc_runs SEMI JOIN wanted USING (run)
), near AS (
  SELECT DISTINCT h.doc_id, h.text, i.item_id, i.item, i.n, h.p - i.q + shift.d AS s
  FROM held h JOIN item_runs i USING (run), range(-6, 7) shift(d)
), docs AS (SELECT doc_id, text, count(*) AS runs FROM doc_runs GROUP BY ALL
), placed AS (
  SELECT DISTINCT n.doc_id, n.text, item_id, item, n, greatest(least(s, runs - n + 4), 0) AS start,
         least(greatest(least(s, runs - n + 4), 0) + n - 4, runs) AS stop
  FROM near n JOIN docs d ON n.doc_id IS NOT DISTINCT FROM d.doc_id AND n.text = d.text
), window_counts AS (
  SELECT p.doc_id, p.text, p.item_id, p.item, p.n, p.start, p.stop, h.run, count(*) AS c
  FROM placed p JOIN held h ON p.doc_id IS NOT DISTINCT FROM h.doc_id AND p.text = h.text AND h.p >= p.start AND h.p < p.stop
  GROUP BY ALL
), item_counts AS (SELECT item_id, item, run, count(*) AS c FROM item_runs GROUP BY ALL
), scored AS (
  SELECT w.doc_id, w.text, w.item_id, w.item, w.n, w.start, w.stop, sum(least(w.c, i.c)) AS together
  FROM window_counts w JOIN item_counts i ON w.item_id IS NOT DISTINCT FROM i.item_id AND w.item = i.item AND w.run = i.run
  GROUP BY ALL
), rated AS (
  SELECT *, together / ((stop - start) + (n - 4) - together) AS similarity FROM scored
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, text, item_id, item ORDER BY similarity DESC, start) AS place
  FROM rated WHERE similarity >= 0.8
)
SELECT doc_id, item_id, round(similarity, 6) AS similarity, CAST(start AS BIGINT) AS word_start, CAST(n AS BIGINT) AS n_words
FROM best WHERE place = 1
"""

LINES = r"""
WITH texts AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS body FROM texts
), worded AS (
  SELECT doc_id, text, line,
         list_transform(list_filter(string_split_regex(body, '[ \t\r]+'), lambda t: t <> ''),
                        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS w
  FROM split
), lined AS (SELECT *, len(w) AS n, w[1:3] AS head FROM worded WHERE len(w) >= 3
), busy AS (
  SELECT n, head FROM (SELECT DISTINCT n, head, doc_id, text FROM lined) GROUP BY ALL HAVING count(*) >= 3
), inside AS (SELECT * FROM lined SEMI JOIN busy USING (n, head)
), different AS (
  SELECT n, head, w, count(*) AS docs FROM (SELECT DISTINCT n, head, w, doc_id, text FROM inside) GROUP BY ALL
), places AS (SELECT n, head, w, docs, unnest(range(len(w))) AS i, unnest(w) AS t FROM different
), fixed AS (
  SELECT n, head, i, t FROM places WHERE t <> '<*>' GROUP BY ALL HAVING sum(docs) >= 3
), shaped AS (
  SELECT p.n, p.head, p.w, list(f.t ORDER BY p.i) AS shape, count(f.t) AS constants
  FROM places p LEFT JOIN fixed f USING (n, head, i, t) GROUP BY ALL
), known AS (SELECT n, head, w, shape FROM shaped WHERE constants >= 0.6 * n
), found AS (SELECT i.doc_id, i.text, i.line, k.n, k.head, k.shape FROM inside i JOIN known k USING (n, head, w)
), often AS (
  SELECT n, head, shape FROM (SELECT DISTINCT n, head, shape, doc_id, text FROM found) GROUP BY ALL HAVING count(*) >= 3
), ranked AS (
  SELECT f.*, row_number() OVER (PARTITION BY n, head, shape ORDER BY doc_id NULLS LAST, line) AS place
  FROM found f SEMI JOIN often USING (n, head, shape)
), gone AS (SELECT doc_id, text, list(line) AS dropped FROM ranked WHERE place > 1 GROUP BY ALL
), kept AS (
  SELECT d.doc_id, d.text, len(coalesce(g.dropped, [])) AS n_dropped, string_split(coalesce(d.text, ''), chr(10)) AS all_lines,
         coalesce(g.dropped, []) AS dropped
  FROM documents d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND coalesce(d.text, '') = g.text
), rebuilt AS (
  SELECT *, CASE WHEN n_dropped = 0 THEN coalesce(text, '') ELSE array_to_string(
    [x FOR x, i IN all_lines IF NOT list_contains(dropped, i - 1)], chr(10)) END AS body FROM kept
)
SELECT doc_id, CAST(CASE WHEN text <> '' THEN len(all_lines) ELSE 0 END AS BIGINT) AS n_lines,
       CAST(n_dropped AS BIGINT) AS n_dropped, CAST(length(body) AS BIGINT) AS kept_chars, md5(body) AS kept_md5
FROM rebuilt
"""

RANKED = r"""
WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), worded AS (
  SELECT d, doc_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM texts
), held AS (SELECT d, doc_id, w, len(w) AS n FROM worded WHERE len(w) > 0
), totals AS (SELECT count(*) AS n_docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_terms FROM held
), postings AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(w) AS term FROM held) GROUP BY ALL
), items AS (
  SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)
), asked AS (
  SELECT DISTINCT i, item_id, unnest(list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM items
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), scored AS (
  SELECT i, item_id, d, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS "rank" FROM scored WHERE score > 0
)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 50
"""

# CRC-32 bit by bit; a node is named by the digests of its turns one behind the other.
TRIE = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
           lambda c, s: list_reduce(list_prepend(xor(c, s), CAST(range(8) AS BIGINT[])),
             lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id
), whole AS (SELECT s.*, least(h, coalesce(b.n, 0)) AS k FROM sizes s LEFT JOIN (SELECT conv_id AS base, n FROM sizes) b USING (base)
), rebuilt AS (
  SELECT w.conv_id, t.i AS pos, role, text FROM whole w JOIN turns t ON t.conv_id = w.base AND t.i <= w.h
  UNION ALL SELECT w.conv_id, t.i - w.h + w.k, role, text FROM whole w JOIN turns t ON t.conv_id = w.conv_id AND t.i > w.h
), paths AS (
  SELECT conv_id, pos AS depth, octet_length(encode(text)) AS bytes,
         string_agg(md5(role || chr(10) || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM sizes
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n, first(bytes) AS bytes FROM paths GROUP BY path, depth
), children AS (
  SELECT left(path, (depth - 1) * 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), sums AS (
  SELECT a.path, count(*) FILTER (below.n_children = 0) AS n_leaves, CAST(sum((below.n - 1) * below.bytes) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) below JOIN nodes a ON a.path = left(below.path, up * 32) GROUP BY 1
), ends AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, path FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY 1
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM counted c JOIN sums USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON c.depth > 0 AND p.path = left(c.path, (c.depth - 1) * 32)
"""

VECTOR_LINKS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= CAST(0.9 AS DOUBLE)
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), components AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY 1
), counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""
