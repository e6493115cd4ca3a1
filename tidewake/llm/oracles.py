"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Lines as sets of words; classes of equal sets; pairs that share a prefix token, verified.
LINE_DEDUP = f"""WITH cut AS (SELECT doc_id, string_split({LOWER.format("text")}, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, list_sort(list_distinct({SPACED.format("unnest(l)")})) AS s FROM cut),
full_ AS (SELECT doc_id, line_no, s, coalesce(doc_id, 9223372036854775807) AS d FROM lines WHERE len(s) > 0),
classes AS (SELECT row_number() OVER () AS c, * FROM (SELECT s, min(struct_pack(d := d, l := line_no)) AS first, count(*) AS copies FROM full_ GROUP BY s)),
tokens AS (SELECT c, len(s) AS n, unnest(s) AS t FROM classes WHERE len(s) >= 4),
counts AS (SELECT t, count(*) AS f FROM tokens GROUP BY t),
prefixes AS (SELECT c, n, t FROM tokens JOIN counts USING (t) QUALIFY row_number() OVER (PARTITION BY c ORDER BY f, t) <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.c AS x, b.c AS y FROM prefixes a JOIN prefixes b ON a.t = b.t AND a.c < b.c AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
links AS (SELECT x, y, p.first AS at_x, q.first AS at_y FROM pairs JOIN classes p ON p.c = x JOIN classes q ON q.c = y WHERE 9 * len(list_intersect(p.s, q.s)) >= 4 * (len(p.s) + len(q.s))),
sides AS (SELECT x AS c, at_y AS near FROM links UNION ALL SELECT y, at_x FROM links),
near AS (SELECT c, count(*) AS links, min(near) AS near FROM sides GROUP BY c)
SELECT f.doc_id, f.line_no, nullif(k.first.d, 9223372036854775807) AS class_doc, k.first.l AS class_line, k.copies, coalesce(n.links, 0) AS links,
  struct_pack(d := f.d, l := f.line_no) > k.first OR coalesce(n.near < k.first, false) AS removed
FROM full_ f JOIN classes k USING (s) LEFT JOIN near n USING (c)"""

#: Windows of items and of documents as texts; runs of equal words along one distance between document and item.
DECONTAMINATION = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {ALNUM.format(LOWER.format("text"))} AS w FROM (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, text FROM benchmark WHERE text IS NOT NULL)),
windows AS (SELECT i, item_id, least(len(w), 10) AS n, array_to_string(w[k + 1 : k + 10], ' ') AS t FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, k, array_to_string(w[k + 1 : k + n], ' ') AS t FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS k FROM docs, sizes WHERE len(w) >= n)),
found AS (SELECT DISTINCT p.r, p.k, p.n, v.item_id FROM places p JOIN windows v USING (n, t)),
hits AS (SELECT r, count(DISTINCT hit) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS hit FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r),
doc_words AS (SELECT r, generate_subscripts(w, 1) - 1 AS p, unnest(w) AS word FROM docs WHERE r IN (SELECT r FROM found)),
item_words AS (SELECT i, item_id, len(w) AS size, generate_subscripts(w, 1) - 1 AS q, unnest(w) AS word FROM items),
same AS (SELECT r, i, item_id, size, p, q, p - row_number() OVER (PARTITION BY r, i, p - q ORDER BY p) AS island FROM doc_words JOIN item_words USING (word)),
runs AS (SELECT r, item_id, min(p) AS p, min(q) AS q, count(*) AS length, any_value(size) AS size FROM same GROUP BY r, i, item_id, p - q, island),
longest AS (SELECT * FROM runs WHERE length >= least(size, 10) QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, p, item_id IS NULL, item_id, q) = 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items, coalesce(m.items_sha256, sha256('')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated,
  coalesce(l.length, 0) AS longest_match, CAST(l.p AS BIGINT) AS match_word, l.item_id AS match_item, CAST(l.q AS BIGINT) AS match_item_word
FROM docs d LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r) LEFT JOIN longest l USING (r)"""

#: All products of anchors and rows; vectors of the tables have one length.
HARD_NEGATIVES = """WITH rows AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id NULLS LAST, other) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON n.r = p.r AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
WINDOW best AS (PARTITION BY p.r, p.other ORDER BY n.s DESC, n.vec_id NULLS LAST, n.other) QUALIFY row_number() OVER best <= 5"""

#: The template adds 24 characters a turn, and a backslash to each control string in a text.
CHAT_FORMAT = r"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + 24 + len(regexp_extract_all(text, '<\\*\|im_(?:start|end)\|>'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
