"""SQL (DuckDB) for those of the queries that SQL can express over whole tables."""

from __future__ import annotations

from .chat import CLOSE, OPEN
from .licenses import templates

WORDS = "list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP5 = f"""WITH t AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn, role, text) AS l FROM conversations GROUP BY conv_id),
d AS (SELECT l, MIN(conv_id) AS conv_id, COUNT(*) AS n_copies FROM t GROUP BY l),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM d))
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, n_copies,
  array_to_string(list_transform(l, lambda x: {_literal(OPEN)} || x.r || chr(10) || x.t || {_literal(CLOSE)} || chr(10)), '') AS rendered
FROM d ANTI JOIN p USING (l)"""

OP7 = f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY k) AS c FROM win) WHERE c > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM dup),
flat AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, COUNT(*) AS n, string_agg(x, ' ' ORDER BY j) AS body FROM flat ANTI JOIN cov USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(body, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

GRAMS = "list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
BARE = "list_filter(string_split(regexp_replace(lower(body), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"

#: What ends a sentence, where blanks and more follow.
ENDS = "[.!?][\"'')\\]]{0,2}"

OP8 = f"""WITH raw AS (SELECT * FROM (VALUES {", ".join(f"({k}, {_literal(spdx)}, {_literal(text)})" for k, (spdx, text) in enumerate(templates()))}) v(template, license, body)),
t AS (SELECT template, license, {GRAMS.format(w="w")} AS g FROM (SELECT *, {BARE} AS w FROM raw)),
tg AS (SELECT template, license, len(g) AS t, unnest(g) AS gram FROM t),
units AS (
  SELECT doc_id, 'line' AS unit, unnest(range(0, len(l))) AS place, unnest(l) AS body FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
  UNION ALL SELECT doc_id, 'paragraph', place, body FROM (SELECT doc_id, unnest(range(0, len(p))) AS place, unnest(p) AS body FROM (SELECT doc_id, regexp_split_to_array(text, '\\n[ \\t]*\\n') AS p FROM documents)) WHERE contains(body, chr(10))
  UNION ALL SELECT doc_id, 'sentence', unnest(range(0, len(l))), unnest(l) FROM (SELECT doc_id, flatten(list_transform(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '{ENDS}[ \t]+[^ \t]')),
    lambda s: string_split(regexp_replace(s, '({ENDS})[ \t]+', '\\1' || chr(1), 'g'), chr(1)))) AS l FROM documents)
  UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE len(regexp_split_to_array(text, '\\n[ \\t]*\\n')) > 1),
u AS (SELECT doc_id, unit, place, {GRAMS.format(w="w")} AS g FROM (SELECT *, {BARE} AS w FROM units)),
ug AS (SELECT doc_id, unit, place, len(g) AS n, unnest(g) AS gram FROM u),
hit AS (SELECT doc_id, unit, place, n, template, license, t, COUNT(*) AS shared FROM ug JOIN tg USING (gram) GROUP BY ALL),
s AS (SELECT *, 2.0 * shared / (n + t) AS d FROM hit WHERE 2.0 * shared / (n + t) >= 0.8)
SELECT doc_id, unit, CAST(place AS BIGINT) AS place, license, CAST(ROUND(CAST(d AS DOUBLE), 6) AS DOUBLE) AS dice
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, unit, place ORDER BY d DESC, license, template) AS k FROM s) WHERE k = 1"""

OP9 = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w),
f AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))),
r AS (SELECT doc_id AS d, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d),
m AS (SELECT d AS doc_id, MIN(c) AS component_id FROM r GROUP BY d)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m USING (doc_id)"""

FIND = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12 = f"""WITH d AS (SELECT doc_id, {FIND} AS l FROM documents),
s AS (SELECT COUNT(*) FILTER (len(l) > 0) AS n_docs, CAST(SUM(len(l)) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, n, t, COUNT(*) AS tf FROM (SELECT doc_id, len(l) AS n, unnest(l) AS t FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, unnest({FIND}) AS t FROM benchmark),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t, n_docs),
r AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM r WHERE score > 0) WHERE k <= 10"""

#: CRC-32 of a decimal number, byte by byte and bit by bit.
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

OP13 = f"""WITH t AS (SELECT conv_id, list({{'r': COALESCE(role, ''), 't': COALESCE(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, l, {CRC} % 6 AS h FROM t),
f AS (SELECT a.conv_id, list_concat(COALESCE(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM h a LEFT JOIN t b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, d, l[1:d] AS k FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM f)),
n AS (SELECT k, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs FROM p GROUP BY k, d),
c AS (SELECT k[1:d - 1] AS k, COUNT(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, COALESCE(n_children, 0) AS n_children, (n_convs - 1) * CASE WHEN d > 0 THEN length(n.k[d].t) ELSE 0 END AS saved FROM n LEFT JOIN c USING (k)),
s AS (SELECT k[1:e] AS k, CAST(SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(SUM(saved) AS BIGINT) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM v) GROUP BY 1),
e AS (SELECT l AS k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM f GROUP BY l)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(COALESCE(ids, '')) AS ends_sha256
FROM v JOIN s USING (k) LEFT JOIN e USING (k) LEFT JOIN n u ON v.d > 0 AND u.k = v.k[1:v.d - 1]"""

ORACLES = {"op5_chat_format": OP5, "op7_cover_dedup": OP7, "op8_license_scan": OP8, "op9_sketch_dedup": OP9, "op12_ranked_search": OP12, "op13_conversation_trie": OP13}
