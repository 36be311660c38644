"""DuckDB SQL for the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

OP5 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         row_number() OVER (ORDER BY doc_id, coalesce(text, '')) AS r, count(*) OVER () AS c
  FROM documents),
e AS (
  SELECT d.doc_id, d.r, d.n, d.t, nx.t AS nt, nx.r AS nr,
         substr(d.t, 1, CAST(d.n - d.n // 4 AS INT)) || substr(nx.t, 1, CAST(d.n // 4 AS INT)) AS et
  FROM d JOIN d nx ON nx.r = d.r % d.c + 1),
texts AS (SELECT DISTINCT t FROM (SELECT t FROM d UNION ALL SELECT et FROM e)),
units AS (
  SELECT t, u FROM (SELECT t, unnest(string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) AS u FROM texts)
  WHERE u <> ''),
hashed AS (SELECT u, sha256('0' || u) || sha256('1' || u) AS h FROM (SELECT DISTINCT u FROM units)),
bytes AS (
  SELECT u, 30 * g + b AS lane, CAST('0x' || substr(h, 64 * g + 2 * b + 1, 2) AS BIGINT) AS v
  FROM hashed, (SELECT unnest(range(2)) AS g), (SELECT unnest(range(30)) AS b)),
sums AS (
  SELECT t, lane, sum(v) % 4294967296 AS s, count(*) AS n FROM units JOIN bytes USING (u) GROUP BY t, lane),
prints AS (
  SELECT t, max(n) AS n, list(s ORDER BY lane) AS lanes, string_agg(printf('%08x', CAST(s AS BIGINT)), '' ORDER BY lane) AS hexes
  FROM sums GROUP BY t),
fp AS (
  SELECT t, coalesce(n, 0) AS n, coalesce(lanes, list_transform(range(60), lambda x: 0)) AS lanes,
         coalesce(n, 0) || ':' || coalesce(hexes, repeat('0', 480)) AS txt
  FROM texts LEFT JOIN prints USING (t)),
cen AS (SELECT t, n, txt, list_transform(lanes, lambda x: CAST(2 * x - 255 * n AS DOUBLE)) AS x FROM fp),
pairs AS (
  SELECT e.doc_id, e.n AS n_chars, e.et, a.txt AS fa, b.txt AS fb, a.x AS xa, b.x AS xb, c.x AS xc,
         a.n AS na, b.n AS nb, c.n AS nc, c.txt AS fc
  FROM e JOIN cen a ON a.t = e.t JOIN cen b ON b.t = e.et JOIN cen c ON c.t = e.nt)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(et) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
  CASE WHEN fa = fb THEN 1.0 WHEN na = 0 OR nb = 0 THEN 0.0
       ELSE round(greatest(0.0, list_inner_product(xa, xb) / (sqrt(list_inner_product(xa, xa)) * sqrt(list_inner_product(xb, xb)))), 6)
  END AS near_edited,
  CASE WHEN fa = fc THEN 1.0 WHEN na = 0 OR nc = 0 THEN 0.0
       ELSE round(greatest(0.0, list_inner_product(xa, xc) / (sqrt(list_inner_product(xa, xa)) * sqrt(list_inner_product(xc, xc)))), 6)
  END AS near_next
FROM pairs
"""

OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') AS esc,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_last
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + length(role) + length(': ') + length(esc) + length('</turn>') + 1) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
                WHEN before = 'user' THEN role = 'assistant' ELSE before = 'assistant' AND role = 'user' END)
    AND bool_or(from_last = 1 AND role = 'assistant') AS valid
FROM e GROUP BY conv_id
"""

OP10 = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
m AS (SELECT d, max(page_id) AS newest FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN newest <> page_id THEN newest END AS refers_to
FROM p LEFT JOIN m ON m.d = p.d
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS words FROM documents),
s AS (SELECT doc_id, words, CAST(len(words) AS INT) AS m, CAST(least(5, len(words)) AS INT) AS k FROM w WHERE len(words) > 0),
g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, words, k, unnest(range(1, m - k + 2)) AS i FROM s)),
n AS (SELECT doc_id, count(*) AS c FROM g GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS z FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y, z = nx.c AND z = ny.c AS same
  FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE z >= 0.8 * (nx.c + ny.c - z) - 1e-9),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
classes AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
counts AS (SELECT x AS doc_id, count(*) AS n_links, min(CASE WHEN same THEN y END) AS copy FROM links GROUP BY x)
SELECT doc_id, class_id, least(doc_id, coalesce(copy, doc_id)) AS copy_id, coalesce(n_links, 0) AS n_links
FROM classes LEFT JOIN counts USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM s),
f AS (SELECT doc_id, term, count(*) AS tf FROM d SEMI JOIN q USING (term) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
p AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS part
  FROM f JOIN s USING (doc_id) JOIN w USING (term), c),
r AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY item_id ORDER BY sum(part) DESC, doc_id) AS rank
  FROM q JOIN p USING (term) GROUP BY item_id, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

OP13 = r"""
WITH RECURSIVE tab(k, step, v) AS (
  SELECT CAST(k AS BIGINT), 0, CAST(k AS BIGINT) FROM range(256) t(k)
  UNION ALL SELECT k, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM tab WHERE step < 8),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, i, v) AS (
  SELECT DISTINCT conv_id, 0, 4294967295 FROM t
  UNION ALL
  SELECT conv_id, i + 1, xor(crc.v // 256, tab.v) FROM crc JOIN tab
    ON step = 8 AND i < length(CAST(conv_id AS VARCHAR))
       AND k = xor(crc.v % 256, CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT))),
heads AS (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = length(CAST(conv_id AS VARCHAR))),
rebuilt AS (
  SELECT heads.conv_id AS c, 0 AS part, pos, role, text FROM heads JOIN t ON t.conv_id = heads.conv_id - heads.conv_id % 20 AND pos <= h
  UNION ALL SELECT heads.conv_id, 1, pos, role, text FROM heads JOIN t USING (conv_id) WHERE pos > h),
listed AS (
  SELECT conv_id AS c, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS l
  FROM heads LEFT JOIN rebuilt ON c = conv_id GROUP BY conv_id),
prefixes AS (SELECT c, d, l[1:d] AS p, len(l) AS size FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM listed)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n, max(size) = d AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS words,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '')) AS ends
  FROM prefixes GROUP BY d, p)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth,
  (SELECT q.conv_id FROM nodes q WHERE q.d = g.d - 1 AND q.p = g.p[1:g.d - 1]) AS parent_conv_id,
  g.n AS n_convs, count(*) FILTER (x.d = g.d + 1) AS n_children, count(*) FILTER (x.leaf) AS n_leaves,
  CAST(sum((x.n - 1) * x.words) AS BIGINT) AS saved_tokens, g.ends AS ends_sha256,
  CASE WHEN g.d > 0 THEN r.ref[1] END AS turn_conv_id, CASE WHEN g.d > 0 THEN r.ref[2] END AS turn_pos
FROM nodes g JOIN nodes x ON x.d >= g.d AND x.p[1:g.d] = g.p
  LEFT JOIN (
    SELECT p, min([src, place]) AS ref FROM (
      SELECT p, CASE WHEN d <= k THEN c - c % 20 ELSE c END AS src, CASE WHEN d <= k THEN d ELSE d - k + h END AS place
      FROM prefixes JOIN heads ON heads.conv_id = c
        JOIN (SELECT conv_id AS c, (SELECT count(*) FROM rebuilt r WHERE r.c = heads.conv_id AND part = 0) AS k FROM heads) USING (c))
    GROUP BY p) r ON r.p = g.p
GROUP BY ALL
"""
