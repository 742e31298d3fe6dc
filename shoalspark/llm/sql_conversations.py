"""DuckDB SQL of the conversation repair: checksums bit by bit, and cheapest edits by a recursive query over the rows."""

OP11 = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT src.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS f FROM src, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE f <> 0),
rows AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt),
seen AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS b, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS d,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS t, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows),
kinds AS (SELECT *, CASE WHEN b THEN 'blank' WHEN d THEN 'duplicate' WHEN t THEN 'truncated' ELSE 'none' END AS fault FROM seen),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank')::BIGINT AS blank,
    count_if(fault = 'duplicate')::BIGINT AS duplicate, count_if(fault = 'truncated')::BIGINT AS truncated,
    count_if(before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, max(i) AS n FROM kinds GROUP BY conv_id),
ins(a, b, cost, label) AS (VALUES (0,0,0,''), (1,1,0,''), (2,2,0,''), (3,3,0,''), (0,2,5,'I'), (0,3,10,'II'), (1,2,5,'I'), (1,3,10,'II'), (2,3,5,'I'), (2,2,10,'II'), (3,2,5,'I'), (3,3,10,'II')),
edit(a, b, label, ini) AS (VALUES (0,1,'K','s'), (0,2,'K','u'), (1,2,'K','u'), (2,3,'K','a'), (3,2,'K','u'), (0,2,'R',NULL), (1,2,'R',NULL), (2,3,'R',NULL), (3,2,'R',NULL),
    (0,0,'D',NULL), (1,1,'D',NULL), (2,2,'D',NULL), (3,3,'D',NULL)),
arc AS (SELECT ins.a, edit.b, ins.cost, ins.label || edit.label AS labels, edit.label, edit.ini FROM ins JOIN edit ON edit.a = ins.b),
path AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit FROM stats
    UNION ALL SELECT conv_id, i, b AS state, best.cost, best.audit FROM (
    SELECT p.conv_id, k.i, a.b, min({'cost': p.cost + a.cost + CASE a.label WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN a.label <> 'D' AND k.fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': p.audit || a.labels}) AS best
    FROM path p JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.i = p.i + 1 JOIN arc a ON a.a = p.state AND (a.label = 'D' OR (k.fault NOT IN ('blank', 'duplicate') AND (a.ini IS NULL OR a.ini = k.ini)))
    GROUP BY p.conv_id, k.i, a.b)),
ends AS (SELECT p.conv_id, min({'cost': p.cost + ins.cost, 'audit': p.audit || ins.label}) AS best FROM path p JOIN stats s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = s.n
    JOIN ins ON ins.a = p.state AND ins.b IN (0, 3) GROUP BY p.conv_id),
steps AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS e, unnest(range(1, length(best.audit) + 1)) AS p FROM ends WHERE best.audit <> ''),
taken AS (SELECT *, count_if(e <> 'I') OVER w AS i, count_if(e <> 'D') OVER w AS o FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
made AS (SELECT t.*, k.role, k.text, bool_or(t.e = 'K' AND t.o = 1 AND k.ini = 's') OVER (PARTITION BY t.conv_id) AS sys
    FROM taken t LEFT JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM t.conv_id AND k.i = t.i AND t.e <> 'I' WHERE t.e <> 'D'),
lines AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (o - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h
    FROM made GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""
