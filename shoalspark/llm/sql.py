"""DuckDB SQL for the operators that SQL can express."""

from .secrets import KINDS, PLACEHOLDER
from .sql_conversations import OP11

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
b AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g
  FROM a),
e AS (SELECT row_number() OVER () AS row_id, * FROM b),
x AS (SELECT row_id, unnest(g) AS win, unnest(range(1, len(g) + 1)) AS i FROM e),
d AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS c FROM x) WHERE c > 1),
p AS (SELECT DISTINCT row_id, i + k AS pos FROM d, range(0, 3) t(k)),
r AS (SELECT row_id, count(*) AS n FROM p GROUP BY row_id),
m AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM e LEFT JOIN r USING (row_id)),
f AS (
  SELECT *, (n_words < 50)::BIGINT | ((100 * n_repeat_words > 50 * n_words)::BIGINT << 1) | ((10 * n_symbols > word_chars)::BIGINT << 2)
    | ((n_dup_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines)::BIGINT << 3) | ((n_words > 0 AND word_chars < 2 * n_words)::BIGINT << 4)
    | ((word_chars > 25 * n_words)::BIGINT << 5) | ((n_words = 0)::BIGINT << 6) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits & 127 = 0 AS kept, fail_bits FROM f
"""


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(kind: str, order: int) -> str:
    pattern, group, least = KINDS[kind]
    return f"""SELECT row_id, '{kind}' AS kind, {order} AS ord, unnest(regexp_extract_all(text, {_q(pattern)}, 0)) AS m,
  unnest(regexp_extract_all(text, {_q(pattern)}, {group})) AS v, unnest(string_split_regex(text, {_q(pattern)})[:-2]) AS g,
  unnest(range(len(regexp_extract_all(text, {_q(pattern)}, 0)))) AS i, {least} AS least FROM t"""


OP2 = f"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS owner, coalesce(source, chr(1)) || '/' || coalesce(lang, chr(1)) AS repo FROM documents),
h AS ({" UNION ALL ".join(_kind(k, i) for i, k in enumerate(KINDS))}),
s AS (SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY row_id, kind ORDER BY i))::BIGINT AS stop FROM h),
k AS (SELECT row_id, kind, ord, stop - length(m) AS start, stop, v,
        NOT regexp_matches(v, {_q(PLACEHOLDER)}) AND length(v) >= 16 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
        AND len(list_distinct(string_split(v, ''))) >= 8 AS live FROM s WHERE length(v) >= least),
o AS (SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT repo) AS n_repos FROM k JOIN t USING (row_id) GROUP BY v),
j AS (SELECT row_id,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans,
        count(*) FILTER (live AND n_owners <= 1 AND n_repos <= 3) AS n_live, count(*) FILTER (n_owners > 1 OR n_repos > 3) AS n_copied, max(n_owners) AS max_owners, max(n_repos) AS max_repos
      FROM k JOIN o USING (v) GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, max_owners, max_repos
FROM t LEFT JOIN j USING (row_id)
"""

OP6 = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
k AS (SELECT *, -ln((('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(source, chr(1114111)) || '|' || size), 1, 13))::BIGINT + 0.5::DOUBLE) / pow(16, 13))
        / ((size + 1)::DOUBLE / (size + 51)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY coalesce(source, chr(1114111))) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER o, 0))::DOUBLE / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER o, 0))::DOUBLE AS share
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, coalesce(source, chr(1114111)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(cap::DOUBLE, w * (SELECT max(share) FROM l WHERE cap::DOUBLE / w >= share)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
p AS (SELECT k.*, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT f.*, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, c.k, c.w, c.a, min({'score': (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT, 'cut': i, 'l': x.a, 'r': y.a}) AS m
    FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:], ' ')
    GROUP BY ALL),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
r AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY m.score DESC, a DESC, s.phrase) AS rank FROM s LEFT JOIN inside USING (lang, phrase)
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, m.l AS l, m.r AS r, n, m.score AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES = {"op1_quality_rules": OP1, "op2_secret_scan": OP2, "op6_warc": OP6, "op10_mixing": OP10, "op11_conversation_repair": OP11, "op13_collocations": OP13}
