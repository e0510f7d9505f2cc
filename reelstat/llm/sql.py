"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

_FITS = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"

OP1 = f"""
WITH located AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE WHEN {_FITS.format('example.org', '/en/1')} THEN 'example.org/en/1'
                 WHEN {_FITS.format('example.org', '/es/')} THEN 'example.org/es/'
                 WHEN {_FITS.format('com', '/fr/')} THEN 'com/fr/'
                 WHEN {_FITS.format('com', '/de/')} THEN 'com/de/'
                 WHEN {_FITS.format('org', '/')} THEN 'org/' END AS rule
  FROM located)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
e AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
g AS (SELECT rid, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g5
      FROM e WINDOW o AS (PARTITION BY rid ORDER BY pos)),
r AS (SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, g5) AS k FROM g WHERE g5 IS NOT NULL) WHERE k > 1),
c AS (SELECT rid, count(DISTINCT pos + i) AS n FROM r, range(5) AS s(i) GROUP BY rid),
f AS (SELECT d.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_n, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_n,
             length(regexp_replace(t, '[^!-@\[-`{-~]', '', 'g')) AS other_n
      FROM d JOIN w USING (rid) LEFT JOIN c USING (rid)),
m AS (SELECT *, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * len(ls) OR word_chars > 20 * n_words
            OR word_chars < 2 * n_words OR upper_n > lower_n OR 2 * other_n > word_chars) AS kept
FROM m
"""

# The CRC-32 of the decimal conversation id: eight shifts a byte under the polynomial 0xEDB88320.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12 = rf"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT ids.conv_id, 0 AS part, b.i, b.role, b.text FROM ids JOIN own b ON b.conv_id = ids.conv_id - ids.conv_id % 20 AND b.i <= h
  UNION ALL
  SELECT ids.conv_id, 1, o.i, o.role, o.text FROM ids JOIN own o ON o.conv_id = ids.conv_id AND o.i > h),
placed AS (
  SELECT conv_id, row_number() OVER w AS depth, len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
         list(length(role)::VARCHAR || ':' || role || text) OVER w AS path
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)),
member AS (
  SELECT conv_id, depth, words, sha256(array_to_string(list_transform(path, lambda x: sha256(x)), '')) AS node FROM placed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM ids),
held AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM member),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words,
         bool_and(ends) AS leaf, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM held GROUP BY node),
-- a node's ancestors lie on the path of its smallest member
above AS (
  SELECT n.node, m.node AS ancestor, m.depth = n.depth - 1 AS direct
  FROM nodes n JOIN member m ON m.conv_id = n.conv_id AND m.depth <= n.depth),
subtree AS (
  SELECT ancestor AS node, count(*) FILTER (direct) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM above JOIN nodes USING (node) GROUP BY ancestor)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtree s USING (node) LEFT JOIN above a ON a.node = n.node AND a.direct LEFT JOIN nodes p ON p.node = a.ancestor
"""


OP13 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents WHERE text IS NOT NULL),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
ws AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM ws, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS c FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_phrase AS (
  SELECT lang, a, unnest(list_transform(range(1, k - j + 2), lambda i: array_to_string(w[i:i + j - 1], ' '))) AS phrase
  FROM cand, (SELECT unnest([2, 3]) AS j) WHERE j < k),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner_phrase GROUP BY ALL),
free AS (SELECT cand.* FROM cand LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 80 * a),
cut AS (
  SELECT lang, phrase, a, x, array_to_string(w[1:x], ' ') AS lp, array_to_string(w[x + 1:k], ' ') AS rp
  FROM free, (SELECT unnest([1, 2, 3]) AS x) WHERE x < k),
s AS (
  SELECT cut.lang, cut.phrase, a, x, fl.c AS l, fr.c AS r, (2000000 * a) // (fl.c + fr.c) AS score
  FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = lp JOIN f fr ON fr.lang = cut.lang AND fr.phrase = rp),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

QUERIES: dict[str, str] = {"op1_url_filter": OP1, "op2_quality_rules": OP2, "op12_prefix_trie": OP12, "op13_collocations": OP13}


def oracle_sql() -> dict[str, str]:
    return dict(QUERIES)
