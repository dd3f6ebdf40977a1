"""DuckDB SQL for the queries that SQL can express, written from the contracts and not from the operators."""

A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

CONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, {A_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, {A_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.key = bw.key),
words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

URLS = rf"""
WITH RECURSIVE p AS (
  SELECT row_number() OVER () AS rid, page_id, url, html,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {A_Z}), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(rh, rp, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                 ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
seen AS (SELECT url, regexp_replace(html, '(?s)<!--.*?(-->|$)', '', 'g') AS html FROM p),
targets AS (
  SELECT url, regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*[\s"''/]rel\s*=\s*["'']?canonical\b[^>]*>'), '(?i)[\s"''/]href\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM seen
  UNION ALL
  SELECT url, regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*[\s"''/]http-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?i)[\s"'';,]url\s*=\s*["'']?([^"''\s>]+)', 1) FROM seen),
parsed AS (
  SELECT url, replace(t, '&amp;', '&') AS t, split_part(url, '://', 1) AS scheme, regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS site,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS own FROM targets WHERE t <> '' AND contains(url, '://')),
whole AS (
  SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN t
                   WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN NULL
                   WHEN t[1:2] = '//' THEN scheme || ':' || t
                   WHEN t[1] = '/' THEN scheme || '://' || site || t
                   WHEN t[1] = '#' THEN regexp_extract(url, '^[^#]*') || t
                   WHEN t[1] = '?' THEN scheme || '://' || site || own || t
                   ELSE scheme || '://' || site || CASE WHEN contains(own, '/') THEN regexp_extract(own, '^(.*/)', 1) ELSE '/' END || t END AS t
  FROM parsed),
pieces AS (
  SELECT url, regexp_extract(t, '(?s)^.*?://[^/?#]*') AS front, regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS way,
         regexp_extract(t, '(?s)^.*?://[^?#]*(.*)$', 1) AS tail FROM whole WHERE t IS NOT NULL),
links AS (
  SELECT url, front || CASE WHEN regexp_matches(way, '/[.]{{1,2}}(/|$)') THEN
      list_reduce(list_prepend('', string_split(substr(way, 2), '/')),
                  lambda a, s: CASE s WHEN '.' THEN a WHEN '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || s END)
      || CASE WHEN regexp_matches(way, '/[.]{{1,2}}$') THEN '/' ELSE '' END ELSE way END || tail AS target FROM pieces),
raw AS (SELECT url AS x, target AS y FROM links UNION ALL SELECT target, url FROM links),
edges AS (
  SELECT DISTINCT translate(regexp_extract(x, '(?s)^.*?://([^/?#]*)', 1), {A_Z}) || regexp_extract(x, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS a,
         translate(regexp_extract(y, '(?s)^.*?://([^/?#]*)', 1), {A_Z}) || regexp_extract(y, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b FROM raw),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
nodes AS (SELECT DISTINCT a AS node, regexp_extract(a, '^[^/?#]*') AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM edges),
every AS (SELECT host, path FROM nodes UNION SELECT host, path FROM p),
best AS (
  SELECT host, path, rh || rp AS rule, action FROM every JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rh || rp) DESC, length(rh) DESC, action) = 1),
fate AS (
  SELECT reach.a AS node FROM reach JOIN nodes ON reach.b = nodes.node LEFT JOIN best USING (host, path)
  GROUP BY reach.a HAVING bool_or(coalesce(action = 'block', false)) AND NOT bool_or(coalesce(action = 'allow', false)))
SELECT page_id, p.host, p.path, rule,
       coalesce(action, CASE WHEN EXISTS (SELECT 1 FROM fate WHERE fate.node = p.host || regexp_extract(p.url, '(?s)^.*?://[^/?#]*([^#]*)', 1))
                             THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
"""

#: crc32 of a list of byte values, bit by bit (a macro body; the polynomial is CRC-32's)
_CRC = ("xor(4294967295, list_reduce(flatten(list_transform({b}, lambda v: [v, 0, 0, 0, 0, 0, 0, 0])), "
        "lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1)), CAST(4294967295 AS BIGINT)))").format

PREFIX_TRIE = rf"""
WITH own AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos
  FROM (SELECT conv_id, turn, role, text, substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32) AS digest
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))),
ids AS (
  SELECT conv_id, {_CRC(b="list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT i.conv_id, 0 AS half, o.pos, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 100 AND o.pos <= h
  UNION ALL SELECT i.conv_id, 1, o.pos, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > h),
chain AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS points,
         list(sha256(octet_length(encode(role)) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY half, pos ROWS UNBOUNDED PRECEDING) AS node
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY half, pos)),
walk AS (SELECT conv_id, 0 AS depth, 0 AS points, CAST([] AS VARCHAR[]) AS node FROM ids UNION ALL SELECT * FROM chain),
lens AS (SELECT conv_id, max(depth) AS len FROM walk GROUP BY conv_id),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(points) AS points,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = len), '') AS ends
  FROM walk JOIN lens USING (conv_id) GROUP BY node),
kids AS (SELECT node[:len(node) - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
flat AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
sums AS (
  SELECT w.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.points) AS saved
  FROM flat f JOIN walk w ON w.conv_id = f.conv_id AND w.depth <= f.depth GROUP BY w.node)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM flat f JOIN sums s USING (node) LEFT JOIN nodes p ON f.depth > 0 AND p.node = f.node[:len(f.node) - 1]
"""

SHARDS = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum FROM documents),
x AS (
  SELECT doc_id, octet_length(encode(text)) + 1 AS size, stratum,
         {_CRC(b="list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda d: CAST('0x' || d AS BIGINT))")} AS crc FROM t),
y AS (
  SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS name, CAST('0x' || substr(md5('interleave:' || stratum), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS phase FROM x),
r AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('interleave:' || name || ':' || CAST(crc AS VARCHAR)), doc_id NULLS FIRST, size) AS rank,
         count(*) OVER (PARTITION BY stratum) AS n FROM y),
p AS (SELECT *, row_number() OVER (ORDER BY (rank - 1 + phase) / n, stratum, rank) - 1 AS place, count(*) OVER () AS total FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(place * 16 // total AS INTEGER) AS shard,
       CAST(place - (place * 16 // total * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""

DIVERGENCES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
words AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(*) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM words GROUP BY ALL) c USING (lang, source, term)),
own AS (
  SELECT lang, source, term, n, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
  FROM counts JOIN vocabulary USING (lang)),
whole AS (
  SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN vocabulary USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM grp g JOIN grp o ON g.lang = o.lang AND g.source <> o.source LEFT JOIN pairs x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""


def _list(words) -> str:
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


def quality_rules(common: dict, classes, max_char: float, min_chars: int, max_word: float, min_words: int) -> str:
    """The rules' lists and limits are parameters of the method; the rest is stated here anew."""
    n = len(next(iter(common.values())))
    case = " ".join(f"WHEN lang = '{k}' THEN {_list(v)}" for k, v in common.items())
    known = ", ".join(f"'{k}'" for k in common)
    steps, prev = [], "t"
    for k, (name, pattern) in enumerate(classes):
        quoted = pattern.replace("'", "''")
        steps.append(f"s{k} AS (SELECT *, regexp_replace({prev}, '{quoted}', '', 'g') AS l{k} FROM {'x' if k == 0 else f's{k - 1}'})")
        prev = f"l{k}"
    sizes = ["length(t)"] + [f"length(l{k})" for k in range(len(classes))]
    chars = ", ".join([f"{a} - {b}" for a, b in zip(sizes, sizes[1:])] + [sizes[-1]])
    js = ("sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: "
          "CASE WHEN {p}[i] > 0 THEN {p}[i] / list_sum({p}) * ln(2 * {p}[i] / list_sum({p}) / ({p}[i] / list_sum({p}) + {q}[i] / list_sum({q}))) ELSE 0 END"
          " + CASE WHEN {q}[i] > 0 THEN {q}[i] / list_sum({q}) * ln(2 * {q}[i] / list_sum({q}) / ({p}[i] / list_sum({p}) + {q}[i] / list_sum({q}))) ELSE 0 END"
          ")) / (2 * ln(2))))").format
    return rf"""
WITH x AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({known}) THEN lang ELSE '' END AS lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
{", ".join(steps)},
f AS (SELECT rid, doc_id, lang, t, w, CAST([{chars}] AS DOUBLE[]) AS chars, CAST({sizes[1]} AS BIGINT) AS word_chars,
             CASE {case} ELSE [] END AS own FROM s{len(classes) - 1}),
h AS (SELECT *, list_transform(own, lambda c: CAST(len(list_filter(w, lambda y: y = c OR y = upper(c[1]) || c[2:])) AS DOUBLE)) AS counts FROM f),
g AS (SELECT *, CASE WHEN len(own) = 0 THEN list_resize(CAST([] AS DOUBLE[]), {n}, 0.0) || [CAST(len(w) AS DOUBLE)]
                     ELSE counts || [len(w) - list_sum(counts)] END AS common FROM h),
refs AS (
  SELECT lang, list(total ORDER BY k) AS ref_chars FROM
    (SELECT lang, k, sum(chars[k]) AS total FROM (SELECT lang, chars, unnest(range(1, {len(classes) + 2})) AS k FROM g WHERE lang <> ''
       UNION ALL SELECT '' AS lang, chars, unnest(range(1, {len(classes) + 2})) AS k FROM g) GROUP BY lang, k) GROUP BY lang),
refw AS (
  SELECT lang, list(total ORDER BY k) AS ref_words FROM
    (SELECT lang, k, sum(common[k]) AS total FROM (SELECT lang, common, unnest(range(1, {n + 2})) AS k FROM g WHERE lang <> '') GROUP BY lang, k)
  GROUP BY lang),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM x)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
grams AS (SELECT rid, i, w[i:i + 4] AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM x)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_rep FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
z AS (
  SELECT g.*, len(w) AS n, coalesce(n_dup, 0) AS n_dup, coalesce(n_rep, 0) AS n_rep,
         CASE WHEN length(t) > 0 THEN {js(p='chars', q='ref_chars')} END AS dc,
         CASE WHEN g.lang <> '' AND len(w) > 0 THEN {js(p='common', q='ref_words')} END AS dw
  FROM g LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN refs ON g.lang = refs.lang LEFT JOIN refw ON g.lang = refw.lang)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, word_chars, CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
       CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
       n < 10 OR 100 * n_rep > 20 * n AS base_failed,
       NOT (n < 10 OR 100 * n_rep > 20 * n) AND (length(t) < {min_chars} OR dc <= {max_char})
         AND (lang = '' OR n < {min_words} OR dw <= {max_word}) AS kept
FROM z
"""
