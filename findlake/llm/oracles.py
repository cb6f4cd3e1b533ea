"""The same results in DuckDB SQL, by plain joins and counts. Constants are stated again here."""

from __future__ import annotations

URL_FILTER = r"""
WITH urls AS (
  SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url, rest,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS query
  FROM urls),
forms AS (
  SELECT *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=&]*|ref)(=|$)'))) AS params
  FROM parts),
named AS (
  SELECT page_id, url, host, path,
    CASE WHEN rest IS NOT NULL THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS form
  FROM forms),
listed AS (SELECT DISTINCT form FROM named WHERE form IS NOT NULL AND regexp_matches(url, '[?&]utm_[^#]*')),
rules AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) r(action, site, start)),
best AS (
  SELECT page_id, host, path, form, arg_max(site || start, length(site || start)) AS rule,
    arg_max(action, length(site || start)) AS action
  FROM (SELECT n.*, r.* FROM named n LEFT JOIN rules r
        ON (n.host = r.site OR ends_with(n.host, '.' || r.site)) AND starts_with(n.path, r.start))
  GROUP BY ALL)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN form IN (SELECT form FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  rule IS NULL AND coalesce(form IN (SELECT form FROM listed), false) AS listed
FROM best
"""

# Order, kind, pattern, group whose length counts, least length.
SECRET_RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
]


def _secret_index() -> str:
    each = []
    for order, (kind, pattern, group, least) in enumerate(SECRET_RULES):
        quoted = "'" + pattern.replace("'", "''") + "'"
        each.append(
            f"SELECT doc_id, {order} AS o, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, {quoted}, 0) AS m, "
            f"regexp_extract_all(text, {quoted}, {group}) AS g, string_split_regex(text, {quoted}) AS b FROM docs"
        )
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(each)}),
placed AS (
  SELECT doc_id, o, kind, length(g[i]) >= least AS counts, length(m[i]) AS n,
    length(array_to_string(b[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)),
spans AS (SELECT doc_id, o, s, kind || ':' || s || ':' || (s + n) AS span FROM placed WHERE counts)
SELECT d.doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, o) FILTER (o < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, o), '') AS spans
FROM docs d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
"""


QUALITY_RULES = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, source,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)),
twins AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twins) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN repeats r USING (doc_id)),
each AS (
  SELECT doc_id, source, md5(body) AS t, md5(x) AS line, len(w) AS n,
    list_distinct(list_transform(range(0, len(w), greatest(least(4, (len(w) + 2) // 3), (len(w) + 9) // 10)),
      lambda i: md5(array_to_string(w[i + 1 : i + greatest(least(4, (len(w) + 2) // 3), (len(w) + 9) // 10)], ' ')))) AS blocks
  FROM (SELECT doc_id, source, body, x, string_split(x, ' ') AS w
        FROM (SELECT doc_id, source, text AS body, trim(regexp_replace(lower(unnest(lines)), '[\x20\x09-\x0D]+', ' ', 'g')) AS x FROM docs))),
different AS (SELECT DISTINCT source, t, line, n, blocks FROM each),
shared AS (SELECT source, line FROM different GROUP BY ALL HAVING count(*) > 20),
beside AS (
  SELECT d.* FROM different d ANTI JOIN shared USING (source, line)
  WHERE EXISTS (SELECT 1 FROM different o JOIN shared s USING (source, line) WHERE o.t = d.t AND o.source IS NOT DISTINCT FROM d.source)),
pieces AS (SELECT source, t, line, n, unnest(blocks) AS block FROM beside),
often AS (
  SELECT source, block FROM pieces GROUP BY ALL HAVING count(DISTINCT t) > 20
  UNION SELECT source, unnest(blocks) FROM different JOIN shared USING (source, line)),
own AS (
  SELECT source, t, n, min(block) FILTER (o.block IS NULL) AS block
  FROM pieces p LEFT JOIN often o USING (source, block) GROUP BY source, t, line, n
  HAVING 100 * count(o.block) < 25 * count(*)),
marks AS (SELECT source, t, min(block) AS mark FROM own GROUP BY ALL HAVING sum(n) >= 4),
frequent AS (
  SELECT source, line FROM different JOIN shared USING (source, line) JOIN marks USING (source, t)
  GROUP BY ALL HAVING count(DISTINCT mark) > 20),
lost AS (SELECT doc_id, sum(n) AS n FROM each SEMI JOIN frequent USING (source, line) GROUP BY doc_id),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  coalesce(n, 0)::BIGINT AS n_removed_words, base_failed,
  NOT base_failed AND 100 * (n_words - coalesce(n, 0)) >= 30 * n_words AS kept
FROM failed LEFT JOIN lost USING (doc_id)
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, x, regexp_matches(x, '[^\x20\x09-\x0D]') AS held,
    trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) AS form
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
runs AS (
  SELECT doc_id, i, lead(i) OVER w AS i2, lead(i, 2) OVER w AS i3,
    form || chr(10) || lead(form) OVER w || chr(10) || lead(form, 2) OVER w AS key
  FROM lines WHERE held WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i, i2, i3 FROM runs WHERE i3 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM later)
SELECT l.doc_id, count(*) FILTER (held) AS n_lines, count(g.i) AS n_removed,
  coalesce(string_agg(x, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
FROM lines l LEFT JOIN gone g USING (doc_id, i) GROUP BY l.doc_id
"""

# The checksum of a number's digits, bit by bit (0xEDB88320 is 3988292384); prefixes are compared whole.
PREFIX_TRIE = r"""
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
codes AS (
  SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS bytes FROM own),
borrowed AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda sum, byte:
      list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda bits, step:
        CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)), 4294967295) % 4 AS h
  FROM codes),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(list_slice(d.turns, 1, h), []), list_slice(o.turns, h + 1, len(o.turns))) AS turns
  FROM own o JOIN borrowed USING (conv_id) LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 20),
starts AS (
  SELECT conv_id, d AS depth, len(turns) AS size,
    CASE WHEN d > 0 THEN md5(to_json(list_slice(turns, 1, d))::VARCHAR) ELSE '' END AS key,
    CASE WHEN d > 0 THEN len(string_split_regex(trim(turns[d].text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+'))
      - (NOT regexp_matches(turns[d].text, '[^\x20\x09-\x0D]'))::INTEGER ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM starts GROUP BY depth, key),
above AS (
  SELECT n.depth, n.key, n.n_convs, n.words, s.depth AS up, s.key AS up_key
  FROM nodes n JOIN starts s ON s.conv_id = n.conv_id AND s.depth <= n.depth),
inner_nodes AS (SELECT DISTINCT up AS depth, up_key AS key FROM above WHERE depth = up + 1),
subtrees AS (
  SELECT up AS depth, up_key AS key, count(*) FILTER (a.depth = up + 1) AS n_children,
    count(*) FILTER (i.key IS NULL) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM above a LEFT JOIN inner_nodes i USING (depth, key) GROUP BY up, up_key)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees USING (depth, key)
  LEFT JOIN above a ON a.depth = n.depth AND a.key = n.key AND a.up = n.depth - 1
  LEFT JOIN nodes p ON p.depth = a.up AND p.key = a.up_key
"""

ORACLES = {
    "op2_url_filter": URL_FILTER,
    "op3_secret_index": _secret_index(),
    "op5_quality_rules": QUALITY_RULES,
    "op6_line_dedup": LINE_DEDUP,
    "op12_prefix_trie": PREFIX_TRIE,
}
