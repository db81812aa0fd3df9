"""SQL for the URL rules, the Merkle manifest and the prefix trie, straight from their definitions."""

from __future__ import annotations

# Fixed value: the reversed polynomial of CRC-32.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: xor(c >> 1, CAST(3988292384 AS UBIGINT) * (c & 1)))) AS t
)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text; ``t`` is the table's list."""
    codes = f"list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS UBIGINT)))"
    return f"xor(list_reduce({codes}, lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT))"


# The rules of the query.
OP11 = """WITH rules(rule, rule_host, rule_path, action) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
),
rests AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule) DESC) = 1"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}) || ':' || {name}, '-')"


def _leaf(n_chars: str) -> str:
    names = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return f"sha256({' || '.join(map(_field, names))})"


def _levels(source: str, name: str) -> str:
    """All nodes above ``source`` (grp, pos, h), level by level."""
    return f"""{name} AS (
  SELECT grp, 0 AS level, pos, h FROM {source}
  UNION ALL
  SELECT grp, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}) m WHERE n > 1 GROUP BY grp, level, pos // 2
)"""


def _steps(source: str, nodes: str, name: str) -> str:
    """For each of ``source`` its siblings in order: marked with the side they stand on, or a dash for none."""
    return f"""{name} AS (
  SELECT s.grp, s.pos, list(CASE WHEN n.h IS NULL THEN '-' WHEN n.pos % 2 = 0 THEN 'L' || n.h ELSE 'R' || n.h END ORDER BY s.level) AS steps
  FROM (SELECT p.grp, p.pos, unnest(range(0, top)) AS level FROM {source} p JOIN (SELECT grp, max(level) AS top FROM {nodes} GROUP BY grp) t ON t.grp = p.grp) s
  LEFT JOIN {nodes} n ON n.grp = s.grp AND n.level = s.level AND n.pos = xor(s.pos >> s.level, 1) GROUP BY s.grp, s.pos
)"""


OP12 = f"""WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS h,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS start
  FROM documents, crc_table
),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM hashed),
{_levels("leaves", "nodes")},
{_steps("leaves", "nodes", "own")},
subroots AS (SELECT grp AS lang, '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, h FROM (SELECT grp, arg_max(h, level) AS h FROM nodes GROUP BY grp) m),
{_levels("subroots", "tops")},
{_steps("subroots", "tops", "above")},
proofs AS (
  SELECT l.doc_id, l.h AS leaf, l.start, s.h AS subroot, (SELECT arg_max(h, level) FROM tops) AS root,
    list_concat(coalesce(own.steps, []), coalesce(above.steps, [])) AS steps
  FROM leaves l LEFT JOIN own ON own.grp = l.grp AND own.pos = l.pos JOIN subroots s ON s.lang = l.grp LEFT JOIN above ON above.pos = s.pos
),
folded AS (
  SELECT *, list_reduce(list_prepend(start, steps), lambda a, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded"""

OP13 = f"""WITH {_CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
original AS (
  SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS k,
    list(length(text) ORDER BY turn NULLS FIRST, role, text) AS n
  FROM turns GROUP BY conv_id
),
named AS (SELECT o.*, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM original o, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.k, [])[1 : c.h], c.k[c.h + 1 :]) AS k, list_concat(coalesce(b.n, [])[1 : c.h], c.n[c.h + 1 :]) AS n
  FROM named c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (
  SELECT conv_id, d, k[1 : d] AS p, array_to_string(k[1 : d], '') AS node, CASE WHEN d > 0 THEN array_to_string(k[1 : d - 1], '') END AS parent,
    CASE WHEN d > 0 THEN n[d] ELSE 0 END AS last_chars, d = len(k) AS ends
  FROM (SELECT *, unnest(range(0, len(k) + 1)) AS d FROM rebuilt) r
),
nodes AS (
  SELECT node, any_value(p) AS p, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
    (count(*) - 1) * any_value(last_chars) AS saved, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node
),
kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
sums AS (
  SELECT array_to_string(p[1 : a], '') AS node, sum(saved) AS saved, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes) x LEFT JOIN kids k ON k.parent = x.node GROUP BY 1
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.parent = n.node LEFT JOIN nodes up ON up.node = n.parent"""
