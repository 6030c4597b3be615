"""DuckDB SQL of the queries that SQL can express: the plain definitions, without the operators' methods."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text: each byte is folded in, then eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, x: {step}), 4294967295)"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MANIFEST_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS changed, doc_id IS NOT NULL AND {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 AS bad
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
levels AS (
  SELECT lang, 0 AS level, pos, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos)) FROM levels WHERE n > 1 GROUP BY lang, level, pos // 2, n),
subroots AS (
  SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
climb AS (
  SELECT lang, pos AS leaf_pos, 0 AS level, pos, n, CASE WHEN bad THEN changed ELSE leaf END AS hash, '' AS proof FROM leaves
  UNION ALL
  SELECT c.lang, leaf_pos, c.level + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 0 THEN c.hash || coalesce(s.hash, '') ELSE s.hash || c.hash END), c.proof || coalesce(s.hash, '')
  FROM climb c LEFT JOIN levels s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
higher AS (
  SELECT c.lang, leaf_pos, 0 AS level, r.pos, r.n, c.hash, c.proof FROM climb c JOIN subroots r ON r.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.lang, leaf_pos, c.level + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 0 THEN c.hash || coalesce(s.hash, '') ELSE s.hash || c.hash END), c.proof || coalesce(s.hash, '')
  FROM higher c LEFT JOIN tops s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
SELECT l.doc_id, l.leaf, r.hash AS subroot, t.hash AS root, sha256(h.proof) AS proof_sha256, h.hash AS folded_root, h.hash = t.hash AS verified
FROM leaves l JOIN higher h ON h.n = 1 AND h.leaf_pos = l.pos AND h.lang IS NOT DISTINCT FROM l.lang
JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN tops t ON t.n = 1"""


_TURN = "coalesce(role, '') AS role, coalesce(text, '') AS text"

TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, {_TURN}, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS head, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.head AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
paths AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, pos) AS path FROM rebuilt GROUP BY conv_id
  UNION ALL
  SELECT conv_id, [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)),
steps AS (SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path FROM paths),
nodes AS (
  SELECT depth, path[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(any_value(path[depth].text), '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM steps GROUP BY depth, path[1:depth]),
children AS (SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)),
subtrees AS (
  SELECT up.depth, up.node, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.words) AS saved_tokens
  FROM counted up JOIN counted below ON below.depth >= up.depth AND below.node[1:up.depth] = up.node GROUP BY up.depth, up.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM counted n JOIN subtrees s USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]"""
