"""DuckDB SQL for the queries that SQL can express."""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: bit by bit, with the usual reflected polynomial."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    bits = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[], lambda x, _: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(a, b))"
    return f"xor(list_reduce({codes}, lambda a, b: {bits}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Trees by recursion over levels; each leaf then climbs its path.
MERKLE = f"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS src, {_leaf("text")} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf("text")} END AS changed
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY src) AS n FROM docs
),
nodes(src, lvl, idx, digest, n) AS (
  SELECT src, 0, idx, leaf, n FROM leaves
  UNION ALL
  SELECT src, max(lvl) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16 FROM nodes WHERE n > 1 GROUP BY src, idx // 16
),
subroots AS (SELECT src, digest, row_number() OVER (ORDER BY src) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, digest, n) AS (
  SELECT 0, idx, digest, n FROM subroots
  UNION ALL
  SELECT max(lvl) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16 FROM tops WHERE n > 1 GROUP BY idx // 16
),
sides AS (
  SELECT src, lvl, idx, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY src, lvl, idx // 16 ORDER BY idx)
),
top_sides AS (
  SELECT lvl, idx, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY lvl, idx // 16 ORDER BY idx)
),
steps AS (
  SELECT l.src, l.idx, s.lvl, s.before, s.after FROM leaves l JOIN sides s ON l.src = s.src AND s.idx = l.idx // (16 ** s.lvl)::BIGINT
  UNION ALL
  SELECT l.src, l.idx, 1000 + s.lvl, s.before, s.after FROM leaves l JOIN subroots r ON l.src = r.src JOIN top_sides s ON s.idx = r.idx // (16 ** s.lvl)::BIGINT
),
path AS (SELECT *, row_number() OVER (PARTITION BY src, idx ORDER BY lvl) AS k FROM steps),
proofs AS (SELECT src, idx, sha256(string_agg(before || after, '' ORDER BY k)) AS proof, max(k) AS last FROM path GROUP BY src, idx),
folds(src, idx, k, digest) AS (
  SELECT src, idx, 0::BIGINT, changed FROM leaves
  UNION ALL
  SELECT f.src, f.idx, p.k, sha256(p.before || f.digest || p.after) FROM folds f JOIN path p ON f.src = p.src AND f.idx = p.idx AND p.k = f.k + 1
)
SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM leaves l JOIN subroots r ON l.src = r.src JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
LEFT JOIN proofs p ON l.src = p.src AND l.idx = p.idx
JOIN folds f ON l.src = f.src AND l.idx = f.idx AND f.k = coalesce(p.last, 0)
"""

#: Every beginning of every rebuilt conversation as a list; subtrees by comparing beginnings.
TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h, list({{'role': role, 'text': text}} ORDER BY k) AS own FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
),
begun AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256,
         CASE WHEN depth > 0 THEN (count(*) - 1) * strlen(max(turns[depth].text)) ELSE 0 END AS own
  FROM begun GROUP BY 1, 2
),
kids AS (SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children FROM nodes n),
sums AS (
  SELECT n.path, sum(q.own) AS saved, count(*) FILTER (q.n_children = 0) AS leaves
  FROM kids n JOIN kids q ON q.depth >= n.depth AND q.path[1:n.depth] = n.path GROUP BY n.path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM kids n JOIN sums s ON n.path = s.path LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND n.path[1:p.depth] = p.path
"""
