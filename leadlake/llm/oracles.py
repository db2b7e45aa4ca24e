"""DuckDB texts that state the expected rows of queries by another route than the operators."""

from __future__ import annotations

from leadlake.llm import secrets, sharding as placing
from leadlake.llm.quality import STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

#: Repeated windows by grouping unnested windows; lines and words by unnesting as well.
QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM split WHERE len(ws) >= 8)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid),
line AS (
  SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT l) AS d FROM line GROUP BY rid),
stats AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '!')) AS n_bangs,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOPS}))) AS n_stop,
         coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.d, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
         AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words
         AND 100 * n_symbols <= 15 * n_words AND 2 * n_bangs <= n_words
         AND (n_words < 40 OR 100 * n_stop >= 4 * n_words) AND 2 * n_dup_lines <= n_lines AS kept
FROM stats
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _hits(kind: int, pattern: str, keep: str) -> str:
    p = _quoted(pattern)
    return f"""
SELECT rid, {kind} AS kind, start, start + length(hit) AS stop FROM (
  SELECT rid, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY i) - length(hit) AS start FROM (
    SELECT rid, i, gaps[i] AS gap, hits[i] AS hit FROM (
      SELECT rid, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT rid, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS hits FROM docs))))
WHERE {keep}"""


_PARTS = " UNION ALL ".join(_hits(*x) for x in (
    (0, secrets.ASSIGN, f"length(regexp_extract(hit, {_quoted('^' + secrets.ASSIGN)}, 2)) >= 6"),
    (1, secrets.ACCESS, "length(hit) >= 20"),
    (2, secrets.HEX, "length(hit) >= 24"),
    (3, secrets._BLOB, "length(hit) = 40 AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')"),
    (4, secrets._NAME, "true"),
    (5, secrets._ENDPOINT, "true")))
_KIND = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS)) + " END"
_SPAN = f"{_KIND} || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR)"

#: Two parts share a scope when their cells are the same or adjacent; an endpoint needs both roles in one of its scopes.
SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, start // {secrets.REACH} AS cell FROM ({_PARTS})),
ids AS (SELECT DISTINCT rid, cell FROM parts WHERE kind IN (1, 4)),
keys AS (SELECT DISTINCT rid, cell FROM parts WHERE kind IN (0, 2, 3)),
shown AS (
  SELECT * FROM parts p WHERE kind < 3
    OR kind = 3 AND EXISTS (SELECT 1 FROM ids q WHERE q.rid = p.rid AND abs(q.cell - p.cell) <= 1)
    OR kind = 4 AND EXISTS (SELECT 1 FROM keys q WHERE q.rid = p.rid AND abs(q.cell - p.cell) <= 1)
    OR kind = 5 AND EXISTS (
      SELECT 1 FROM ids q JOIN keys k ON k.rid = q.rid WHERE q.rid = p.rid AND abs(q.cell - p.cell) <= 1
        AND abs(k.cell - p.cell) <= 1 AND abs(k.cell - q.cell) <= 1)),
texts AS (
  SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
         string_agg({_SPAN}, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS strong,
         string_agg({_SPAN}, ',' ORDER BY start, kind, stop) AS everything
  FROM shown GROUP BY rid)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access,
       CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(strong, '')) AS base_sha256, coalesce(everything, '') AS spans
FROM docs LEFT JOIN texts USING (rid)
"""

#: The formatted text is stated by its length: two control strings, two line ends and the escaped role and text.
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, 24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
              + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n FROM turns)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def sharding(shards: list[str]) -> str:
    """Preference orders as joins of slots and shards: each shard's claims are replayed turn by turn in the table's text."""
    owners = ", ".join(map(str, placing.fill_table(shards)))
    names = ", ".join(f"'{s}'" for s in shards)
    return f"""
WITH owners AS (SELECT [{owners}] AS o, [{names}] AS s),
slots AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 8) AS BIGINT) % {placing.SLOTS} AS slot
          FROM documents)
SELECT doc_id, CAST(slot AS BIGINT) AS slot, s[o[slot + 1] + 1] AS shard FROM slots, owners
"""


def _field(name: str) -> str:
    return f"coalesce(CAST(strlen({name}) AS VARCHAR) || ':' || {name}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join([*[_field(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")], _field(text)]) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Division by the reversed polynomial, bit by bit.
_CRC = """xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"""


def _tree(name: str, base: str) -> str:
    """Nodes of all levels, and of each its siblings before and behind it."""
    run = "PARTITION BY grp, lvl, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, pos, n, h FROM {base}
  UNION ALL SELECT grp, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY grp, lvl, pos // 8, n),
{name}_sides AS (
  SELECT grp, lvl, pos, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '#'
      || coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS sides FROM {name} WHERE n > 1)"""


#: The tree level by level by grouping, the path of a leaf by joining its runs.
MERKLE = f"""
WITH RECURSIVE made AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || lang, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS now FROM documents),
leaves AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n FROM made),
{_tree('nodes', 'leaves')},
subs AS (SELECT '' AS grp, grp AS name, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, h FROM nodes WHERE n = 1),
{_tree('tops', 'subs')},
path AS (
  SELECT l.rid, s.lvl, s.sides FROM leaves l JOIN nodes_sides s ON s.grp = l.grp AND s.pos = l.pos >> (3 * s.lvl)
  UNION ALL SELECT l.rid, 1000 + s.lvl, s.sides FROM leaves l JOIN subs u ON u.name = l.grp JOIN tops_sides s ON s.pos = u.pos >> (3 * s.lvl)),
paths AS (SELECT rid, list(sides ORDER BY lvl) AS sides FROM path GROUP BY rid),
folded AS (
  SELECT l.*, u.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(replace(array_to_string(coalesce(sides, []), ''), '#', '')) AS proof_sha256,
         list_reduce([now] || coalesce(sides, []), lambda x, s: sha256(split_part(s, '#', 1) || x || split_part(s, '#', 2))) AS folded_root
  FROM leaves l JOIN subs u ON u.name = l.grp LEFT JOIN paths p ON p.rid = l.rid)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
