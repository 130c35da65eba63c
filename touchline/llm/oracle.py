"""SQL for the queries of this subpackage that SQL can express, over the same tables.

Written from the contracts, not from the operators: all windows, all pairs with a common shingle, all strings.
"""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_REPEATS = """
WITH data AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (
  SELECT doc_id, s, b[s + 1 : s + 100] AS string
  FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 99)) AS s FROM data WHERE octet_length(b) >= 100)),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY string ORDER BY doc_id, s) AS place FROM strings),
gone AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM ranked WHERE place > 1),
numbered AS (
  SELECT doc_id, s, sum((before IS NULL OR s > before + 100)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM gone),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS z FROM numbered GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, a AS z FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(z), NULL FROM runs GROUP BY doc_id
  UNION ALL SELECT doc_id, 0, NULL FROM data WHERE doc_id NOT IN (SELECT doc_id FROM runs)),
parts AS (SELECT doc_id, a, hex(b[a + 1 : coalesce(z, octet_length(b))]) AS part FROM kept JOIN data USING (doc_id)),
rest AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS h FROM parts GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed FROM runs GROUP BY doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM data JOIN rest USING (doc_id) LEFT JOIN counted USING (doc_id)"""

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::INT >> {bits}) & 31) + 1, 1)"
    for k in range(8)
    for bits in (15, 10, 5, 0)
)

_ARCHIVES = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
latest AS (SELECT html, max(page_id) AS last FROM payloads GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM payloads JOIN latest USING (html)"""

_CONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, p, p + 9) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc_words),
hits AS (
  SELECT doc_id, p, size, item_id
  FROM (SELECT doc_id, p, size, list_slice(w, p, p + size - 1) AS words
        FROM places CROSS JOIN (SELECT DISTINCT len(words) AS size FROM windows) WHERE p + size - 1 <= len(w))
  JOIN windows USING (words)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_COMPONENTS = f"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 2), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared.n >= 90 * (a.n + b.n - shared.n)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id, s.n"""

def _crc(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    return f"""4294967295 - list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), list_transform(range(8), lambda k: k::UBIGINT)), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT))))"""


# The cheapest edits, turn by turn, by the states of the grammar: nothing said (N), after system (S), user (U), assistant (A).
_REPAIRED = f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         ({_crc("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")}) % 20 AS code FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, (VALUES (1), (2)) AS copies(copy) WHERE code <> 0 AND (copy = 1 OR code = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS nr,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, ending = '' AS blank,
         ending <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY nr) AS before FROM placed),
faults AS (SELECT *, NOT blank AND NOT again AND ending NOT IN ('.', '!', '?') AS cut FROM judged),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (nr > 1 AND concat(before, initial) NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
steps(state, symbol, target) AS (VALUES ('N', 's', 'S'), ('N', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
inserted(state, target, letters) AS (
  SELECT DISTINCT state, state, '' FROM (SELECT state FROM steps UNION ALL SELECT target FROM steps)
  UNION ALL SELECT state, target, 'I' FROM steps WHERE symbol <> 's'
  UNION ALL SELECT a.state, b.target, 'II' FROM steps a JOIN steps b ON a.target = b.state WHERE a.symbol <> 's' AND b.target <> a.state),
reached(conv_id, nr, state, cost, audit) AS (
  SELECT conv_id, 0::BIGINT, target, 5 * length(letters), letters FROM facts, inserted WHERE state = 'N'
  UNION ALL
  SELECT conv_id, nr, state, min(cost), min_by(audit, (cost, audit)) FROM (
    SELECT f.conv_id, f.nr, i.target AS state, r.cost + e.price + 5 * length(i.letters) AS cost, concat(r.audit, e.letter, i.letters) AS audit
    FROM reached r JOIN faults f ON f.conv_id = r.conv_id AND f.nr = r.nr + 1
    CROSS JOIN LATERAL (
      SELECT 'D' AS letter, 2 AS price, r.state AS target
      UNION ALL SELECT CASE WHEN s.symbol = f.initial THEN 'K' ELSE 'R' END, (s.symbol <> f.initial)::INT + 5 * f.cut::INT, s.target
      FROM steps s WHERE s.state = r.state AND NOT f.blank AND NOT f.again AND (s.symbol = f.initial OR s.symbol <> 's')) e
    JOIN inserted i ON i.state = e.target) GROUP BY conv_id, nr, state),
best AS (
  SELECT conv_id, min(cost) AS cost, min_by(audit, (cost, audit)) AS audit
  FROM reached r JOIN facts USING (conv_id) WHERE r.nr = n AND state IN ('N', 'A') GROUP BY conv_id),
edits AS (
  SELECT conv_id, k, audit[k] AS letter, (length(audit) - length(replace(audit, 'D', ''))) AS dropped, length(audit) AS size,
         length(replace(audit[1:k], 'I', '')) AS nr, length(replace(audit[1:k], 'D', '')) AS out
  FROM best, unnest(range(1, length(audit) + 1)) AS u(k)),
lines AS (
  SELECT e.conv_id, e.out, concat(CASE WHEN e.letter = 'K' THEN f.role WHEN (e.out + (e.size - e.dropped) % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END,
         ':', CASE WHEN e.letter = 'I' THEN '' ELSE f.text END) AS line
  FROM edits e LEFT JOIN faults f ON f.conv_id = e.conv_id AND f.nr = e.nr AND e.letter <> 'I' WHERE e.letter <> 'D'),
texts AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY out)) AS h FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN texts USING (conv_id)"""

# Prefixes as lists of turns; sums over subtrees by joining every node with the prefixes of its smallest member.
_TRIE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nr, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, ({_crc("conv_id::VARCHAR")}) % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.nr, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.nr <= c.h
  UNION ALL SELECT c.conv_id, 1, t.nr, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.nr > c.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, nr) AS depth, role, text FROM rebuilt),
members AS (
  SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS key, length(text) AS chars FROM placed
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM members GROUP BY conv_id),
nodes AS (
  SELECT m.key, m.depth, min(m.conv_id) AS rep, count(*) AS n_convs, max(m.chars) AS chars,
         sha256(coalesce(string_agg(CASE WHEN m.depth = l.length THEN m.conv_id::VARCHAR END, ',' ORDER BY m.conv_id), '')) AS ends_sha256
  FROM members m JOIN lengths l USING (conv_id) GROUP BY m.key, m.depth),
linked AS (
  SELECT n.*, p.rep AS parent, p.key AS parent_key FROM nodes n LEFT JOIN members m ON m.conv_id = n.rep AND m.depth = n.depth - 1
  LEFT JOIN nodes p ON p.key = m.key AND p.depth = m.depth),
children AS (SELECT parent_key AS key, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY parent_key),
counted AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (key)),
sums AS (
  SELECT m.key, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.chars)::BIGINT AS saved_tokens
  FROM counted v JOIN members m ON m.conv_id = v.rep AND m.depth <= v.depth GROUP BY m.key)
SELECT rep AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN sums USING (key)"""

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": _REPEATS,
    "op8_warc": _ARCHIVES,
    "op9_decontamination": _CONTAMINATION,
    "op10_parity_join": _COMPONENTS,
    "op11_conversation_repair": _REPAIRED,
    "op13_prefix_trie": _TRIE,
}
