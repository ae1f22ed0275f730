"""SQL for the queries that it can express."""

from __future__ import annotations

import string

from . import chat, substring_dedup
from .workload import EXTRA_ID, EXTRA_TEXT

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_NL = "chr(10)"


def _escaped(column: str, escapes=chat.ESCAPES) -> str:
    for mark, stands in escapes:
        column = f"replace({column}, '{mark}', '{stands}')"
    return column


_OP1 = f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}'
  UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || {_NL} || text || {_NL}, '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat.OPEN + chat.BETWEEN + chat.CLOSE)} + length({_escaped('role', chat.ROLE_ESCAPES)})
      + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP2 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(
    CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM common WHERE 100 * n >= 75 * (na + nb - n)
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_reached AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(r.b, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(r.b, s.doc_id)) AS kept
FROM sets s LEFT JOIN least_reached r ON r.a = s.doc_id
"""

_GROUPS = " || ".join(f"lpad(to_base(('0x' || h[{1 + 5 * i}:{5 + 5 * i}])::BIGINT, 32), 4, '0')" for i in range(8))

_OP4 = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h FROM pages
), judged AS (SELECT *, min(page_id) OVER (PARTITION BY p) AS first_id FROM hashed)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes,
  translate(upper({_GROUPS}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM judged
"""

_W = substring_dedup.WINDOW
_OP6 = f"""
WITH worded AS (SELECT doc_id, {_WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {_W - 1}], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {_W - 2})) AS i FROM worded)
), judged AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS least_doc FROM windows
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {_W})) AS i FROM judged WHERE least_doc < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""

_OP8 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.e, c.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(c.e, c.e)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_OP9 = f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents
), sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sums
), filled AS (
  -- sources that reach 3 times their size first come first; the others share what those leave
  SELECT *, 3 * source_size / weight AS reach,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER before, 0) AS cut, coalesce(sum(weight) OVER before, 0) AS freed
  FROM weighed WINDOW before AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (total - cut)::DOUBLE / (weights - freed)::DOUBLE AS lvl FROM filled
  WHERE weight * ((total - cut)::DOUBLE / (weights - freed)::DOUBLE) <= 3 * source_size
  ORDER BY reach, source LIMIT 1
), targets AS (
  SELECT source, source_size,
    CASE WHEN weight * lvl > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE weight * lvl END AS target
  FROM weighed, level
), rated AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + (('0x' || md5('0:' || doc_id)[1:13])::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE
    < rate - floor(rate))::BIGINT) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source
"""

_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
_OP10 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), {_NL}) AS l FROM documents
), lines AS (
  SELECT doc_id, raw, i, trim(raw, {_BLANK}) AS line
  FROM (SELECT doc_id, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS i FROM split)
), marked AS (
  SELECT *, line <> '' AND row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS again FROM lines
)
SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (again) AS n_removed,
  sha256(coalesce(string_agg(raw, {_NL} ORDER BY i) FILTER (NOT again), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP13 = """
WITH ids AS (
  SELECT conv_id, (xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))),
    lambda crc, bit: xor(crc >> 1, CASE WHEN xor(crc & 1, bit) = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6) AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT i.conv_id, 0 AS part, n.k, n.role, n.text FROM ids i
  JOIN numbered n ON n.conv_id = i.conv_id - i.conv_id % 100 AND n.k <= i.h
  UNION ALL SELECT i.conv_id, 1, n.k, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.k > i.h
), placed AS (
  SELECT conv_id, text, length(text) AS chars, row_number() OVER w AS d,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), members AS (
  SELECT conv_id, d, sha256(path) AS node, chars FROM placed UNION ALL SELECT conv_id, 0, '', 0 FROM ids
), deepest AS (SELECT conv_id, max(d) AS last FROM members GROUP BY 1
), nodes AS (
  SELECT node, any_value(m.d) AS d, any_value(chars) AS chars, count(*) AS n, min(conv_id) AS least,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (m.d = last), '')) AS ends
  FROM members m JOIN deepest USING (conv_id) GROUP BY 1
), steps AS (
  SELECT DISTINCT a.node AS above, b.node AS below FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d = a.d + 1
), reach AS (
  SELECT DISTINCT a.node AS above, b.node AS below FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d >= a.d
), subtrees AS (
  SELECT r.above AS node, sum((n.n - 1) * n.chars)::BIGINT AS saved,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM steps s WHERE s.above = r.below)) AS leaves
  FROM reach r JOIN nodes n ON n.node = r.below GROUP BY 1
)
SELECT n.least AS conv_id, n.d AS depth, p.least AS parent_conv_id, n.n AS n_convs,
  (SELECT count(*) FROM steps s WHERE s.above = n.node) AS n_children, t.leaves AS n_leaves, t.saved AS saved_tokens,
  n.ends AS ends_sha256
FROM nodes n JOIN subtrees t USING (node) LEFT JOIN steps u ON u.below = n.node LEFT JOIN nodes p ON p.node = u.above
"""

ORACLES: dict[str, str] = {
    "op1_chat": _OP1, "op2_near_dedup": _OP2, "op4_warc": _OP4, "op6_substrings": _OP6, "op8_nearest": _OP8,
    "op9_mixing": _OP9, "op10_line_dedup": _OP10, "op10_single_lines": _OP10, "op13_prefix_trie": _OP13,
}
