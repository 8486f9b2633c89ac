"""SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

#: The table of the checksum by its rule: eight shifts of each byte, with the polynomial where a one falls out.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
)"""


def _crc32(data: str) -> str:
    """Unsigned crc32 of a blob, with ``crc`` of the table in scope."""
    digits = f"hex({data})"
    byte_list = f"list_transform(range(length({digits}) // 2), lambda i: ('0x' || substring({digits}, (2 * i + 1)::INT, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), {step}), 4294967295)"


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _digest(n_chars: str) -> str:
    names = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(_field(n) for n in names)})"


def _climb(name: str, start: str) -> str:
    """Tree levels as (g, level, place, node, n); each level halves the places."""
    return f"""{name} AS (
  SELECT g, 0 AS level, place, node, count(*) OVER (PARTITION BY g) AS n FROM ({start})
  UNION ALL
  SELECT g, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY g, level, place // 2, n
)"""


def _siblings(tree: str, leaves: str) -> str:
    """For each leaf the node beside its way at every level, with the side it stands on."""
    return f"""SELECT l.row, t.level, CASE WHEN s.node IS NULL THEN '-' WHEN s.place < t.place THEN 'L' || s.node ELSE 'R' || s.node END AS step
  FROM {leaves} l JOIN {tree} t ON t.g = l.g AND t.n > 1 AND t.place = l.place // (1::BIGINT << t.level)
  LEFT JOIN {tree} s ON s.g = t.g AND s.level = t.level AND s.place = xor(t.place, 1::BIGINT)"""


MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, row_number() OVER () AS row, {_digest("n_chars")} AS leaf,
    CASE WHEN {_crc32("encode(doc_id::VARCHAR)")} % 7 = 0 THEN {_digest("(n_chars + 1)")} END AS changed
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place FROM docs
),
{_climb("low", "SELECT g, place, leaf AS node FROM leaves")},
subroots AS (
  SELECT g AS lang, node, row_number() OVER (ORDER BY encode(g)) - 1 AS place FROM low WHERE n = 1
),
{_climb("high", "SELECT 0 AS g, place, node FROM subroots")},
steps AS (
  {_siblings("low", "leaves")}
  UNION ALL
  SELECT l.row, 1000 + u.level, u.step FROM leaves l JOIN subroots s ON s.lang = l.g
  JOIN ({_siblings("high", "(SELECT place AS row, 0 AS g, place FROM subroots)")}) u ON u.row = s.place
),
ways AS (
  SELECT row, list(step ORDER BY level) AS way, string_agg(step[2:], '' ORDER BY level) AS proof FROM steps GROUP BY row
),
folded AS (
  SELECT l.*, s.node AS subroot, (SELECT node FROM high WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(changed, leaf), coalesce(way, [])), lambda node, step:
      sha256(CASE step[1] WHEN 'L' THEN step[2:] || node WHEN 'R' THEN node || step[2:] ELSE node END)) AS folded_root
  FROM leaves l JOIN subroots s ON s.lang = l.g LEFT JOIN ways USING (row)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

#: Accented letters written as single ASCII bytes, since DuckDB's levenshtein counts bytes.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_AS_BYTES = "".join(map(chr, range(33, 97))).replace("'", "''")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
),
coded AS (SELECT run, times, {_crc32("encode(doc_id::VARCHAR || ':' || run)")} AS h FROM runs, crc_table),
changed AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word FROM coded
),
words AS (
  SELECT word, sum(times)::BIGINT AS n, translate(word, '{_ACCENTED}', '{_AS_BYTES}') AS code
  FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM words a JOIN (SELECT *, unnest([length(code) - 1, length(code), length(code) + 1]) AS size FROM words) b ON length(a.code) = b.size
  WHERE a.word <> b.word AND levenshtein(a.code, b.code) = 1
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n, any_value(n) AS n
  FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
    CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
chains AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
