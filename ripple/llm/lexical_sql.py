"""SQL of the operators on words whose contract names CRC-32: spelling variants and importance resampling."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(text: str) -> str:
    """Only A to Z in lower case."""
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _crc(name: str, source: str, columns: str, key: str) -> str:
    """CTEs with the rows of ``source``, and in ``h`` the CRC-32 of the UTF-8 bytes of ``key``, byte by byte."""
    digit = "(strpos('0123456789ABCDEF', substr(x, {}, 1)) - 1)"
    byte = f"{digit.format('2 * i + 1')} * 16 + {digit.format('2 * i + 2')}"
    return f"""{name}_table AS (
  SELECT n AS b, list_reduce(list_prepend(n, range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))) AS v FROM range(256) r(n)
), {name}_steps AS (
  SELECT {columns}, hex(encode({key})) AS x, 0::BIGINT AS i, 4294967295::BIGINT AS c FROM {source}
  UNION ALL
  SELECT {columns}, x, i + 1, xor(c >> 8, v) FROM {name}_steps JOIN {name}_table ON b = xor(c & 255, {byte})
  WHERE 2 * i < length(x)
), {name} AS (
  SELECT {columns}, xor(c, 4294967295) AS h FROM {name}_steps WHERE 2 * i = length(x)
)"""


# Two words are one edit apart if both lose a code point at the same place to leave the same text, or if one is the
# other less a code point.
SPELLING_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_folded('text')}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), {_crc('hashed', 'counted', 'doc_id, run, n', "coalesce(doc_id::VARCHAR, 'null') || ':' || run")},
results AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places
), longer AS (
  SELECT DISTINCT l.word, w.word AS shorter FROM less l JOIN words w ON w.word = l.rest
), links AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT word, shorter FROM longer
  UNION ALL SELECT shorter, word FROM longer
), best AS (
  SELECT l.word, count(*) AS n_near, arg_min(w.word, (-w.n, w.word)) AS near, max(w.n) AS near_n
  FROM links l JOIN words w ON w.word = l.near GROUP BY l.word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL
), last AS (
  SELECT f.word, f.root FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NULL
)
SELECT f.word, f.form, l.root, f.n, f.n_near::BIGINT AS n_near, f.form_n FROM formed f JOIN last l ON l.word = f.word
"""

IMPORTANCE_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT true AS source, rowid AS r, unnest(regexp_extract_all({_folded('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM (SELECT row_number() OVER () AS rowid, text FROM documents)
  UNION ALL
  SELECT false, NULL, unnest(regexp_extract_all({_folded('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), counted AS (
  SELECT word, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM words GROUP BY word
), {_crc('hashed', 'counted', 'word, s, t', 'word')},
buckets AS (
  SELECT h % 10000 AS bucket, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM hashed GROUP BY 1
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM buckets
), by_word AS (
  SELECT word, gain FROM hashed JOIN gains ON bucket = h % 10000
), docs AS (
  SELECT row_number() OVER () AS rowid, doc_id, substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8) AS x FROM documents
), summed AS (
  SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM words JOIN by_word USING (word) WHERE source GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9),
           lambda i: strpos('0123456789abcdef', substr(x, i, 1)) - 1)), lambda a, b: a * 16 + b) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN summed ON r = rowid
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS enough
  FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= enough * 10 // 100 THEN place END::BIGINT AS rank
FROM placed
"""
