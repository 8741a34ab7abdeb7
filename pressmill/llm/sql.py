"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_EXACT = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (
           PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST
         ) AS keep_id,
         row_number() OVER (
           PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST
         ) AS place
  FROM rows
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, source, line, place FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE text IS NOT NULL
  )
), trimmed AS (
  SELECT *, trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS bare FROM lines
), wide AS (
  SELECT bare FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10
), kept AS (
  SELECT t.*, w.bare IS NOT NULL AS goes FROM trimmed t LEFT JOIN wide w ON t.bare = w.bare
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '') AS text
FROM kept GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, text FROM documents WHERE text IS NULL
"""

_NGRAM = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'
  ) AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (
  SELECT u, v FROM pairs WHERE 100 * common >= 80 * (n + m - common)
), edges AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT doc_id AS d, doc_id AS c FROM documents
  UNION
  SELECT e.u, r.c FROM reach r JOIN edges e ON e.v = r.d
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.c) AS component_id
FROM sets s JOIN reach r ON r.d = s.doc_id GROUP BY s.doc_id, s.s
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT doc_no, coalesce(lang, 'und') AS lang, unnest(split) AS piece, generate_subscripts(split, 1) AS piece_no FROM (
    SELECT row_number() OVER () AS doc_no, lang, string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS split
    FROM documents)
), words AS (
  SELECT doc_no, piece_no, lang, unnest(found) AS w1, generate_subscripts(found, 1) AS place
  FROM (SELECT *, regexp_extract_all(piece, '[^\x20\x09]+') AS found FROM pieces)
), grown AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY doc_no, piece_no ORDER BY place)
), spoken AS (
  SELECT lang, w1 AS phrase, 1 AS size FROM grown
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM grown WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM grown WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM grown WHERE w4 IS NOT NULL
), counts AS (
  SELECT lang, phrase, size, count(*) AS f FROM spoken GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates)
), weighed AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
       JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
), scored AS (
  SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, a AS outer_a, size, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, size - m + 1)) AS i
        FROM (SELECT *, unnest(generate_series(2, size - 1)) AS m FROM candidates WHERE size > 2))
), outer_counts AS (
  SELECT lang, phrase, max(outer_a) AS outer_a FROM inner_phrases GROUP BY ALL
), survivors AS (
  SELECT s.* FROM scored s LEFT JOIN outer_counts o USING (lang, phrase)
  WHERE o.outer_a IS NULL OR CAST(100 AS HUGEINT) * o.outer_a < CAST(80 AS HUGEINT) * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM survivors
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op1_exact_dedup": _EXACT,
    "op4_ngram_join": _NGRAM,
    "op5_line_dedup": _LINES,
    "op13_phrases": _PHRASES,
}
