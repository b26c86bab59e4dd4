"""DuckDB SQL of the queries that SQL can express, with the same columns."""

#: Operator 7: lines of at least 10 code points (stripped, A-Z lower-cased) stay
#: in the smallest document that holds them.
LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k),
judged AS (
  SELECT keyed.*, coalesce(length(k) >= 10 AND doc_id <> first_doc, false) AS gone
  FROM keyed LEFT JOIN firsts USING (k)),
flat AS (
  SELECT doc_id, pos, line, gone,
         pos - row_number() OVER (PARTITION BY doc_id, gone ORDER BY pos) AS island
  FROM judged),
runs AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS dropped_runs
  FROM (SELECT doc_id, min(pos) - 1 AS a, max(pos) - 1 AS b
        FROM flat WHERE gone GROUP BY doc_id, island) GROUP BY doc_id),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM flat GROUP BY doc_id)
SELECT doc_id, n_lines, n_dropped, kept_sha256, dropped_runs FROM kept LEFT JOIN runs USING (doc_id)
"""

#: Operator 11. A crc32 is an exclusive or over the bytes of what each leaves
#: behind after the bytes that follow it (`tab`), so it is a join and an
#: aggregate. Words one letter apart leave the same rest without the letter at
#: one place; words one letter longer leave the shorter word.
SPELLING = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY ALL),
keyed AS (
  SELECT *, row_number() OVER () AS i, hex(encode(doc_id::VARCHAR || ':' || run)) AS hx FROM runs),
steps(b, j, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, j + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE j < 8),
base AS (SELECT b, v FROM steps WHERE j = 8),
tab(k, b, v) AS (
  SELECT 0, b, v FROM base
  UNION ALL SELECT 0, 256, 4294967295
  UNION ALL
  SELECT k + 1, tab.b, xor(base.v, tab.v // 256) FROM tab JOIN base ON base.b = tab.v % 256
  WHERE k < (SELECT max(length(hx)) // 2 FROM keyed)),
bytes AS (
  SELECT i, length(hx) // 2 AS n, unnest(range(length(hx) // 2)) AS pos, hx FROM keyed WHERE hx IS NOT NULL),
places AS (
  SELECT i, n - 1 - pos AS k, ('0x' || substr(hx, 2 * pos + 1, 2))::INT AS b FROM bytes
  UNION ALL SELECT i, length(hx) // 2, 256 FROM keyed WHERE hx IS NOT NULL),
crc AS (SELECT i, xor(bit_xor(v), 4294967295) AS h FROM places JOIN tab USING (k, b) GROUP BY i),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, c
  FROM keyed LEFT JOIN crc USING (i)),
words AS (
  SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
rests AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
shorter AS (
  SELECT DISTINCT r.word AS long_word, r.n AS long_n, w.word AS short_word, w.n AS short_n
  FROM rests r JOIN words w ON w.word = r.rest),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM rests a JOIN rests b USING (p, rest) WHERE a.word <> b.word
  UNION ALL SELECT long_word, short_word, short_n FROM shorter
  UNION ALL SELECT short_word, long_word, long_n FROM shorter),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word),
chosen AS (
  SELECT b.word, n_near, top, min(near) AS near FROM best b JOIN near x ON x.word = b.word AND x.near_n = b.top
  GROUP BY ALL),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN near END AS form,
         CASE WHEN top >= 10 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN chosen USING (word)),
chain(word, upto) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.upto WHERE f.form IS NOT NULL),
roots AS (
  SELECT chain.word, chain.upto AS root FROM chain JOIN forms f ON f.word = chain.upto WHERE f.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN roots USING (word)
"""

ORACLE_SQL = {"op7_line_dedup": LINE_DEDUP, "op11_spelling_variants": SPELLING}
