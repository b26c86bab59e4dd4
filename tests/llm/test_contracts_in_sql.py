"""What SQL can say of queries whose verdicts it can't: base columns, sizes,
hosts and rules, in DuckDB over whole tables."""

import duckdb
import pytest

from tidelog.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same(df, table):
    cols = [d[0] for d in table.description]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, df.select(*cols).collect()), key=key) == sorted(table.fetchall(), key=key)


def test_base_columns_of_the_quality_rules(spark, con):
    table = con.execute(r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
windows AS (SELECT doc_id, p, array_to_string(words[p:p + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)),
repeated AS (SELECT doc_id, shingle FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM windows JOIN repeated USING (doc_id, shingle), range(5) t(k)
            GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
doubled AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM lines GROUP BY doc_id),
base AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(doubled.n, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN doubled USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base""")
    same(queries.op2_line_frequency(spark, SF), table)


def test_sizes_of_the_mixture(spark, con):
    table = con.execute(r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
n AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source)
SELECT doc_id, size, source_size FROM s JOIN n ON s.source IS NOT DISTINCT FROM n.source""")
    same(queries.op5_curriculum_mixing(spark, SF), table)


def test_hosts_paths_and_ruled_verdicts_of_urls(spark, con):
    out = queries.op3_url_filter(spark, SF)
    table = con.execute(r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts),
rules AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(h, p, verdict)),
fitting AS (
  SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
  FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, verdict AS ruled FROM cut LEFT JOIN (SELECT * FROM fitting WHERE k = 1) USING (page_id)""")
    rows = {r[0]: r[1:] for r in table.fetchall()}
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, ruled = rows[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (ruled is None or r.verdict == ruled)
