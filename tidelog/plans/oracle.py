"""DuckDB SQL for every named query (same column names and parameters).

The fixture logs are repeated as CTEs with plain ``row_number`` offsets;
fine for the small check sizes, and independent of the Spark code paths.
"""

from __future__ import annotations

from ..operators import serde as C
from ..sources import generators as G
from . import queries as Q
from .fixtures import GREETING_EVERY_S

EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(_lit(x) for x in xs) + "]"


def _pick(options: list[str], seed: str, id_sql: str) -> str:
    h = f"md5({_lit(seed + ':')} || CAST({id_sql} AS VARCHAR))"
    return (f"({_list(options)})[1 + CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) "
            f"% {len(options)}]")


def _uuid(seed: str, id_sql: str) -> str:
    h = f"md5({_lit(seed + ':')} || CAST({id_sql} AS VARCHAR))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4)"
            f" || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


def _md5_part(sql: str, n: int = 3) -> str:
    return f"CAST(CAST(('0x' || substr(md5({sql}), 1, 8)) AS BIGINT) % {n} AS INTEGER)"


def _murmur2() -> tuple[str, str]:
    """The producer's murmur2 in DuckDB SQL over columns ``hx`` (hex of the
    key's UTF-8 bytes) and ``n`` (byte count): (fold over the 4-byte words
    giving ``h0``, final expression over ``h0``). 32-bit products go through
    HUGEINT; the fold is a ``list_reduce`` whose first element is the seed."""
    m, mask = 0x5BD1E995, 4294967296

    def mul(a: str) -> str:
        return f"CAST((CAST({a} AS HUGEINT) * {m}) % {mask} AS BIGINT)"

    def byte(i: str) -> str:
        return f"CAST(('0x' || substr(hx, 2 * ({i}) + 1, 2)) AS BIGINT)"

    word = (f"({byte('4*i')} | ({byte('4*i+1')} << 8) | ({byte('4*i+2')} << 16) "
            f"| ({byte('4*i+3')} << 24))")
    k1 = mul(word)
    k3 = mul(f"xor({k1}, {k1} >> 24)")
    fold = (f"list_reduce(list_prepend(xor(CAST(2538058380 AS BIGINT), n), range(0, n // 4)), "
            f"lambda h, i: xor({mul('h')}, {k3}))")
    tail = "(n // 4) * 4"
    t = (f"xor(xor(CASE WHEN n % 4 >= 3 THEN {byte(tail + ' + 2')} << 16 ELSE 0 END, "
         f"CASE WHEN n % 4 >= 2 THEN {byte(tail + ' + 1')} << 8 ELSE 0 END), "
         f"CASE WHEN n % 4 >= 1 THEN {byte(tail)} ELSE 0 END)")
    h1 = f"(CASE WHEN n % 4 >= 1 THEN {mul(f'xor(h0, {t})')} ELSE h0 END)"
    f1 = mul(f"xor({h1}, {h1} >> 13)")
    return fold, f"xor({f1}, {f1} >> 15)"


def _odd_titles() -> dict[str, str]:
    """Characters whose title case isn't their upper case, by Python's str.title."""
    chars = map(chr, range(0x110000))
    return {c: c.title() for c in chars if c.title() != c.upper() or len(c.title()) > 1}


def _title(sql: str) -> str:
    # RE2 has no Lowercase/Uppercase properties; the general categories agree
    # with them on the test texts.
    run = r"'([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)'"
    special = "MAP {" + ", ".join(f"{_lit(k)}: {_lit(v)}"
                                  for k, v in _odd_titles().items()) + "}"
    return (f"array_to_string(list_transform(regexp_extract_all({sql}, {run}, 1), "
            f"lambda r: coalesce(map_extract_value({special}, r[1]), upper(r[1])) "
            f"|| lower(r[2:])), '')")


def _key(sql: str) -> str:
    return f"replace(lower({sql}), 's+', '-')"


def _ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


def _iso_ts(iso: str) -> str:
    return _ts(iso.removesuffix("Z").replace("T", " "))


EVENTS_LOG = """events_log AS (
  SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS BIGINT)
           AS "offset",
         CAST(user_id AS VARCHAR) AS key, event_id, user_id, event_type, value, props,
         ts AS "timestamp"
  FROM events)"""

CONV = f"""conv_ranked AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (ORDER BY conv_id, turn) - 1 AS seq
  FROM conversations),
conv_log AS (
  SELECT CAST(conv_id % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY conv_id % 3 ORDER BY seq) - 1 AS BIGINT)
           AS "offset",
         role, text, seq,
         {EPOCH} + to_seconds({GREETING_EVERY_S} * seq) AS "timestamp"
  FROM conv_ranked)"""

GREETINGS_LOG = CONV + """,
greetings_log AS (
  SELECT 'greetings' AS topic, "partition", "offset", role AS key, text AS message,
         role AS greeter, "timestamp"
  FROM conv_log),
raw_greetings_log AS (
  SELECT 'greetings.raw' AS topic, "partition", "offset", CAST(NULL AS VARCHAR) AS key,
         text, "timestamp"
  FROM conv_log)"""


def _people_select(topic: str) -> str:
    return f"""
  SELECT '{topic}' AS topic, CAST(c_custkey % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY c_custkey % 3 ORDER BY c_custkey) - 1
              AS BIGINT) AS "offset",
         {_key('c_mktsegment')} AS key, CAST(c_custkey AS VARCHAR) AS id,
         c_name AS name, c_mktsegment AS title, c_custkey,
         CASE WHEN c_custkey % 2 = 1 THEN 1 ELSE 2 END AS schema_id,
         CASE WHEN strpos(c_name, '#') > 0 THEN substr(c_name, 1, strpos(c_name, '#') - 1)
              ELSE c_name END AS first_name,
         CASE WHEN strpos(c_name, '#') > 0 THEN substr(c_name, strpos(c_name, '#') + 1)
              END AS last_name,
         {EPOCH} + to_seconds(c_custkey) AS "timestamp"
  FROM customer"""


def _people(topic: str, name: str) -> str:
    return f"{name} AS ({_people_select(topic)})"


PEOPLE_LOG = _people("people", "people_log")
PEOPLE_MIXED_LOG = _people("people.avro", "people_mixed_log")

PEOPLE_DIRTY_LOG = _people("people.dirty", "dirty0") + """,
dirty_log AS (
  SELECT topic, "partition", "offset", c_custkey % 8 AS kind, id, name, title,
         CASE WHEN c_custkey % 8 < 5 OR c_custkey % 8 = 7 THEN key END AS key,
         CASE WHEN c_custkey % 8 IN (0, 3) THEN NULL
              WHEN c_custkey % 8 = 1 THEN '{''id'':''' || id || '''}'
              WHEN c_custkey % 8 = 4 THEN CAST(to_json({'id': id, 'title': title}) AS VARCHAR)
              ELSE CAST(to_json({'id': id, 'name': name, 'title': title}) AS VARCHAR)
                   || CASE WHEN c_custkey % 8 = 2 THEN ' and more' ELSE '' END END AS text
  FROM dirty0)"""
DIRTY_ERROR = ("CASE WHEN kind IN (1, 2) THEN 'invalid json' WHEN kind = 3 THEN 'invalid utf-8' "
               "WHEN kind = 5 THEN 'invalid utf-8 in key' END")

SENDS = """numbered AS (
  SELECT event_id, 'p' || (user_id % 5) AS producer, CAST(user_id % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY user_id % 5, user_id % 3 ORDER BY event_id) - 1 AS BIGINT) AS sequence
  FROM events),
copies AS (
  SELECT *, unnest(CASE WHEN event_id % 11 = 0 THEN [0, 1] ELSE [0] END) AS "copy"
  FROM numbered WHERE event_id % 97 <> 0),
timed AS (SELECT *, event_id + event_id * 7 % 13 + "copy" * 20 AS arrival FROM copies),
sends AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY "partition" ORDER BY arrival, event_id, "copy") - 1 AS BIGINT) AS "offset"
  FROM timed)"""

VIEW = 'topic, "partition", "offset", key, "timestamp"'
PEOPLE_JSON = "CAST(to_json({'id': id, 'name': name, 'title': title}) AS VARCHAR)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bounds(src: str, name: str = "bnd") -> str:
    return (f'{name} AS (SELECT topic, "partition", min("offset") AS s, '
            f'max("offset") + 1 AS e FROM {src} GROUP BY topic, "partition")')


def _generated_people(src: str = "customer", id_col: str = "c_custkey") -> str:
    first = _pick(G.FIRST_NAMES, "people.first", id_col)
    last = _pick(G.LAST_NAMES, "people.last", id_col)
    job = _pick(G.JOBS, "people.job", id_col)
    return f"""gen0 AS (
  SELECT {id_col} AS seq, {_uuid('people', id_col)} AS id, {first} AS first_name,
         {last} AS last_name, {_title(job)} AS title
  FROM {src}),
gen AS (
  SELECT seq, id, first_name, last_name, title, first_name || ' ' || last_name AS name,
         {_key('title')} AS key
  FROM gen0)"""


def _offsets_filter() -> str:
    terms = []
    for topic, parts in Q.OFFSETS_SPEC.items():
        ors, listed = [], []
        for p, off in parts.items():
            start = 0 if off == -2 else (2**63 - 1 if off == -1 else off)
            ors.append(f'("partition" = {p} AND "offset" >= {start})')
            listed.append(str(p))
        ors.append(f'"partition" NOT IN ({", ".join(listed)})')
        terms.append(f"(topic = {_lit(topic)} AND ({' OR '.join(ors)}))")
    return " OR ".join(terms)


def _from_time(instant_sql: str) -> str:
    return (_with(EVENTS_LOG,
                  f'f AS (SELECT "partition", min("offset") AS s FROM events_log '
                  f'WHERE "timestamp" >= {instant_sql} GROUP BY 1)')
            + f'SELECT l.topic, l."partition", l."offset", l.key, l."timestamp" '
              f'FROM events_log l JOIN f ON l."partition" = f."partition" '
              f'WHERE l."offset" >= f.s')


GROUPS = (EVENTS_LOG + ",\n" + GREETINGS_LOG + """,
u AS (SELECT topic, "partition", "offset", key, "timestamp" FROM events_log
      UNION ALL SELECT topic, "partition", "offset", key, "timestamp" FROM greetings_log),
bnd AS (SELECT topic, "partition", min("offset") AS s, max("offset") + 1 AS e
        FROM u GROUP BY topic, "partition"),
commits AS (
  SELECT 'g0' AS "group", topic, "partition", CAST((e * 6) // 10 AS BIGINT) AS "offset"
    FROM bnd WHERE topic = 'events'
  UNION ALL SELECT 'g1', topic, "partition", CAST((e * 3) // 10 AS BIGINT)
    FROM bnd WHERE topic = 'events'
  UNION ALL SELECT 'g2', topic, "partition", CAST((e * 5) // 10 AS BIGINT)
    FROM bnd WHERE topic = 'greetings')""")


def _reset_sql() -> str:
    ev = "bnd.topic = 'events'"
    cur = ("LEFT JOIN commits c ON c.\"group\" = 'g0' AND c.topic = bnd.topic "
           "AND c.\"partition\" = bnd.\"partition\"")
    cols = "'g0' AS \"group\", bnd.topic, bnd.\"partition\", c.\"offset\" AS current_offset"

    def first(instant: str, name: str) -> str:
        return (f'{name} AS (SELECT topic, "partition", min("offset") AS f FROM u '
                f"WHERE topic = 'events' AND \"timestamp\" >= {instant} GROUP BY 1, 2)")
    ctes = (GROUPS + ",\n" + first(f"epoch_ms({Q.SINCE_MS})", "ft") + ",\n"
            + first(_iso_ts(Q.RESET_DATETIME), "fd"))
    parts = [
        f"SELECT {cols}, CAST(least(greatest(5, bnd.s), bnd.e) AS BIGINT) AS target_offset, "
        f"'to-offset' AS mode FROM bnd {cur} WHERE {ev} AND bnd.\"partition\" = 0",
        f"SELECT {cols}, bnd.s, 'to-earliest' FROM bnd {cur} WHERE {ev}",
        f"SELECT {cols}, bnd.e, 'to-latest' FROM bnd {cur} WHERE {ev}",
        f"SELECT {cols}, coalesce(ft.f, bnd.e), 'to-timestamp' FROM bnd {cur} "
        f"LEFT JOIN ft ON ft.\"partition\" = bnd.\"partition\" AND ft.topic = bnd.topic WHERE {ev}",
        f"SELECT {cols}, coalesce(fd.f, bnd.e), 'to-datetime' FROM bnd {cur} "
        f"LEFT JOIN fd ON fd.\"partition\" = bnd.\"partition\" AND fd.topic = bnd.topic WHERE {ev}",
    ]
    return "WITH " + ctes + "\n" + "\nUNION ALL\n".join(parts)


def _ticks_sql() -> str:
    every = G.TICK_EVERY_S
    return f"""WITH span AS (SELECT date_trunc('minute', min(ts)) AS s, max(ts) AS e FROM events),
n AS (SELECT s, (CAST(floor(epoch(e)) AS BIGINT) - CAST(epoch(s) AS BIGINT)) // {every} + 1 AS n
      FROM span),
t AS (SELECT s, unnest(generate_series(0, n)) AS i FROM n),
c AS (SELECT (epoch_us(e.ts) - epoch_us(n.s)) // {every * 1000000} + 1 AS tick,
             count(*) AS events
      FROM events e, n GROUP BY 1)
SELECT i AS tick, CASE WHEN i = 0 THEN 'startup' ELSE 'interval' END AS kind,
       coalesce(c.events, 0) AS events,
       s + to_seconds(i * {every}) AS at,
       CASE WHEN i = 0 THEN 'A task executing on startup'
            ELSE 'A task executing on interval at '
                 || strftime(s + to_seconds(i * {every}), '%Y-%m-%d %H:%M:%S') END AS line
FROM t LEFT JOIN c ON c.tick = t.i"""


def _technologists() -> str:
    cols = [f'{_pick(opts, f"technologists.{name}", "event_id")} AS "{name}"'
            for name, opts in G.TECHNOLOGIST_OPTIONS.items()]
    key = _pick(G.TECHNOLOGIST_OPTIONS[G.TECHNOLOGIST_KEY],
                f"technologists.{G.TECHNOLOGIST_KEY}", "event_id")
    return f"SELECT event_id AS id, {', '.join(cols)}, {key} AS key FROM events"


def _greetings_gen(form: str) -> str:
    at = f"{EPOCH} + to_seconds(event_id * {G.GREETING_EVERY_S}) AS \"timestamp\""
    if form == "record":
        msg = (f"{_pick(G.GREETING_PREFIXES, 'greetings.prefix', 'event_id')} || ' ' || "
               f"{_pick(G.GREETING_RECIPIENTS, 'greetings.recipient', 'event_id')}")
        return (f"SELECT event_id AS id, {msg} AS message, "
                f"{_pick(G.GREETERS, 'greetings.greeter', 'event_id')} AS greeter, {at} "
                f"FROM events")
    return (f"SELECT event_id AS id, {_pick(G.GREETING_WORDS, 'greetings.word', 'event_id')} "
            f"AS greeting, {at} FROM events")


def _published() -> str:
    return (_with(PEOPLE_LOG, _generated_people(),
                  'existing AS (SELECT "partition", max("offset") + 1 AS e FROM people_log '
                  'GROUP BY 1)',
                  f'placed AS (SELECT *, {_md5_part("key")} AS "partition" FROM gen)',
                  f"""published AS (
  SELECT 'people' AS topic, p."partition",
         CAST(coalesce(x.e, 0) + row_number() OVER (PARTITION BY p."partition" ORDER BY p.seq)
              - 1 AS BIGINT) AS "offset",
         p.key, TIMESTAMP '2024-02-01 00:00:00' + to_seconds(p.seq) AS "timestamp",
         p.id, p.name, p.title
  FROM placed p LEFT JOIN existing x ON x."partition" = p."partition")"""))


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["count_greetings"] = ('SELECT role AS greeter, count(*) AS "count" '
                              'FROM conversations GROUP BY role')
    sql["read_from_earliest"] = _with(EVENTS_LOG) + f"SELECT {VIEW} FROM events_log"
    sql["read_from_latest"] = (
        _with(EVENTS_LOG, f'ends AS (SELECT "partition", max("offset") + 1 AS e FROM events_log '
                          f'WHERE "timestamp" < {_ts(Q.STARTED_AT)} GROUP BY 1)')
        + 'SELECT l.topic, l."partition", l."offset", l.key, l."timestamp" FROM events_log l '
          'LEFT JOIN ends ON ends."partition" = l."partition" '
          'WHERE ends.e IS NULL OR l."offset" >= ends.e')
    sql["read_from_offsets"] = (
        _with(EVENTS_LOG, GREETINGS_LOG,
              f"u AS (SELECT {VIEW} FROM events_log UNION ALL SELECT {VIEW} FROM greetings_log)")
        + f"SELECT {VIEW} FROM u WHERE {_offsets_filter()}")
    sql["read_from_timestamp"] = _from_time(f"epoch_ms({Q.SINCE_MS})")
    sql["read_from_datetime"] = _from_time(_iso_ts(Q.SINCE_ISO))
    sql["read_topics"] = (_with(EVENTS_LOG, PEOPLE_LOG)
                          + f"SELECT {VIEW} FROM events_log UNION ALL SELECT {VIEW} FROM people_log")
    sql["read_keyed_lines"] = """WITH lines AS (
  SELECT CASE WHEN event_type = 'error' THEN props
              ELSE CAST(user_id AS VARCHAR) || '|' || event_type || '|' || props END AS line
  FROM events)
SELECT line,
       CASE WHEN strpos(line, '|') > 0 THEN substr(line, 1, strpos(line, '|') - 1) END AS key,
       CASE WHEN strpos(line, '|') > 0 THEN substr(line, strpos(line, '|') + 1) END AS value,
       CASE WHEN strpos(line, '|') = 0 THEN 'no key separator' END AS error
FROM lines"""
    sql["read_raw_strings"] = (_with(GREETINGS_LOG) + 'SELECT "partition", "offset", text, '
                               'CAST(NULL AS VARCHAR) AS error FROM raw_greetings_log')
    sql["generate_records"] = _technologists()
    sql["generate_people"] = (_with(_generated_people())
                              + "SELECT seq, id, first_name, last_name, title, name, key FROM gen")
    sql["generate_greetings"] = _greetings_gen("record")
    sql["generate_greeting_words"] = _greetings_gen("word")
    sql["ticks"] = _ticks_sql()
    sql["write_topic"] = _published() + f"SELECT {VIEW}, id FROM published"
    sql["delivery_receipts"] = (_published() + 'SELECT id, name, title, topic, "partition", '
                                '"offset" FROM published')
    sql["publish_after_retention"] = _published() + f"SELECT {VIEW} FROM published"
    sql["group_lag_uncommitted"] = (
        "WITH " + GROUPS + ",\n"
        + 'c AS (SELECT * FROM commits WHERE "partition" <> 1),\n'
          'g AS (SELECT DISTINCT "group", topic FROM c)\n'
          'SELECT g."group", b.topic, b."partition", c."offset" AS current_offset, '
          'b.e AS log_end_offset, b.e - c."offset" AS lag FROM g JOIN bnd b ON b.topic = g.topic '
          'LEFT JOIN c ON c."group" = g."group" AND c.topic = b.topic '
          'AND c."partition" = b."partition"')
    good = "kind >= 4"
    sql["items_rejects"] = (
        _with(PEOPLE_DIRTY_LOG)
        + f'SELECT topic, "partition", "offset", key, CASE WHEN {good} THEN id END AS id, '
          f'CASE WHEN {good} AND kind <> 4 THEN name END AS name, '
          f'CASE WHEN {good} THEN title END AS title, {DIRTY_ERROR} AS error FROM dirty_log')
    sql["dead_letters_rejects"] = (
        _with(PEOPLE_DIRTY_LOG)
        + f"SELECT \"partition\", \"offset\", CASE WHEN kind = 4 THEN 'missing required field: name' "
          f"ELSE {DIRTY_ERROR} END AS error FROM dirty_log WHERE kind IN (1, 2, 3, 4, 5)")
    sql["keyed_lines_rejects"] = (
        _with(PEOPLE_DIRTY_LOG)
        + "SELECT topic, \"partition\", \"offset\", coalesce(key, 'null') || chr(9) || "
          "coalesce(text, 'null') AS line FROM dirty_log")
    compacted = """k AS (
  SELECT "partition", "offset", kind, CASE WHEN kind = 5 THEN 'FF' ELSE hex(encode(key)) END AS key_hex
  FROM dirty_log WHERE kind <> 6)"""
    sql["compact_tombstones"] = (
        _with(PEOPLE_DIRTY_LOG, compacted)
        + 'SELECT "partition", "offset", key_hex FROM (SELECT *, row_number() OVER (PARTITION BY '
          '"partition", key_hex ORDER BY "offset" DESC) AS rn FROM k) WHERE rn = 1 AND kind <> 0')
    sql["dead_letters"] = (_with(PEOPLE_MIXED_LOG)
                           + "SELECT \"partition\", \"offset\", "
                             "'writer schema lacks required field: name' AS error "
                             "FROM people_mixed_log WHERE schema_id = 2")
    sql["keyed_lines"] = (
        _with(PEOPLE_LOG, GREETINGS_LOG)
        + f"SELECT topic, \"partition\", \"offset\", key || chr(9) || {PEOPLE_JSON} AS line "
          f"FROM people_log UNION ALL SELECT topic, \"partition\", \"offset\", "
          f"'null' || chr(9) || text FROM raw_greetings_log")
    sql["message_lines"] = (
        _with(GREETINGS_LOG)
        + "SELECT topic, \"partition\", \"offset\", 'Greeting is ''' || message || ''' from ''' "
          "|| key || '''' AS line FROM greetings_log")
    sql["raw_greeting_lines"] = (
        _with(GREETINGS_LOG)
        + "SELECT topic, \"partition\", \"offset\", 'Greeting is ''' || text || '''' AS line "
          "FROM raw_greetings_log")
    sql["table_snapshot"] = (
        _with(GREETINGS_LOG) + f'SELECT greeter, count(*) AS "count" FROM greetings_log '
                               'GROUP BY greeter')
    sql["encode_json"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(to_json({'id': CAST(c_custkey AS VARCHAR),"
        " 'name': c_name, 'title': c_mktsegment}) AS VARCHAR) AS json FROM customer")
    sql["decode_json"] = (_with(EVENTS_LOG) + 'SELECT topic, "partition", "offset", event_type, '
                          'value, props, CAST(NULL AS VARCHAR) AS error FROM events_log')
    sql["decode_utf8"] = (_with(PEOPLE_LOG) + f'SELECT "partition", "offset", key AS key_text, '
                          f'{PEOPLE_JSON} AS value_text, CAST(NULL AS VARCHAR) AS error '
                          f'FROM people_log')
    sql["validate_record"] = (
        _with(PEOPLE_MIXED_LOG)
        + "SELECT \"partition\", \"offset\", CASE WHEN schema_id = 1 THEN name END AS name, "
          "title, CASE WHEN schema_id = 2 THEN 'missing required field: name' END AS error "
          "FROM people_mixed_log")
    sql["read_with_schema"] = (
        _with(PEOPLE_MIXED_LOG)
        + 'SELECT "partition", "offset", schema_id, '
          'CASE WHEN schema_id = 2 THEN first_name END AS first_name, '
          'CASE WHEN schema_id = 2 THEN last_name END AS last_name, title, '
          'CAST(NULL AS VARCHAR) AS error FROM people_mixed_log')
    cands = ", ".join(f"({_lit(c.name)}, {_list(list(c.required))})"
                      for c in (C.FULLNAME_REQUIRED, C.FULLNAME_OPTIONAL, C.PERSON_V2))
    sql["compat_audit"] = f"""WITH docs AS (
  SELECT CASE WHEN schema_id = 1
              THEN to_json({{'name': name, 'title': title}})
              ELSE to_json({{'first_name': first_name, 'last_name': last_name,
                            'title': title}}) END AS j
  FROM ({_people_select('people.avro')}) p),
shapes AS (SELECT list_sort(json_keys(j)) AS keys, count(*) AS records FROM docs GROUP BY 1),
cands AS (SELECT * FROM (VALUES {cands}) t(candidate, required)),
m AS (SELECT candidate, keys, records,
             list_filter(required, lambda x: NOT list_contains(keys, x)) AS missing
      FROM shapes CROSS JOIN cands)
SELECT candidate, array_to_string(keys, ',') AS shape, records,
       array_to_string(missing, ',') AS missing_required, len(missing) = 0 AS compatible
FROM m"""
    sql["message_key"] = (f"SELECT c_custkey, {_key('c_mktsegment')} AS segment_key, "
                          f"{_key('c_name')} AS name_key FROM customer")
    sql["title_case"] = f"SELECT conv_id, turn, {_title('text')} AS title FROM conversations"
    sql["with_id"] = f"SELECT c_custkey, {_uuid('person', 'c_custkey')} AS id FROM customer"
    sql["items"] = (_with(GREETINGS_LOG) + 'SELECT "partition", "offset", key, message, greeter, '
                    'CAST(NULL AS VARCHAR) AS error FROM greetings_log')
    sql["rekey"] = (_with(GREETINGS_LOG)
                    + f'SELECT "partition" AS source_partition, "offset" AS source_offset, '
                      f'greeter AS key, {_md5_part("greeter")} AS "partition" FROM greetings_log')
    sql["count_by_key"] = 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type'
    sql["running_count"] = (
        _with(GREETINGS_LOG)
        + 'SELECT "partition", "offset", greeter, count(*) OVER (PARTITION BY greeter ORDER BY '
          '"timestamp", "partition", "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) '
          'AS "count" FROM greetings_log')
    sql["lookup_count"] = (
        _with(EVENTS_LOG, 'seen AS (SELECT key, count(*) AS c FROM events_log GROUP BY key)')
        + 'SELECT CAST(c_custkey AS VARCHAR) AS key, coalesce(seen.c, 0) AS "count" '
          'FROM customer LEFT JOIN seen ON seen.key = CAST(c_custkey AS VARCHAR)')
    sql["apply_retention"] = (
        _with(EVENTS_LOG) + f'SELECT {VIEW} FROM events_log WHERE "timestamp" >= '
                            f'{_ts(Q.RETENTION_NOW)} - to_milliseconds({Q.RETENTION_MS})')
    sql["compact"] = (
        _with(EVENTS_LOG) + 'SELECT "partition", key, "offset", event_type FROM ('
                            'SELECT *, row_number() OVER (PARTITION BY topic, "partition", key '
                            'ORDER BY "offset" DESC) AS rn FROM events_log) WHERE rn = 1')
    fold, final = _murmur2()
    sql["assign_partition_producer"] = f"""WITH t AS (
  SELECT c_custkey, c_name AS key, hex(encode(c_name)) AS hx,
         octet_length(encode(c_name)) AS n FROM customer),
w AS (SELECT c_custkey, key, hx, n, {fold} AS h0 FROM t)
SELECT c_custkey, key, CAST(({final} & 2147483647) % 3 AS INTEGER) AS "partition" FROM w"""
    sql["assign_partition"] = (f'SELECT c_custkey, c_name AS key, {_md5_part("c_name")} '
                               f'AS "partition" FROM customer')
    stats_src = " UNION ALL ".join(
        f'SELECT topic, "partition", "offset", "timestamp" FROM {t}'
        for t in ("events_log", "greetings_log", "people_log", "people_mixed_log"))
    sql["topic_stats"] = (
        _with(EVENTS_LOG, GREETINGS_LOG, PEOPLE_LOG, PEOPLE_MIXED_LOG, f"u AS ({stats_src})")
        + 'SELECT topic, "partition", count(*) AS records, min("offset") AS start_offset, '
          'max("offset") + 1 AS end_offset, min("timestamp") AS first_timestamp, '
          'max("timestamp") AS last_timestamp FROM u GROUP BY topic, "partition"')
    sql["list_topics"] = (
        _with(EVENTS_LOG, GREETINGS_LOG, PEOPLE_LOG, PEOPLE_MIXED_LOG, f"u AS ({stats_src})")
        + 'SELECT topic, count(DISTINCT "partition") AS partitions, '
          'CAST(count(*) AS BIGINT) AS records FROM u GROUP BY topic')
    sql["dedupe"] = _with(EVENTS_LOG) + f"SELECT {VIEW} FROM events_log"
    sql["replay_after_reset"] = sql["dedupe"]
    sql["dedupe_by_id"] = _with(PEOPLE_LOG) + 'SELECT id, topic, "partition", "offset" FROM people_log'
    sql["commit"] = (
        _with(EVENTS_LOG) + f'SELECT \'g0\' AS "group", topic, "partition", '
                            f'max("offset") + 1 AS "offset" FROM events_log '
                            f'WHERE "timestamp" < {_ts(Q.CONSUMED_BEFORE)} '
                            f'GROUP BY topic, "partition"')
    sql["resume"] = (
        _with(EVENTS_LOG, _bounds("events_log"))
        + 'SELECT l.topic, l."partition", l."offset", l.key, l."timestamp" FROM events_log l '
          'JOIN bnd ON bnd."partition" = l."partition" '
          'WHERE l."partition" = 2 OR l."offset" >= (bnd.e * 6) // 10')
    sql["group_lag"] = (
        "WITH " + GROUPS
        + '\nSELECT c."group", c.topic, c."partition", c."offset" AS current_offset, '
          'b.e AS log_end_offset, b.e - c."offset" AS lag FROM commits c '
          'LEFT JOIN bnd b ON b.topic = c.topic AND b."partition" = c."partition"')
    sql["list_groups"] = ("WITH " + GROUPS + '\nSELECT "group", count(*) AS partitions '
                          'FROM commits GROUP BY "group"')
    sql["plan_reset"] = _reset_sql()
    sql["apply_reset"] = (
        "WITH " + GROUPS + ",\n"
        + f'fd AS (SELECT topic, "partition", min("offset") AS f FROM u WHERE topic = \'events\' '
          f'AND "timestamp" >= {_iso_ts(Q.RESET_DATETIME)} GROUP BY 1, 2)\n'
          'SELECT c."group", c.topic, c."partition", CAST(CASE WHEN c."group" = \'g0\' '
          'THEN coalesce(fd.f, b.e) ELSE c."offset" END AS BIGINT) AS "offset" '
          'FROM commits c JOIN bnd b ON b.topic = c.topic AND b."partition" = c."partition" '
          'LEFT JOIN fd ON fd.topic = c.topic AND fd."partition" = c."partition"')
    sql["incremental_run"] = (
        "WITH " + GROUPS
        + '\nSELECT u.topic, u."partition", u."offset", u.key, u."timestamp" FROM u '
          'LEFT JOIN commits c ON c."group" = \'g1\' AND c.topic = u.topic '
          'AND c."partition" = u."partition" '
          'WHERE c."offset" IS NULL OR u."offset" >= c."offset"')
    sql["incremental_bookmarks"] = (
        "WITH " + GROUPS + ",\n"
        + """adv AS (
  SELECT 'g1' AS "group", b.topic, b."partition", b.e AS "offset" FROM bnd b
  LEFT JOIN commits c ON c."group" = 'g1' AND c.topic = b.topic AND c."partition" = b."partition"
  WHERE c."offset" IS NULL OR c."offset" < b.e),
enabled AS (
  SELECT * FROM adv
  UNION ALL SELECT c.* FROM commits c WHERE NOT EXISTS (
    SELECT 1 FROM adv a WHERE a."group" = c."group" AND a.topic = c.topic
    AND a."partition" = c."partition"))
SELECT "group", topic, "partition", "offset", 'enabled' AS mode FROM enabled
UNION ALL SELECT "group", topic, "partition", "offset", 'paused' FROM commits
UNION ALL SELECT "group", topic, "partition", "offset", 'disabled' FROM commits""")
    grp_rows = ('rows AS (SELECT p.* FROM people_mixed_log p JOIN bnd '
                'ON bnd."partition" = p."partition" WHERE p."offset" >= (bnd.e * 5) // 10)')
    sql["consume_people"] = (
        _with(PEOPLE_MIXED_LOG, _bounds("people_mixed_log"), grp_rows)
        + """SELECT topic, "partition", "offset",
  'Consumed person ' || coalesce(CASE WHEN schema_id = 2 THEN first_name END, 'null') || ' '
  || coalesce(CASE WHEN schema_id = 2 THEN last_name END, 'null') || ' (' || title
  || ') with key ''' || key || ''' from partition ' || "partition" || ' at offset '
  || "offset" AS line
FROM rows""")
    sql["consume_commits"] = (
        _with(PEOPLE_MIXED_LOG)
        + 'SELECT \'people.grp\' AS "group", topic, "partition", max("offset") + 1 AS "offset" '
          'FROM people_mixed_log GROUP BY topic, "partition"')
    sql["read_from_timestamp_indexed"] = sql["read_from_timestamp"]
    sql["plan_reset_indexed"] = sql["plan_reset"]
    sql["compact_incremental"] = sql["compact"]
    sends = _with(SENDS, """arrived AS (
  SELECT *, row_number() OVER (PARTITION BY producer, "partition", sequence ORDER BY "offset") AS nth,
         CASE WHEN arrival < %d THEN 1 ELSE 2 END AS run FROM sends),
firsts AS (SELECT * FROM arrived WHERE nth = 1)""" % Q.SENT_UPTO)
    sql["dedupe_by_sequence"] = sends + """SELECT producer, "partition", sequence, "offset", event_id, run,
  coalesce(sequence < max(sequence) OVER (PARTITION BY producer, "partition", run ORDER BY "offset"
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM firsts"""
    sql["sequence_gaps"] = sends + """SELECT producer, "partition", sequence + 1 AS first_missing, following - 1 AS last_missing
FROM (SELECT *, lead(sequence) OVER (PARTITION BY producer, "partition" ORDER BY sequence) AS following FROM firsts)
WHERE following > sequence + 1"""
    start = 'starts AS (SELECT "partition", (e * 3) // 10 AS s, e FROM bnd)'
    sql["commit_prefix"] = _with(EVENTS_LOG, _bounds("events_log"), start) + f'''
SELECT 'g0' AS "group", 'events' AS topic, s."partition",
       CAST(coalesce(min(l."offset"), any_value(s.e)) AS BIGINT) AS "offset"
FROM starts s LEFT JOIN events_log l ON l."partition" = s."partition" AND l."offset" >= s.s
  AND l.event_type = 'error' AND l.value > {Q.FAILS_ABOVE} GROUP BY s."partition" '''
    sql["commit_prefix_compacted"] = _with(EVENTS_LOG, _bounds("events_log"), start, '''compacted AS (
  SELECT "partition", "offset" FROM (
    SELECT *, row_number() OVER (PARTITION BY "partition", key ORDER BY "offset" DESC) AS rn FROM events_log)
  WHERE rn = 1)''') + '''
SELECT 'g0' AS "group", 'events' AS topic, s."partition", CAST(coalesce(least(
    min(c."offset") FILTER (c."offset" % 50 = 49), max(c."offset") FILTER (c."offset" % 50 <> 49) + 1),
    any_value(s.s)) AS BIGINT) AS "offset"
FROM starts s LEFT JOIN compacted c ON c."partition" = s."partition" AND c."offset" >= s.s
GROUP BY s."partition" '''
    typed = _people_select("people.typed")
    sql["read_with_defaults"] = f"""SELECT "partition", "offset", 1 + c_custkey % 3 AS schema_id, name,
  CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 90 AS DOUBLE) WHEN 1 THEN c_custkey % 90 + 0.5 END AS age,
  CASE WHEN c_custkey % 3 = 1 THEN title ELSE 'zz' END AS nick,
  CASE WHEN c_custkey % 3 = 2 THEN 'cannot read string as double: age' END AS error FROM ({typed})"""
    sql["compat_audit_types"] = f"""WITH kinds AS (
  SELECT CASE c_custkey % 3 WHEN 0 THEN 'integer' WHEN 1 THEN 'number' ELSE 'string' END AS kind, count(*) AS records
  FROM ({typed}) GROUP BY 1),
reads AS (SELECT * FROM (VALUES ('PersonDouble', ['integer', 'number']), ('PersonInt', ['integer']),
                                ('PersonString', ['string'])) t(candidate, fits))
SELECT candidate, 'age:' || kind || ',name:string' || CASE kind WHEN 'number' THEN ',nick:string' ELSE '' END AS shape,
  records, '' AS missing_required, CASE WHEN list_contains(fits, kind) THEN '' ELSE 'age' END AS unreadable,
  list_contains(fits, kind) AS compatible FROM kinds CROSS JOIN reads"""
    sql["with_uuid_checked"] = ("SELECT count(*) AS ids, count(*) AS distinct_ids, count(*) AS well_formed "
                                "FROM customer")
    sql["write_topic_keyless"] = ("SELECT count(*) AS records, CAST(3 AS BIGINT) AS partitions, count(*) AS positions, "
                                  "count(*) AS placed, CAST(0 AS BIGINT) AS keys, CAST(0 AS BIGINT) AS misplaced "
                                  "FROM conversations")
    sql["write_topic_string_order"] = f"""WITH placed AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS segment, {_md5_part("c_name")} AS "partition"
  FROM customer)
SELECT c_custkey, "partition", CAST(row_number() OVER (
  PARTITION BY "partition" ORDER BY segment NULLS FIRST, c_custkey) - 1 AS BIGINT) AS "offset" FROM placed"""
    sql["running_count_null_time"] = (
        _with(GREETINGS_LOG)
        + 'SELECT "partition", "offset", greeter, count(*) OVER (PARTITION BY greeter ORDER BY '
          'CASE WHEN "offset" % 7 <> 3 THEN "timestamp" END NULLS FIRST, "partition", "offset" '
          'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "count" FROM greetings_log')
    changes = """changes AS (
  SELECT row_number() OVER (ORDER BY "timestamp", "partition", "offset") AS version, greeter,
         row_number() OVER (PARTITION BY greeter ORDER BY "timestamp", "partition", "offset") AS "count"
  FROM greetings_log)"""
    sql["table_changes"] = _with(GREETINGS_LOG, changes) + 'SELECT version, greeter, "count" FROM changes'
    versions = ", ".join(f"({v})" for v in Q.TABLE_VERSIONS)
    sql["table_versions"] = (
        _with(GREETINGS_LOG, changes)
        + f'SELECT greeter, max("count") AS "count", CAST(v AS BIGINT) AS version FROM changes '
          f'JOIN (VALUES {versions}) t(v) ON version <= v GROUP BY greeter, v')
    sql["table_snapshots"] = _with(GREETINGS_LOG) + f'''
SELECT m."at", greeter, count(*) AS "count" FROM greetings_log
JOIN (SELECT {EPOCH} + to_seconds(300 * range) AS "at" FROM range(10)) m ON "timestamp" <= m."at"
GROUP BY m."at", greeter'''
    # The live forms must give the batch results.
    part = '(CAST(epoch("timestamp") AS BIGINT) - lo) // step'
    spans = '''spans AS (
  SELECT CAST(epoch(min("timestamp")) AS BIGINT) AS lo,
         CAST(epoch(max("timestamp")) - epoch(min("timestamp")) AS BIGINT) // 3 + 1 AS step FROM greetings_log)'''
    sql["live_read_from_latest"] = (_with(GREETINGS_LOG, spans)
                                    + f"SELECT {VIEW} FROM greetings_log, spans WHERE {part} >= 1")
    sql["live_incremental_paused"] = _with(GREETINGS_LOG, spans) + f'''
SELECT "partition", "offset", CAST({part} AS INTEGER) AS run, mode
FROM greetings_log, spans, (VALUES ('paused 1'), ('paused 2')) t(mode)
UNION ALL SELECT "partition", "offset", -1, 'enabled' FROM greetings_log'''
    sql["live_publish_after_retention"] = _published() + f'''SELECT {VIEW} FROM published
WHERE epoch("timestamp") - {Q.REPUBLISH_EPOCH_S} >= (SELECT ceil((max(seq) + 1) / 3) FROM gen)'''
    sql["live_count_greetings"] = sql["count_greetings"]
    sql["live_running_count"] = sql["running_count"]
    sql["live_running_count_split"] = sql["running_count"]
    return sql


ORACLE_SQL = build()

__all__ = ["ORACLE_SQL"]
