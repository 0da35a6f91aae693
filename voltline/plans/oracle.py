"""DuckDB SQL equivalents of the queries in ``voltline.plans.derived`` (the correctness oracle).

Tables region, nation, customer, supplier, part, orders, lineitem, events, documents, embeddings,
pages, benchmark, labels and conversations are views over the same Parquet files.
"""

from __future__ import annotations

from voltline import catalog
from voltline.plans.derived_jobs import STORED_SQL

_TABLE_LIST = "[" + ", ".join(f"'{t}'" for t in list(catalog.ROUTABLE_TABLES) + ["UNLISTED"]) + "]"
_ROUTABLE = ", ".join(f"'{t}'" for t in catalog.ROUTABLE_TABLES)

MONTH_FILE = "'PUBLIC_DVD_ORDERS_' || strftime(o_orderdate, '%Y%m') || '010000.CSV'"

NAMED_FILES = f"""
named AS (
  SELECT o_orderkey, o_orderstatus,
    CASE o_orderkey % 4
      WHEN 0 THEN 'PUBLIC_DVD_' || t || '_' || strftime(o_orderdate, '%Y%m%d') || '0000.CSV'
      WHEN 1 THEN 'PUBLIC_ARCHIVE#' || t || '#FILE01#' || strftime(o_orderdate, '%Y%m%d') || '0000.CSV'
      WHEN 2 THEN 'PUBLIC_ARCHIVE%23' || t || '%23FILE01%23' || strftime(o_orderdate, '%Y%m%d') || '0000.CSV'
      ELSE lower(t) || '.csv' END AS file_name
  FROM (SELECT *, list_extract({_TABLE_LIST}, (o_custkey % {len(catalog.ROUTABLE_TABLES) + 1})::INT + 1) AS t FROM orders)
)"""


def _route(expr: str) -> str:
    stem = f"upper(regexp_replace({expr}, '^(\\.*[^.].*)\\.[^.]*$', '\\1'))"
    part = (
        f"CASE WHEN starts_with({stem}, 'PUBLIC_DVD_') THEN regexp_replace(substr({stem}, 12), '_[0-9]{{8,12}}$', '') "
        f"WHEN contains({stem}, 'PUBLIC_ARCHIVE#') THEN split_part({stem}, '#', 2) ELSE {stem} END"
    )
    return f"CASE WHEN ({part}) IN ({_ROUTABLE}) THEN ({part}) ELSE 'OTHER_DATA' END"


def _period(pattern: str) -> str:
    dec = "url_decode(upper(file_name))"
    return (
        f"CAST(NULLIF(regexp_extract({dec}, '{pattern}', 1), '') AS INTEGER) AS year, "
        f"CAST(NULLIF(regexp_extract({dec}, '{pattern}', 2), '') AS INTEGER) AS month"
    )


_STRICT = "([0-9]{4})(0[1-9]|1[0-2])[0-9]{2}"
_FIRST8 = "([0-9]{4})([0-9]{2})[0-9]{2}"


def _infer_sql() -> str:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    parts = []
    for i, c in enumerate(cols):
        s = f"CAST({c} AS VARCHAR)"
        is_dt = "DATE" in c.upper() or "TIME" in c.upper()
        parts.append(
            f"SELECT '{c}' AS column_name, {i + 1}::INTEGER AS position, CASE "
            f"WHEN count({c}) = 0 THEN '{'timestamp_ntz' if is_dt else 'double'}' "
            f"WHEN bool_and(regexp_full_match({s}, '[+-]?[0-9]+')) THEN 'bigint' "
            f"WHEN bool_and(TRY_CAST({s} AS DOUBLE) IS NOT NULL) THEN 'double' "
            f"WHEN bool_and({s} IN ('True','TRUE','true','False','FALSE','false')) THEN 'boolean' "
            f"ELSE '{'timestamp_ntz' if is_dt else 'string'}' END AS inferred_type FROM lineitem"
        )
    return " UNION ALL ".join(parts)


def _lineitem_first() -> str:
    order = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split(", "))
    return (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"
    )


SQL: dict[str, str] = {
    "parse_report": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "scan_report_lines": f"SELECT {MONTH_FILE} AS file_name, 1::BIGINT AS header_lines, count(*) AS data_lines, 2::BIGINT AS other_lines FROM orders GROUP BY 1",
    "decode_lines": "SELECT doc_id, length(replace(text, chr(65533), ''))::INTEGER AS clean_chars FROM documents",
    "header_last_wins": "SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 15 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderstatus END AS o_orderstatus FROM orders",
    "header_sections": "SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 15 THEN o_custkey END AS o_custkey, CASE WHEN day(o_orderdate) > 15 THEN o_orderstatus END AS o_orderstatus FROM orders",
    "payload_offset": (
        "SELECT 'CUST_' || n_nationkey || '.CSV' AS file_name, (n_regionkey + 3)::INTEGER AS start_col, 'c_custkey' AS first_column, "
        "count(*) AS rows, min(c_custkey) AS min_custkey, max(c_acctbal) AS max_acctbal "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_regionkey"
    ),
    "file_status": f"""
        WITH f AS (
          SELECT {MONTH_FILE} AS file_name, any_value(month(o_orderdate)) AS m, count(*) AS n,
                 arg_min(day(o_orderdate), o_orderkey) AS first_day, max(day(o_orderdate)) AS max_day
          FROM orders GROUP BY 1),
        s AS (
          SELECT *, CASE WHEN m = 2 THEN 'no_header_or_data' WHEN m = 3 THEN 'bad_header' WHEN m = 4 THEN 'width_mismatch'
                         WHEN m IN (5, 6) AND first_day > 15 THEN 'width_mismatch'
                         WHEN m = 5 AND max_day > 15 THEN 'row_too_wide' ELSE 'ok' END AS status FROM f)
        SELECT file_name, status, CASE WHEN m = 2 THEN 0 ELSE 1 END::BIGINT AS header_lines, n AS data_lines,
               CASE WHEN status = 'ok' THEN n ELSE 0 END::BIGINT AS rows FROM s""",
    "infer_types": _infer_sql(),
    "coerce_datetime": (
        "SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) "
        "WHEN 2 THEN date_trunc('day', ts) ELSE NULL END AS ts_parsed FROM events"
    ),
    "route_table": f"WITH {NAMED_FILES} SELECT o_orderkey, file_name, {_route('file_name')} AS table_name FROM named",
    "route_table_decoded": f"WITH {NAMED_FILES} SELECT o_orderkey, file_name, {_route('url_decode(file_name)')} AS table_name FROM named",
    "file_period_strict": f"WITH {NAMED_FILES} SELECT o_orderkey, file_name, {_period(_STRICT)} FROM named",
    "file_period_first8": f"WITH {NAMED_FILES} SELECT o_orderkey, file_name, {_period(_FIRST8)} FROM named",
    "period_filter": (
        f"WITH {NAMED_FILES}, p AS (SELECT o_orderkey, file_name, {_period(_STRICT)} FROM named) "
        "SELECT * FROM p WHERE year IS NULL OR month IS NULL OR (year BETWEEN 1996 AND 1999 AND month IN (1, 2, 3))"
    ),
    "align_schema": "SELECT c_custkey, c_name, c_nationkey, NULL::DOUBLE AS c_acctbal, c_mktsegment FROM customer",
    "cast_to_target": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0",
    "dedupe_first": _lineitem_first(),
    "anti_join_new": "SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)",
    "pk_audit": (
        "WITH k AS (SELECT count(*) AS n, bool_or(l_orderkey IS NULL OR l_linenumber IS NULL) AS has_null "
        "FROM lineitem GROUP BY l_orderkey, l_linenumber) "
        "SELECT coalesce(sum(n), 0)::BIGINT AS rows, coalesce(sum(CASE WHEN has_null THEN n END), 0)::BIGINT AS null_keys, "
        "count(*) FILTER (WHERE NOT has_null AND n > 1)::BIGINT AS dup_groups, "
        "coalesce(sum(CASE WHEN NOT has_null AND n > 1 THEN n - 1 END), 0)::BIGINT AS surplus_rows FROM k"
    ),
}


_WANTED = "[" + ", ".join(f"'{t}'" for t in catalog.DEFAULT_WANTED_TABLES) + "]"
_DEC_ROUTE = "lower(" + _route("url_decode(file_name)") + ")"

NAMED_PERIODS = f"""{NAMED_FILES},
np AS (SELECT o_orderkey, o_orderstatus, file_name, {_DEC_ROUTE} AS table_name, {_period(_STRICT)} FROM named)"""

GRID = """grid AS (
  SELECT y::INTEGER AS year, m.month::INTEGER AS month,
         'https://example.test/MMSDM/' || y || '/MMSDM_' || y || '_' || lpad(m.month::VARCHAR, 2, '0') || '/MMSDM_Historical_Data_SQLLoader/DATA/' AS url
  FROM (SELECT min(year(o_orderdate)) AS s, max(year(o_orderdate)) AS e FROM orders) b,
       range(b.s, b.e + 1) t(y), (SELECT DISTINCT month(o_orderdate) AS month FROM orders) m)"""

_STRIPPED = (
    "regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    "'(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g')"
)
_HREFS = f"regexp_extract_all({_STRIPPED}, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"

LINKS = f"""links AS (
  SELECT page_id, url AS page_url, unnest(h) AS href, generate_subscripts(h, 1)::BIGINT AS position
  FROM (SELECT page_id, url, {_HREFS} AS h FROM pages))"""

_ORIGIN = "regexp_extract(page_url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1)"
_RESOLVED = (
    "CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN href "
    f"WHEN starts_with(href, '/') AND NOT starts_with(href, '//') THEN {_ORIGIN} || href "
    "ELSE NULL END"
)

SQL.update({
    "ledger_skip": f"""
        WITH {NAMED_PERIODS},
        cand AS (SELECT DISTINCT file_name, table_name, year, month FROM np),
        led AS (SELECT DISTINCT table_name, year, month FROM np WHERE o_orderstatus = 'F' AND year IS NOT NULL AND month IS NOT NULL),
        fresh AS (SELECT * FROM cand c WHERE NOT EXISTS (
            SELECT 1 FROM led l WHERE l.table_name = c.table_name AND l.year = c.year AND l.month = c.month))
        SELECT file_name, table_name, year, month FROM fresh WHERE year IS NULL OR month IS NULL
        UNION ALL
        SELECT min(file_name) AS file_name, table_name, year, month FROM fresh
        WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY table_name, year, month""",
    "ledger_mark": f"""
        WITH {NAMED_PERIODS}
        SELECT DISTINCT table_name, year, month, file_name AS source_file FROM np WHERE o_orderstatus = 'O'
        EXCEPT
        SELECT DISTINCT table_name, year, month, file_name AS source_file FROM np WHERE o_orderstatus = 'F'""",
    "period_grid": f"WITH {GRID} SELECT * FROM grid",
    "period_completeness": f"""
        WITH {NAMED_PERIODS}, {GRID},
        wanted AS (SELECT unnest({_WANTED}) AS t),
        loaded AS (SELECT DISTINCT table_name, year, month FROM np WHERE o_orderstatus = 'O' AND year IS NOT NULL AND month IS NOT NULL),
        local_names AS (SELECT DISTINCT regexp_replace(upper(file_name), '\\.CSV$', '.ZIP') AS n FROM np WHERE o_orderstatus = 'F'),
        local_cov AS (
          SELECT DISTINCT lower(w.t) AS table_name, g.year, g.month FROM local_names l, wanted w, grid g
          WHERE ends_with(l.n, '.ZIP') AND contains(l.n, g.year || lpad(g.month::VARCHAR, 2, '0'))
            AND (starts_with(l.n, 'PUBLIC_DVD_' || w.t || '_') OR starts_with(l.n, 'PUBLIC_ARCHIVE%23' || w.t || '%23')
                 OR starts_with(l.n, 'PUBLIC_ARCHIVE#' || w.t || '#'))),
        cov AS (
          SELECT year, month, count(DISTINCT table_name) AS c FROM (SELECT * FROM loaded UNION SELECT * FROM local_cov)
          WHERE table_name IN (SELECT lower(t) FROM wanted) GROUP BY year, month)
        SELECT g.year, g.month, g.url, coalesce(c, 0)::BIGINT AS covered_tables,
               coalesce(c, 0) = {len(catalog.DEFAULT_WANTED_TABLES)} AS complete
        FROM grid g LEFT JOIN cov USING (year, month)""",
    "feed_completeness": f"""
        WITH {NAMED_PERIODS},
        links AS (SELECT DISTINCT file_name, year, month FROM np),
        loaded AS (SELECT DISTINCT table_name, year, month FROM np WHERE o_orderstatus = 'O' AND year IS NOT NULL AND month IS NOT NULL),
        lt AS (SELECT l.*, unnest(CASE WHEN contains(upper(l.file_name), 'DISPATCH') THEN ['dispatchprice', 'dispatchregionsum']
                                       ELSE [{", ".join(f"'{t.lower()}'" for t in catalog.DEFAULT_WANTED_TABLES)}] END) AS table_name FROM links l)
        SELECT file_name, year, month,
               bool_and(EXISTS (SELECT 1 FROM loaded d WHERE d.table_name = lt.table_name AND d.year = lt.year AND d.month = lt.month))
               AND year IS NOT NULL AND month IS NOT NULL AS complete
        FROM lt GROUP BY file_name, year, month""",
    "extract_links": f"""
        WITH {LINKS}
        SELECT page_id, position, href, {_RESOLVED} AS url,
               replace(upper(regexp_extract(url_decode(href), '[^/]*$', 0)), 'ẞ', 'SS') AS file_name FROM links""",
    "feed_filter": f"""
        WITH {LINKS}, f AS (SELECT page_id, position, replace(upper(regexp_extract(url_decode(href), '[^/]*$', 0)), 'ẞ', 'SS') AS file_name FROM links)
        SELECT * FROM f WHERE contains(file_name, 'THE') OR contains(file_name, 'ION')""",
    "link_manifest": f"""
        WITH {NAMED_PERIODS},
        pg AS (SELECT n.o_orderkey AS page_id, n.o_orderstatus, regexp_replace(n.file_name, '(?i)\\.csv$', '.zip') AS href,
                      'https://example.test/MMSDM/' || year(o.o_orderdate) || '/MMSDM_' || year(o.o_orderdate) || '_'
                      || lpad(month(o.o_orderdate)::VARCHAR, 2, '0') || '/MMSDM_Historical_Data_SQLLoader/DATA/' AS page_url
               FROM named n JOIN orders o USING (o_orderkey)),
        m AS (SELECT page_id, page_url || href AS url, upper(url_decode(href)) AS file_name, href,
                     CAST(regexp_extract(page_url, 'MMSDM_([0-9]+)_([0-9]+)/', 1) AS INTEGER) AS page_year,
                     CAST(regexp_extract(page_url, 'MMSDM_([0-9]+)_([0-9]+)/', 2) AS INTEGER) AS page_month FROM pg),
        t AS (SELECT *, lower(list_filter({_WANTED}, lambda x: contains(file_name, 'PUBLIC_DVD_' || x || '_')
                   OR contains(file_name, 'PUBLIC_ARCHIVE#' || x || '#') OR contains(file_name, 'PUBLIC_ARCHIVE%23' || x || '%23'))[1]) AS table_name,
                   CAST(NULLIF(regexp_extract(url_decode(upper(file_name)), '{_STRICT}', 1), '') AS INTEGER) AS year,
                   CAST(NULLIF(regexp_extract(url_decode(upper(file_name)), '{_STRICT}', 2), '') AS INTEGER) AS month FROM m),
        led AS (SELECT DISTINCT table_name, year, month FROM np WHERE o_orderstatus = 'P' AND year IS NOT NULL AND month IS NOT NULL)
        SELECT page_id, url, file_name, table_name, year, month FROM t
        WHERE table_name IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM led WHERE led.table_name = t.table_name AND led.year = t.page_year AND led.month = t.page_month)
          AND NOT EXISTS (SELECT 1 FROM pg WHERE pg.o_orderstatus = 'F' AND pg.href = t.href)""",
    "load_batch": "SELECT event_id, ts AS event_time, user_id, event_type, value, props FROM events",
    "load_metrics": (
        "SELECT 2 * count(*) AS rows_in, count(*) AS dup_in_batch, count(*) FILTER (WHERE day(ts) <= 15) AS already_present, "
        "count(*) FILTER (WHERE day(ts) > 15) AS rows_loaded FROM events"
    ),
    "stream_load": "SELECT event_id, ts AS event_time, user_id, event_type, value, props FROM events",
    "expand_archives": "SELECT 'doc_' || doc_id || '.txt' AS member, 2 AS depth, length(text)::INTEGER AS n_chars FROM documents",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
    "sql_filter": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderstatus = 'F'",
    "sql_join": "SELECT n.n_name, c.c_custkey, o.o_orderkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_orderpriority = '1-URGENT'",
    "sql_group": "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "sql_rollup": "SELECT r.r_name, n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ROLLUP (r.r_name, n.n_name)",
    "sql_window": "SELECT o_custkey, o_orderkey, o_totalprice, rnk FROM (SELECT o_custkey, o_orderkey, o_totalprice, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM orders) t WHERE rnk <= 3",
    "sql_setop": "SELECT * FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT * FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')",
})

_FEW = "['DISPATCHPRICE', 'TRADINGPRICE']"
SQL["plan_mmsdm"] = f"""
    WITH {NAMED_PERIODS}, {GRID},
    wanted AS (SELECT unnest({_FEW}) AS t),
    pg AS (SELECT n.o_orderkey AS page_id, n.o_orderstatus, regexp_replace(n.file_name, '(?i)\\.csv$', '.zip') AS href, year(o.o_orderdate) AS py, month(o.o_orderdate) AS pm,
                  'https://example.test/MMSDM/' || year(o.o_orderdate) || '/MMSDM_' || year(o.o_orderdate) || '_'
                  || lpad(month(o.o_orderdate)::VARCHAR, 2, '0') || '/MMSDM_Historical_Data_SQLLoader/DATA/' AS page_url
           FROM named n JOIN orders o USING (o_orderkey)),
    led AS (SELECT DISTINCT table_name, year, month FROM np WHERE o_orderstatus = 'P' AND year IS NOT NULL AND month IS NOT NULL),
    here AS (SELECT DISTINCT upper(href) AS n FROM pg WHERE o_orderstatus = 'P'),
    cov AS (SELECT DISTINCT lower(w.t) AS table_name, g.year, g.month FROM here l, wanted w, grid g
            WHERE contains(l.n, g.year || lpad(g.month::VARCHAR, 2, '0'))
              AND (starts_with(l.n, 'PUBLIC_DVD_' || w.t || '_') OR starts_with(l.n, 'PUBLIC_ARCHIVE%23' || w.t || '%23') OR starts_with(l.n, 'PUBLIC_ARCHIVE#' || w.t || '#'))),
    complete AS (SELECT year, month FROM (SELECT * FROM led UNION SELECT * FROM cov) WHERE table_name IN (SELECT lower(t) FROM wanted)
                 GROUP BY year, month HAVING count(DISTINCT table_name) = 2),
    m AS (SELECT page_id, page_url || href AS url, upper(url_decode(href)) AS file_name, href, py, pm FROM pg
          WHERE EXISTS (SELECT 1 FROM grid g WHERE g.year = py AND g.month = pm) AND NOT EXISTS (SELECT 1 FROM complete c WHERE c.year = py AND c.month = pm)),
    t AS (SELECT *, CASE WHEN contains(file_name, 'PUBLIC_DVD_DISPATCHPRICE_') OR contains(file_name, 'PUBLIC_ARCHIVE#DISPATCHPRICE#') THEN 'dispatchprice'
                         WHEN contains(file_name, 'PUBLIC_DVD_TRADINGPRICE_') OR contains(file_name, 'PUBLIC_ARCHIVE#TRADINGPRICE#') THEN 'tradingprice' END AS table_name FROM m)
    SELECT page_id, url, file_name, table_name FROM t
    WHERE table_name IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM led WHERE led.table_name = t.table_name AND led.year = t.py AND led.month = t.pm)
      AND NOT EXISTS (SELECT 1 FROM pg WHERE pg.o_orderstatus = 'P' AND pg.href = t.href)"""
SQL["load_rejects"] = (
    "SELECT 'EVENTS' AS table_name, 'f' || (event_id % 10) AS source_file, CASE WHEN event_id % 5 = 0 THEN 'unconvertible: value' ELSE 'null key: event_id' END AS reason, "
    "count(*) AS rows FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0 GROUP BY ALL"
)
_SOUND = "event_id % 5 <> 0 AND event_id % 7 <> 0"
SQL["load_balance"] = (
    f"SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({_SOUND})) AS rejected, 0::BIGINT AS dup_in_batch, "
    f"count(*) FILTER (WHERE {_SOUND} AND event_id % 2 = 0) AS already_present, count(*) FILTER (WHERE {_SOUND} AND event_id % 2 <> 0) AS rows_loaded FROM events"
)
SQL["load_second_batch_dates"] = (
    f"SELECT event_id, CASE WHEN event_id % 2 = 0 OR event_id % 3 <> 0 THEN ts END AS event_time, value FROM events WHERE event_id % 2 = 0 OR ({_SOUND})"
)
SQL["load_inbox"] = (
    "SELECT event_id, ts AS event_time, value, ['a%23b%231.csv', 'a#b#2.csv', 'c+d 3.csv', 'report[4].csv', 'report4.csv'][event_id % 5 + 1] AS file_name FROM events"
)

_TYPE_MAP = (
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' "
    "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"
)
SQL["describe_tables"] = (
    f"SELECT table_name, ordinal_position::INTEGER AS position, column_name, {_TYPE_MAP} AS data_type "
    "FROM information_schema.columns WHERE table_name IN ("
    + ", ".join(f"'{t}'" for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())
    + ")"
)
SQL["load_first_file"] = (
    f"SELECT CASE column_name WHEN 'ts' THEN 'event_time' ELSE column_name END AS column_name, ordinal_position::INTEGER AS position, {_TYPE_MAP} AS data_type "
    "FROM information_schema.columns WHERE table_name = 'events'"
)

# --- whole jobs (voltline.plans.derived_jobs) ------------------------------------------------------

_DAYS = """days AS (SELECT strftime(o_orderdate, '%Y%m%d') AS day, min(o_orderkey) AS k, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished FROM orders GROUP BY 1),
    links AS (SELECT 'https://example.test/feed/PUBLIC_ORDERS_' || day || '0000.zip' AS url, 'PUBLIC_ORDERS_' || day || '0000.ZIP' AS file_name,
              CAST(substr(day, 1, 4) AS INTEGER) AS year, CAST(substr(day, 5, 2) AS INTEGER) AS month, k, finished FROM days)"""
_EVENT_FILES = "SELECT event_id, ts AS event_time, user_id, value, 'PUBLIC_DVD_EVENTS_' || strftime(ts, '%Y%m%d') || '0000.CSV' AS file_name FROM events"
SQL["sql_stored_tables"] = STORED_SQL
SQL["list_tables"] = " UNION ALL ".join(f"SELECT '{t.upper()}' AS table_name, count(*) AS rows FROM {t}" for t in ("region", "nation", "supplier", "customer", "part"))
SQL["parse_layouts"] = (
    "SELECT CASE WHEN month(o_orderdate) % 2 = 1 THEN 'tradingregionsum' ELSE 'other_data' END AS table_name, o_orderkey, o_custkey, o_totalprice, "
    "CASE WHEN month(o_orderdate) % 2 = 0 THEN o_orderpriority || ', x' END AS o_orderpriority FROM orders WHERE strftime(o_orderdate, '%Y%m') <> '199602'"
)
SQL["archive_window"] = r"""
    WITH t AS (SELECT doc_id, doc_id // 20 AS k, regexp_split_to_array(regexp_replace(coalesce(text, ''), '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS l FROM documents)
    SELECT 'doc_' || doc_id || '.txt' AS member, len(l)::BIGINT AS lines, list_sum(list_transform(l, lambda x: length(x)))::BIGINT AS chars,
           list_max(list_transform(l, lambda x: length(x)))::INTEGER AS longest
    FROM t WHERE 2020 + k % 5 BETWEEN 2021 AND 2023 AND 1 + k % 12 <= 6"""
SQL["run_job"] = _EVENT_FILES + " WHERE month(ts) % 2 = 1"
SQL["stream_archives"] = _EVENT_FILES
SQL["load_rejects_replayed"] = SQL["load_rejects"]
SQL["plan_current"] = f"WITH {_DAYS} SELECT url, file_name, 'root' AS feed FROM links WHERE finished <= 2"
SQL["plan_archive"] = f"""WITH {_DAYS}, full_months AS (SELECT year, month FROM links GROUP BY ALL HAVING min(k) % 3 = 0)
    SELECT url, file_name, year, month FROM links l WHERE year BETWEEN 1996 AND 1998 AND month <= 6 AND finished <= 2
      AND NOT EXISTS (SELECT 1 FROM full_months f WHERE f.year = l.year AND f.month = l.month)"""
SQL["stream_manifest"] = f"WITH {_DAYS} SELECT url, file_name FROM links"
SQL["stream_load_keyed"] = """
    SELECT DUID, START_DATE, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY DUID, START_DATE ORDER BY event_id % 3 <> 0, event_id % 7, event_id) AS place
      FROM (SELECT 'U' || (user_id % 50) AS DUID, date_trunc('day', ts) AS START_DATE, event_id, value FROM events)) WHERE place = 1"""

SQL["load_periods"] = """
    SELECT DUID, START_DATE, event_id, (year(START_DATE) * 100 + month(START_DATE))::INTEGER AS period FROM (
      SELECT *, row_number() OVER (PARTITION BY DUID, START_DATE ORDER BY day > 12, event_id % 7, event_id) AS place
      FROM (SELECT 'U' || (user_id % 20) AS DUID, date_trunc('hour', ts) AS START_DATE, event_id, day(ts) AS day FROM events)) WHERE place = 1"""
SQL["align_schema_add"] = (
    "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal, "
    "NULL::VARCHAR AS _source_file FROM customer"
)
_HISTORY = [["c_custkey:bigint", "c_name:string", "_source_file:string"], ["c_acctbal:double"], ["c_mktsegment:string", "c_nationkey:int"]]
SQL["schema_history"] = " UNION ALL ".join(
    f"SELECT {v}::INTEGER AS version, {i + 1}::INTEGER AS position, '{c.split(':')[0]}' AS column_name, '{c.split(':')[1]}' AS data_type FROM (SELECT count(*) FROM customer)"
    for v in (1, 2, 3) for i, c in enumerate(sum(_HISTORY[:v], []))
)
_EVENT_TEXTS = """t AS (
      SELECT user_id % 5 AS f, 'file' || (user_id % 5) AS file_name, event_id, ts, (event_id + user_id % 5) % 3 = 0 AS slashed, event_id % 11 <> 5 AS timed FROM events)"""
SQL["infer_types_by_file"] = f"""
    WITH {_EVENT_TEXTS}, f AS (SELECT f, file_name, count(*) AS n, count(*) FILTER (WHERE timed) AS times FROM t GROUP BY ALL)
    SELECT file_name AS source_file, 1::INTEGER AS position, 'event_id' AS column_name, n AS values, 'bigint' AS inferred_type FROM f
    UNION ALL SELECT file_name, 2, 'measure', CASE WHEN f = 4 THEN 0 ELSE n END, ['bigint', 'double', 'boolean', 'string', 'double'][f + 1] FROM f
    UNION ALL SELECT file_name, 3, 'EVENT_TIME', times, 'timestamp_ntz' FROM f"""
SQL["coerce_datetime_first_format"] = f"""
    WITH {_EVENT_TEXTS}, firsts AS (SELECT f, arg_min(slashed, event_id) FILTER (WHERE timed) AS first_slashed FROM t GROUP BY f)
    SELECT file_name, event_id::VARCHAR AS event_id,
           CASE WHEN timed AND slashed = first_slashed THEN CASE WHEN slashed THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END END AS event_time
    FROM t JOIN firsts USING (f)"""

SQL["stream_archive_files"] = """
    SELECT DISTINCT CASE WHEN month(ts) = 12 THEN 'inbox' ELSE 'done' END AS place, CASE WHEN day(ts) <= 15 THEN 'drop0' ELSE 'drop1' END AS drop,
           'PUBLIC_DVD_EVENTS_' || strftime(ts, '%Y%m%d') || '0000.CSV' AS file_name FROM events"""
SQL["period_grid_now"] = """
    SELECT y::INTEGER AS year, m::INTEGER AS month, 'https://example.test/MMSDM/' || y || '/MMSDM_' || y || '_' || lpad(m::VARCHAR, 2, '0') || '/MMSDM_Historical_Data_SQLLoader/DATA/' AS url
    FROM (SELECT min(year(o_orderdate)) AS s FROM orders) b, range(b.s, year(current_date) + 1) t(y), (VALUES (1), (12)) v(m)"""
SQL["load_quoted_names"] = "SELECT c_custkey, c_name, c_acctbal, upper(c_mktsegment) AS segment FROM customer WHERE c_custkey % 2 = 0"
