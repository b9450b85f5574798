"""DuckDB SQL equal to each registered query (tables are the driver's parquet views)."""

from __future__ import annotations

from tributary.fixed import CRON_PATTERN

_CONFIG_CTE = """
WITH c AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN '' ELSE c_name END AS name,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'odbc' WHEN 'BUILDING' THEN 'API'
              WHEN 'FURNITURE' THEN 'jdbc' WHEN 'MACHINERY' THEN 'ftp' ELSE 'odbc' END AS src_type,
         CASE WHEN c_acctbal > 9000 THEN '{}'
              ELSE '{"table":"CUSTOMER_' || CAST(c_custkey AS VARCHAR) || '","url":"jdbc:derby:memory:c"}'
         END AS connection,
         CASE WHEN c_acctbal < 0 THEN '@daily' WHEN c_acctbal < 1000 THEN NULL
              ELSE CAST(c_nationkey AS VARCHAR) || ' */2 * * 1-5' END AS schedule
  FROM customer
), v AS (
  SELECT *,
    CASE WHEN name IS NULL OR name = '' THEN 'source name is empty'
         WHEN src_type IS NULL OR src_type = '' THEN 'source type is empty'
         WHEN connection = '{}' THEN 'connection is empty'
         WHEN lower(src_type) NOT IN ('api', 'jdbc', 'odbc')
              THEN 'unsupported source type ''' || src_type || ''''
         WHEN schedule IS NOT NULL AND NOT regexp_matches(schedule, '%s')
              THEN 'invalid cron schedule ''' || schedule || ''''
    END AS error
  FROM c
)
""" % CRON_PATTERN

ORACLE_SQL: dict[str, str] = {
    "jdbc_table_scan": "SELECT * FROM nation",
    "jdbc_default_table": "SELECT * FROM region",
    "jdbc_query_scan": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "jdbc_partitioned_scan": "SELECT * FROM orders",
    "jdbc_pushdown_filter":
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000",
    "named_rows":
        "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier",
    "generic_columns": "SELECT n_nationkey AS column_0, n_regionkey AS column_1 FROM nation",
    "payload_object":
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
        "FROM customer",
    "payload_records":
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "payload_values": "SELECT l_partkey AS value FROM lineitem",
    "payload_scalar": "SELECT CAST(p_size AS BIGINT) AS value FROM part WHERE p_size <> 0",
    "first_record_schema":
        "SELECT n_name AS rec_name, CAST(n_nationkey AS BIGINT) AS rec_key FROM nation "
        "UNION ALL SELECT o_orderpriority, o_orderkey FROM orders",
    "type_unify":
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS qty, "
        "l_discount AS disc FROM lineitem",
    "nested_union":
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS price, "
        "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS prio FROM orders",
    "clean_record":
        "SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN NULL "
        "ELSE replace(props, ': ', ':') END AS props FROM events",
    "placeholder_record":
        "SELECT CASE WHEN event_type = 'signup' THEN 'empty_record' END AS placeholder FROM events",
    "skip_empty": "SELECT event_id, value FROM events WHERE event_type NOT IN ('view', 'click', 'error')",
    "response_errors":
        "SELECT CASE WHEN event_type = 'signup' THEN 'failed' WHEN event_type = 'error' THEN 'invalid_json' "
        "WHEN event_type = 'view' THEN 'empty' ELSE 'ok' END AS outcome, count(*) AS responses "
        "FROM events GROUP BY 1",
    "raw_roundtrip": "SELECT * FROM part",
    "raw_payload": "SELECT event_id, props FROM events",
    "raw_stringify":
        "SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') "
        "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text, strftime(ts, '%Y-%m-%d') AS day_text, "
        "CAST(CAST(value AS DECIMAL(12,3)) AS VARCHAR) AS amount_text, "
        "CASE WHEN event_id % 1000000 = 0 THEN strftime(make_timestamp(event_id * 1000001), '%Y-%m-%d %H:%M:%S') "
        "ELSE strftime(make_timestamp(event_id * 1000001), '%Y-%m-%d %H:%M:%S.%f') END || '+00:00' AS instant_text, "
        "event_id * 1000001 AS micros FROM events",
    "raw_positional":
        "SELECT CAST(n_nationkey AS BIGINT) AS column_0, n_name AS column_1, "
        "CAST(n_regionkey AS BIGINT) AS column_2 FROM nation",
    "table_create": "SELECT * FROM supplier",
    "table_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "table_replace_on_mismatch": "SELECT * FROM orders",
    "table_neighbours":
        "SELECT 'replaced' AS which, CAST(c_custkey AS BIGINT) AS id, c_name AS name FROM customer "
        "UNION ALL SELECT 'neighbour', n_nationkey, n_name FROM nation",
    "rest_pages": "SELECT * FROM orders",
    "rest_stream": """
        WITH p AS (SELECT max(o_orderkey // 64) + 1 AS n FROM orders)
        SELECT orders.*, n AS fetched, n // 2 // 8 * 8 AS first_run, CAST(0 AS BIGINT) AS idle_run FROM orders, p""",
    "repair_load": """
        WITH p AS (SELECT DISTINCT event_id // 64 AS page FROM events)
        SELECT event_id, user_id, 'PARTIAL' AS first_run, 'SUCCESS' AS repair,
               (SELECT count(*) FROM p WHERE page % 5 = 0) AS sent_again, CAST(0 AS BIGINT) AS sent_idle FROM events""",
    "rest_failures": """
        WITH p AS (SELECT event_id // 64 AS page, count(*) AS n FROM events GROUP BY 1),
        a AS (SELECT CAST(sum(CASE WHEN page % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad,
                     CAST(sum(CASE WHEN page % 5 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS good,
                     CAST(sum(CASE WHEN page % 5 <> 0 THEN n ELSE 0 END) AS BIGINT) AS written FROM p)
        SELECT 'raw: HTTP 503' AS what, bad AS n FROM a UNION ALL SELECT 'raw: ok', good FROM a
        UNION ALL SELECT 'audit: PARTIAL', 1 UNION ALL SELECT 'audit: failed requests', bad FROM a
        UNION ALL SELECT 'audit: rows written', written FROM a UNION ALL SELECT 'table: rows', written FROM a""",
    "fetch_fanout": "SELECT o_orderkey, o_custkey, o_totalprice, CAST(count(*) AS BIGINT) AS raw_rows, "
                    "CAST(count(*) AS BIGINT) AS table_rows FROM orders GROUP BY ALL",
    "first_record_per_source":
        "SELECT 'nations' AS source, CAST(n_nationkey AS BIGINT) AS seq, 'n_name,n_regionkey' AS columns, "
        "n_name AS first, CAST(n_regionkey AS VARCHAR) AS second FROM nation "
        "UNION ALL SELECT 'orders', o_orderkey, 'o_totalprice,o_orderstatus', CAST(o_totalprice AS VARCHAR), "
        "o_orderstatus FROM orders",
    "rest_post": "SELECT 'POST' AS method, c_custkey, c_name, c_acctbal FROM customer",
    "run_lookup":
        "SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, 'click_job' AS job_name, 'SUCCESS' AS status "
        "FROM events WHERE event_type = 'click'",
    "pipeline_run": """
        SELECT 'shop' AS pipeline, * FROM (VALUES
          ('orders', 'SUCCESS', 'created', (SELECT count(*) FROM orders), TRUE, 'SUCCESS', (SELECT count(*) FROM orders)),
          ('broken', 'FAILURE', NULL, 0, FALSE, 'FAILURE', NULL), ('empty', 'SUCCESS', 'skipped', 0, TRUE, 'SUCCESS', NULL),
          ('nightly', 'SCHEDULED', '0 3 * * *', 0, FALSE, NULL, NULL))
          t(source, status, action, rows_written, raw, audited, table_rows)""",
    "plug_in": "SELECT * FROM part",
    "write_failure": "SELECT *, 'SchemaMismatchError' AS raised FROM supplier",
    "config_changes": """
        WITH c AS (SELECT 'p' || c_nationkey AS pipeline, c_name AS name, c_custkey AS k FROM customer),
        f AS (SELECT *, k % 7 = 0 AS conn, k % 5 = 0 AS sched FROM c)
        SELECT pipeline, name,
               CASE WHEN k % 11 = 1 THEN 'added' WHEN k % 11 = 2 THEN 'removed' WHEN conn OR sched THEN 'changed' ELSE 'same' END AS change,
               CASE WHEN k % 11 IN (1, 2) THEN '' ELSE concat_ws(',', CASE WHEN conn THEN 'connection' END,
                    CASE WHEN sched THEN 'schedule' END) END AS fields FROM f""",
    "repeated_load": "SELECT *, CAST(0 AS BIGINT) AS late FROM orders",
    "split_ranges": "SELECT o_orderkey, 1 AS n_ranges, TRUE AS balanced FROM orders",
    "large_array":
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem",
    "raw_documents":
        "SELECT '20240229_235959' AS load_id, o_orderkey // 64 AS seq, * FROM orders",
    "type_lattice":
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS qty, "
        "CASE WHEN l_returnflag = 'N' THEN l_discount END AS disc, CASE WHEN l_returnflag = 'R' THEN l_tax END AS tax, "
        "'load-' || l_returnflag AS _load_id FROM lineitem",
    "sources_due": """
        WITH s AS (SELECT c_custkey, c_custkey % 8 AS kind, c_nationkey AS k FROM customer),
        t AS (SELECT t, minute(t) AS mi, hour(t) AS h, day(t) AS dd, month(t) AS mo, dayofweek(t) AS w
              FROM generate_series(TIMESTAMP '2024-02-27 10:08:00', TIMESTAMP '2024-03-04 06:29:00', INTERVAL 1 MINUTE) g(t)),
        keys AS (SELECT DISTINCT kind, k FROM s),
        hits AS (SELECT kind, k, count(*) AS n, min(t) AS first_due, max(t) AS last_due FROM keys, t WHERE CASE kind
              WHEN 0 THEN mi = k AND h % 2 = 0 AND w BETWEEN 1 AND 5
              WHEN 1 THEN mi % 15 = 0 AND h BETWEEN 8 AND 17
              WHEN 2 THEN mi = 0 AND h = k AND dd = 1
              WHEN 3 THEN mi IN (5, 35) AND h = 3 AND dd = 29 AND mo = 2
              WHEN 4 THEN mi = 30 AND h = 6 AND (dd IN (1, 8, 15) OR w = 0)
              WHEN 6 THEN mi IN (10, 30, 50) AND h = 23 AND mo >= 3 AND w IN (0, 6) ELSE FALSE END GROUP BY ALL)
        SELECT c_custkey, CASE s.kind WHEN 0 THEN s.k || ' */2 * * 1-5' WHEN 1 THEN '*/15 8-17 * * *' WHEN 2 THEN '0 ' || s.k || ' 1 * *'
                   WHEN 3 THEN '5,35 3 29 2 *' WHEN 4 THEN '30 6 1-15/7 * 7' WHEN 5 THEN '99 99 * * *' WHEN 6 THEN '10/20 23 * 3-12 0,6' END AS schedule,
               CASE s.kind WHEN 7 THEN NULL WHEN 5 THEN FALSE WHEN 2 THEN s.k <= 23 ELSE TRUE END AS valid_schedule,
               CAST(coalesce(n, 0) AS BIGINT) AS n_due, first_due, last_due
        FROM s LEFT JOIN hits ON hits.kind = s.kind AND hits.k = s.k""",
    "run_audit":
        "SELECT event_type || '_job' AS job_name, count(*) AS runs, "
        "CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS successes, "
        "CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failures, "
        "CAST(sum(user_id) AS BIGINT) AS rows_read, "
        "CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE user_id END) AS BIGINT) AS rows_written "
        "FROM events GROUP BY 1",
    "run_history_topk":
        "SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, event_type || '_job' AS job_name, "
        "CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status "
        "FROM events ORDER BY ts DESC, run_id DESC LIMIT 10",
    "source_validation": _CONFIG_CTE
        + "SELECT name, src_type, schedule, error, error IS NULL AS valid FROM v",
    "source_configs": _CONFIG_CTE.replace("FROM customer\n), v", """FROM customer
), c AS (
  SELECT * REPLACE (CASE WHEN name <> '' AND c_custkey % 50 = 1 THEN 'Shared-Name'
                         WHEN name <> '' AND c_custkey % 50 = 2 THEN 'shared.name' ELSE name END AS name) FROM c0
), v""").replace("WITH c AS", "WITH c0 AS") + """
    , f AS (SELECT *, 'nation_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey // 1000 AS VARCHAR) AS pipeline,
                   lower(regexp_replace(name, '[^0-9A-Za-z_]', '_', 'g')) AS t FROM v),
    w AS (SELECT *, CAST(row_number() OVER (PARTITION BY pipeline ORDER BY c_custkey) - 1 AS INTEGER) AS idx,
                 row_number() OVER (PARTITION BY pipeline, t ORDER BY c_custkey) AS nth,
                 first(name) OVER (PARTITION BY pipeline, t ORDER BY c_custkey) AS owner FROM f),
    z AS (SELECT *, coalesce(CASE WHEN c_custkey % 20 = 0 THEN 'unknown source fields: owner' END, error,
                 CASE WHEN name <> '' AND nth > 1 AND owner = name THEN 'source ''' || name || ''' appears twice'
                      WHEN name <> '' AND nth > 1 THEN 'sources ''' || owner || ''' and ''' || name
                           || ''' share table ''' || t || '''' END) AS e FROM w)
    SELECT pipeline, idx, name, src_type, connection, schedule, e AS error, e IS NULL AS valid FROM z""",
    "incremental_load": "SELECT * FROM events",
    "incremental_responses": "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
}
