"""Telemetry relations derived from the driver's test tables.

The test tables are TPC-H-like; the operators read server telemetry
(sessions, requests, locks, backups, jobs ...). Each relation below is a
column-expression list over one driver table (``FIXTURES.md`` section 1).
The same text builds the Spark relation (``spark.sql`` with DataFrame
arguments) and the DuckDB CTE of the oracle, so both sides read identical
rows. These give rows of the right schema only; the operators never rely on
how the values were made.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The derivation rules of FIXTURES.md section 1, column by column.
# Each entry: relation -> (FROM clause with {table} placeholders, [(column, expression)]).
RELATIONS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "sessions": ("{customer}", [
        ("session_id", "c_custkey"),
        ("host_name", "'HOST' || CAST(c_nationkey AS STRING)"),
        ("login_name", "c_name"),
        ("status", "CASE WHEN c_custkey % 4 = 0 THEN 'running' ELSE 'sleeping' END"),
        ("database_id", "c_nationkey"),
        ("program_name", "c_mktsegment"),
        ("client_interface_name", "'driver ' || c_mktsegment || ' client library long name'"),
        ("is_user_process", "CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END"),
        ("cpu_time", "c_custkey * 37 % 10007"),
        ("memory_usage", "c_custkey % 64"),
        ("last_request_start_time",
         "CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (c_custkey % 86400) AS TIMESTAMP)"),
    ]),
    "requests": ("{orders}", [
        ("session_id", "o_custkey"),
        ("request_id", "o_orderkey"),
        ("start_time", "o_orderdate"),
        ("status", "CASE WHEN o_orderstatus = 'F' THEN 'running' ELSE 'suspended' END"),
        ("command", "CASE o_orderpriority WHEN '1-URGENT' THEN 'RESTORE DATABASE' "
                    "WHEN '2-HIGH' THEN 'BACKUP DATABASE' ELSE 'SELECT' END"),
        ("sql_handle", "o_orderkey % 1000"),
        ("plan_handle", "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 2000 END"),
        ("statement_start_offset", "(o_orderkey % 10) * 2"),
        ("statement_end_offset", "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE (o_orderkey % 10) * 2 + 40 END"),
        ("database_id", "o_custkey % 25"),
        ("blocking_session_id", "CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE 0 END"),
        ("wait_type", "CASE WHEN o_orderkey % 5 = 0 THEN 'LCK_M_S' ELSE NULL END"),
        ("wait_time", "o_orderkey * 13 % 120000"),
        ("percent_complete", "o_orderkey % 101"),
        ("dop", "1 + o_orderkey % 8"),
        ("cpu_time", "o_orderkey * 31 % 10007"),
        ("reads", "o_orderkey * 17 % 5003"),
        ("writes", "o_orderkey * 19 % 3001"),
        ("logical_reads", "o_orderkey * 23 % 50021"),
        ("last_wait_type", "CASE WHEN o_orderkey % 4 = 0 THEN 'PAGEIOLATCH_SH' ELSE 'LCK_M_S' END"),
        ("granted_query_memory", "o_orderkey % 97"),
        ("row_count", "o_orderkey * 11 % 3001"),
        ("total_elapsed_time", "o_orderkey * 41 % 100003"),
        ("open_transaction_count", "o_orderkey % 3"),
    ]),
    "sql_text": ("{documents}", [
        ("sql_handle", "doc_id"),
        ("dbid", "doc_id % 25"),
        ("objectid", "CASE WHEN doc_id % 4 <> 0 THEN doc_id % 150 END"),
        ("text", "text"),
    ]),
    "query_plan": ("{part}", [
        ("plan_handle", "p_partkey"),
        ("query_plan", "'<ShowPlanXML><' || CASE WHEN p_size % 5 = 0 THEN 'MissingIndexes' ELSE 'RelOp' END "
                       "|| '/></ShowPlanXML>'"),
    ]),
    "waiting_tasks": ("{events}", [
        ("session_id", "user_id"),
        ("exec_context_id", "event_id % 4"),
        ("wait_duration_ms", "CAST(FLOOR(value * 10) AS BIGINT)"),
        ("wait_type", "CASE event_type WHEN 'error' THEN 'PAGELATCH_UP' WHEN 'click' THEN 'PAGEIOLATCH_SH' "
                      "WHEN 'signup' THEN 'LCK_M_X' ELSE 'CXPACKET' END"),
        ("blocking_session_id", "CASE WHEN event_id % 6 = 0 THEN user_id + 1 ELSE NULL END"),
        ("resource_description",
         "CASE WHEN event_type IN ('error', 'click') THEN CASE WHEN event_id % 10 = 9 THEN '5:1:' ELSE '2:1:' END "
         "|| CASE event_id % 7 WHEN 0 THEN '1' WHEN 1 THEN '8088' WHEN 2 THEN '2' WHEN 3 THEN '511232' "
         "WHEN 4 THEN '3' WHEN 5 THEN '511233' ELSE CAST(event_id + 4 AS STRING) END ELSE NULL END"),
    ]),
    "locks": ("{lineitem}", [
        ("request_session_id", "l_partkey"),
        ("resource_associated_entity_id", "l_orderkey"),
        ("resource_description", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_linenumber % 2 AS STRING) END"),
        ("request_status", "CASE WHEN l_partkey % 3 = 0 OR l_linestatus = 'F' THEN 'GRANT' ELSE 'WAIT' END"),
    ]),
    "processes": ("{customer}", [
        ("spid", "c_custkey"),
        ("blocked", "CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 WHEN c_custkey % 3 = 1 THEN c_custkey + 1 "
                    "ELSE 0 END"),
        ("waittime", "c_custkey * 7919 % 120000"),
        ("dbid", "c_nationkey"),
        ("cmd", "'SELECT'"),
        ("loginame", "c_name"),
        ("hostname", "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'HOST' || CAST(c_nationkey AS STRING) END"),
        ("sql_handle", "c_custkey % 1000"),
        ("status", "CASE WHEN c_custkey % 3 = 2 THEN 'sleeping' ELSE 'suspended' END"),
        ("program_name", "c_mktsegment"),
        ("open_tran", "c_custkey % 4"),
        ("waittype", "c_custkey % 16"),
        ("lastwaittype", "CASE WHEN c_custkey % 2 = 0 THEN 'LCK_M_X' ELSE 'LCK_M_S' END"),
        ("waitresource", "'KEY: ' || CAST(c_nationkey AS STRING) || ':' || CAST(c_custkey * 7919 AS STRING)"),
        ("cpu", "c_custkey * 37 % 10007"),
        ("physical_io", "c_custkey * 17 % 5003"),
        ("memusage", "c_custkey % 64"),
        ("last_batch", "CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (c_custkey % 86400) AS TIMESTAMP)"),
    ]),
    "query_stats": ("{orders}", [
        ("sql_handle", "o_orderkey % 1000"),
        ("plan_handle", "o_orderkey % 2000"),
        ("statement_start_offset", "(o_orderkey % 10) * 2"),
        ("statement_end_offset", "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE (o_orderkey % 10) * 2 + 40 END"),
        ("creation_time", "o_orderdate"),
        ("last_execution_time", "CASE WHEN o_orderkey % 4 < 3 THEN CAST(TIMESTAMP '2024-01-01 00:00:00' "
                                "+ INTERVAL '1' SECOND * (o_orderkey * 7 % 2592000) AS TIMESTAMP) "
                                "ELSE o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 7 % 864000) END"),
        ("execution_count", "o_orderkey * 7919 % 1000003"),
        ("total_elapsed_time", "o_orderkey * 104729 % 1000003"),
        ("total_worker_time", "o_orderkey * 15485863 % 1000003"),
        ("total_logical_reads", "o_orderkey * 611953 % 1000003"),
        ("total_logical_writes", "o_orderkey * 32452843 % 1000003"),
        ("plan_generation_num", "o_orderkey * 86028121 % 1000003"),
    ]),
    "session_transactions": ("{orders}", [
        ("transaction_id", "o_orderkey"),
        ("session_id", "o_custkey"),
    ]),
    "database_transactions": ("{lineitem}", [
        ("transaction_id", "l_orderkey"),
        ("database_id", "l_suppkey % 25"),
        ("begin_time", "l_shipdate"),
        ("log_record_count", "l_orderkey * 8 + l_linenumber"),
        ("log_bytes_reserved", "CAST(FLOOR(l_extendedprice) AS BIGINT)"),
        ("state", "3 + l_linenumber % 8"),
        ("log_bytes_used_system", "l_orderkey % 4096"),
        ("log_bytes_reserved_system", "l_orderkey % 8192"),
    ]),
    "task_space_usage": ("{lineitem} JOIN {orders} ON l_orderkey = o_orderkey", [
        ("session_id", "o_custkey"),
        ("request_id", "o_orderkey"),
        ("alloc_pages", "CAST(FLOOR(l_quantity) AS BIGINT)"),
        ("dealloc_pages", "CAST(l_linenumber AS BIGINT)"),
    ]),
    "backupset": ("{orders}", [
        ("media_set_id", "o_orderkey"),
        ("server_name", "'SRV' || CAST(o_orderkey % 4 AS STRING)"),
        ("database_name", "'DB' || CAST(o_custkey % 25 AS STRING)"),
        ("compatibility_level", "80 + 10 * (o_orderkey % 5)"),
        ("recovery_model", "CASE WHEN o_orderstatus = 'F' THEN 'FULL' ELSE 'SIMPLE' END"),
        ("type", "CASE o_orderpriority WHEN '1-URGENT' THEN 'D' WHEN '2-HIGH' THEN 'I' WHEN '3-MEDIUM' THEN 'L' "
                 "WHEN '4-NOT SPECIFIED' THEN 'F' ELSE 'Z' END"),
        ("backup_start_date", "o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 59 % 86400)"),
        ("backup_finish_date", "o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 59 % 86400 + o_orderkey % 7200)"),
        ("backup_size", "CAST(FLOOR(o_totalprice) AS BIGINT)"),
        ("compressed_backup_size", "o_orderkey * 512"),
    ]),
    "backupmediafamily": ("{lineitem}", [
        ("media_set_id", "l_orderkey"),
        ("physical_device_name", "'/backup/' || CAST(l_suppkey AS STRING) || '.bak'"),
        ("device_type", "CASE l_linenumber % 5 WHEN 0 THEN 2 WHEN 1 THEN 102 WHEN 2 THEN 5 WHEN 3 THEN 105 ELSE 7 END"),
    ]),
    "jobs": ("{supplier}", [
        ("server_name", "'SRV' || CAST(s_suppkey % 3 AS STRING)"),
        ("job_id", "s_suppkey"),
        ("name", "CASE WHEN s_suppkey % 4 = 0 THEN 'backup ' || s_name ELSE s_name END"),
        ("enabled", "CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 1 END"),
        ("category_id", "s_nationkey"),
        ("notify_page_operator_id", "s_suppkey % 10"),
    ]),
    "job_steps": ("{part}", [
        ("job_id", "p_partkey % 100"),
        ("step_id", "CAST(FLOOR(p_partkey / 100) AS BIGINT) + 1"),
        ("step_name", "CASE WHEN p_partkey % 8 = 0 AND p_size % 10 = 0 THEN 'Delete Output File' ELSE p_name END"),
        ("subsystem", "CASE WHEN p_size % 2 = 0 THEN 'TSQL' ELSE 'PowerShell' END"),
        ("command", "CASE WHEN p_partkey % 4 = 0 THEN 'exec run_backup' ELSE p_type END"),
    ]),
    "job_history": ("{lineitem}", [
        ("instance_id", "l_orderkey * 1000000 + l_partkey * 8 + l_linenumber"),
        ("job_id", "l_suppkey"),
        ("step_id", "l_linenumber - 1"),
        ("run_status", "CAST(FLOOR(l_quantity) AS BIGINT) % 4"),
        ("run_date", "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT)"),
        ("run_time", "(l_orderkey % 24) * 10000 + (l_partkey % 60) * 100 + l_suppkey % 60"),
        ("run_duration", "(l_partkey % 3) * 10000 + (l_orderkey % 60) * 100 + l_partkey % 60"),
    ]),
    "schedules": ("{part}", [
        ("schedule_id", "p_partkey"),
        ("name", "'sched ' || CAST(p_partkey AS STRING)"),
        ("enabled", "CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 END"),
        ("freq_type", "CASE p_partkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 16 WHEN 4 THEN 32 "
                      "WHEN 5 THEN 64 ELSE 128 END"),
        ("freq_interval", "CASE WHEN p_partkey % 7 = 4 THEN 1 + p_size % 10 ELSE p_size END"),
        ("freq_relative_interval", "CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 16 END"),
        ("freq_recurrence_factor", "p_partkey % 4"),
        ("freq_subday_type", "CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END"),
        ("freq_subday_interval", "p_size"),
        ("active_start_time", "(p_partkey % 24) * 10000"),
        ("active_end_time", "235959"),
    ]),
    "job_schedules": ("{part}", [
        ("schedule_id", "p_partkey"),
        ("job_id", "p_partkey % 100"),
        ("next_run_date", "20240101 + p_partkey % 28"),
        ("next_run_time", "(p_partkey % 24) * 10000 + (p_partkey % 60) * 100"),
    ]),
    "categories": ("(SELECT * FROM {nation} WHERE n_nationkey % 6 <> 5) t", [
        ("category_id", "n_nationkey"),
        ("name", "'category ' || n_name"),
    ]),
    "job_servers": ("{supplier}", [
        ("job_id", "s_suppkey"),
        ("last_run_outcome", "s_suppkey % 3"),
        ("last_run_date", "20240101 + s_suppkey % 28"),
    ]),
    "databases": ("{nation}", [
        ("database_id", "n_nationkey"),
        ("name", "'DB' || CAST(n_nationkey AS STRING)"),
        ("compatibility_level", "80 + 10 * (n_nationkey % 8)"),
        ("is_query_store_on", "n_nationkey % 2"),
        ("state_desc", "CASE WHEN n_nationkey % 9 = 0 THEN 'OFFLINE' ELSE 'ONLINE' END"),
        ("recovery_model_desc", "CASE n_nationkey % 3 WHEN 0 THEN 'FULL' WHEN 1 THEN 'SIMPLE' ELSE 'BULK_LOGGED' END"),
        ("collation_name", "'Latin1_General_' || CASE WHEN n_nationkey % 2 = 0 THEN 'CI' ELSE 'CS' END || '_AS'"),
        ("snapshot_isolation_state", "n_nationkey % 2"),
        ("snapshot_isolation_state_desc", "CASE WHEN n_nationkey % 2 = 0 THEN 'OFF' ELSE 'ON' END"),
        ("is_read_committed_snapshot_on", "n_nationkey % 4"),
        ("target_recovery_time_in_seconds", "60 * (n_nationkey % 2)"),
    ]),
    "database_files": ("{part}", [
        ("database_id", "p_partkey % 25"),
        ("file_id", "p_partkey"),
        ("name", "'file' || CAST(p_partkey AS STRING)"),
        ("type_desc", "CASE WHEN p_size % 3 = 0 THEN 'LOG' ELSE 'ROWS' END"),
        ("data_space_id", "p_size % 7"),
        ("physical_name", "'/data/' || p_brand || '/' || CAST(p_partkey AS STRING) || '.mdf'"),
        ("size", "p_partkey * 128 + 1000"),
        ("used_pages", "p_partkey * 64 + 500"),
        ("growth", "p_size * 128"),
        ("is_percent_growth", "p_partkey % 2"),
        ("max_size", "CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 268435456 END"),
    ]),
    "filegroups": ("{region}", [
        ("data_space_id", "r_regionkey"),
        ("name", "r_name"),
    ]),
    "volume_stats": ("{database_files}", [
        ("database_id", "database_id"),
        ("file_id", "file_id"),
        ("logical_volume_name", "'VOL' || CAST(file_id % 40 AS STRING)"),
        ("volume_mount_point", "'/mnt/' || CAST(file_id % 40 AS STRING)"),
        ("available_bytes", "(file_id % 40) * 104857600 + 12345"),
    ]),
    "objects": ("{supplier}", [
        ("object_id", "s_suppkey"),
        ("name", "'tbl_' || CAST(s_suppkey AS STRING)"),
        ("is_ms_shipped", "CASE WHEN s_suppkey % 11 = 0 THEN 1 ELSE 0 END"),
        ("type", "CASE s_suppkey % 5 WHEN 0 THEN 'V' WHEN 1 THEN 'P' ELSE 'U' END"),
    ]),
    "indexes": ("{part}", [
        ("object_id", "p_partkey % 100"),
        ("index_id", "p_partkey"),
        ("name", "'ix_' || p_brand || '_' || CAST(p_partkey AS STRING)"),
        ("type_desc", "CASE WHEN p_partkey % 7 = 0 THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END"),
        ("database_id", "p_partkey % 30"),
        ("is_unique", "p_partkey % 2"),
        ("is_primary_key", "CASE WHEN p_partkey % 20 = 0 THEN 1 ELSE 0 END"),
        ("is_statistics", "CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END"),
        ("row_count", "p_partkey * 10"),
    ]),
    "index_columns": (
        "(SELECT l_partkey, l_linenumber, MIN(l_returnflag) AS rf FROM {lineitem} GROUP BY l_partkey, l_linenumber) t", [
            ("object_id", "l_partkey % 100"),
            ("index_id", "l_partkey"),
            ("index_column_id", "l_linenumber"),
            ("column_name", "'col' || CAST(l_linenumber AS STRING)"),
            ("is_included_column", "CASE WHEN rf = 'R' THEN 1 ELSE 0 END"),
        ]),
    # FIXTURES.md selects these rows with a WHERE clause; here every row of the
    # table is kept and the rows outside the rule get a NULL id, which no
    # join ever matches, so every report gives the same result.
    "index_usage_stats": ("(SELECT DISTINCT l_partkey FROM {lineitem}) t", [
        ("object_id", "CASE WHEN l_partkey % 3 <> 0 THEN l_partkey % 100 END"),
        ("index_id", "CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END"),
        ("user_seeks", "l_partkey % 50"),
        ("user_scans", "l_partkey % 20"),
        ("user_lookups", "l_partkey % 5"),
        ("last_user_seek", "CASE WHEN l_partkey % 2 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("last_user_scan", "CASE WHEN l_partkey % 3 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("last_user_lookup", "CASE WHEN l_partkey % 5 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("last_system_seek", "CASE WHEN l_partkey % 4 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("last_system_scan", "CASE WHEN l_partkey % 6 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("last_system_lookup", "CASE WHEN l_partkey % 7 = 0 THEN CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (l_partkey % 86400) AS TIMESTAMP) END"),
        ("system_seeks", "l_partkey % 3"),
        ("system_scans", "l_partkey % 4"),
        ("system_lookups", "l_partkey % 6"),
    ]),
    "procedure_stats": ("{lineitem}", [
        ("object_id", "CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END"),
        ("execution_count", "l_linenumber"),
    ]),
    "database_principals": ("{customer}", [
        ("sid", "c_custkey"),
        ("name", "c_name"),
        ("type_desc", "CASE WHEN c_custkey % 2 = 0 THEN 'SQL_USER' ELSE 'WINDOWS_USER' END"),
        ("authentication_type_desc", "CASE WHEN c_custkey % 4 = 0 THEN 'NONE' ELSE 'INSTANCE' END"),
    ]),
    "server_principals": ("{customer}", [
        ("sid", "CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_custkey END"),
        ("name", "c_name"),
    ]),
    "trace_rows": ("{events}", [
        ("database_name", "CASE WHEN event_id % 9 = 0 THEN 'tempdb' WHEN event_id % 13 = 0 THEN NULL "
                          "ELSE 'DB' || CAST(event_id % 25 AS STRING) END"),
        ("spid", "user_id"),
        ("start_time", "ts"),
        ("object_type", "CASE WHEN event_id % 8 = 0 THEN 21587 WHEN event_id % 17 = 0 THEN NULL "
                        "ELSE 8000 + event_id % 5 END"),
        ("event_class", "20 + event_id % 6"),
        ("text_data", "props"),
        ("server_name", "'SRV' || CAST(event_id % 5 AS STRING)"),
        ("object_name", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'obj' || CAST(event_id % 50 AS STRING) END"),
        ("login_name", "'login' || CAST(user_id % 30 AS STRING)"),
        ("application_name", "'app' || CAST(user_id % 7 AS STRING)"),
    ]),
    "schedulers": ("{supplier}", [
        ("scheduler_id", "s_suppkey * 3"),
        ("cpu_id", "s_suppkey"),
        ("runnable_tasks_count", "s_suppkey % 7"),
        ("pending_disk_io_count", "s_suppkey % 3"),
        ("current_tasks_count", "s_suppkey % 11"),
        ("current_workers_count", "s_suppkey % 13"),
        ("active_workers_count", "s_suppkey % 9"),
        ("work_queue_count", "s_suppkey % 5"),
    ]),
    "blocked_process_messages": ("{events}", [
        ("message_type_name", "CASE WHEN event_id % 50 = 49 THEN 'EndDialog' ELSE 'EventNotification' END"),
        ("event_ts", "ts"),
        ("message_body",
         "'<EVENT_INSTANCE><EventType>' || CASE WHEN event_type = 'signup' THEN 'OTHER' "
         "ELSE 'BLOCKED_PROCESS_REPORT' END || '</EventType><DatabaseID>' || CAST(user_id % 25 AS STRING) "
         "|| '</DatabaseID><PostTime>' || SUBSTRING(CAST(ts AS STRING), 1, 19) || '</PostTime><StartTime>' "
         "|| SUBSTRING(CAST(ts AS STRING), 1, 19) || '</StartTime><TextData>"
         "<blocked-process-report><blocked-process><process spid=\"' || CAST(user_id AS STRING) "
         "|| '\" waittime=\"' || CAST(CAST(FLOOR(value * 1000000) AS BIGINT) AS STRING) "
         "|| '\" waitresource=\"KEY: ' || CAST(user_id % 5 AS STRING) || '\" xactid=\"' "
         "|| CAST(user_id AS STRING) || '\" lockMode=\"S\" isolationlevel=\"' "
         "|| CASE WHEN user_id % 3 = 0 THEN 'serializable (4)' ELSE 'read committed (2)' END || '\"><executionStack><frame ' "
         "|| CASE WHEN event_id % 4 = 0 THEN '' ELSE 'stmtstart=\"4\" stmtend=\"44\" ' END "
         "|| 'sqlhandle=\"0x0' || CAST(user_id % 10 AS STRING) || '\"/></executionStack><inputbuf>select 1"
         "</inputbuf></process></blocked-process><blocking-process><process spid=\"' "
         "|| CAST(user_id + 1 AS STRING) || '\" status=\"sleeping\" trancount=\"1\"><executionStack><frame stmtstart=\"4\" "
         "stmtend=\"44\" sqlhandle=\"0x0' || CAST((user_id + 1) % 10 AS STRING) || '\"/></executionStack><inputbuf>update t "
         "set a = 1</inputbuf></process></blocking-process>"
         "</blocked-process-report></TextData></EVENT_INSTANCE>'"),
    ]),
    "wait_type_description": (
        "(VALUES ('PAGELATCH_UP', 'in-memory page latch'), ('PAGEIOLATCH_SH', 'page read from disk'), "
        "('LCK_M_X', 'exclusive lock')) t(a, b)", [
            ("wait_type", "a"),
            ("wait_type_desc", "b"),
        ]),
    "alert_contacts": ("{region}", [
        ("category", "CASE WHEN r_regionkey % 2 = 0 THEN 'DATABASE' ELSE 'NETWORK' END"),
        ("notify_primary", "CASE WHEN r_regionkey = 0 THEN 1 ELSE 0 END"),
        ("email", "lower(r_name) || '@example.com'"),
    ]),
    "helpdb_output": ("{nation}", [
        ("dbid", "n_nationkey"),
        ("db_size", "CAST(n_nationkey * 100 AS STRING) || ' MB'"),
        ("owner", "'owner' || CAST(n_regionkey AS STRING)"),
        ("created", "'Jan ' || CAST(1 + n_nationkey AS STRING) || ' 2020'"),
    ]),
    "os_info": ("{supplier}", [
        ("server_name", "s_name"),
        ("cpu_count", "4 + s_suppkey % 61"),
        ("hyperthread_ratio", "1 + s_suppkey % 8"),
        ("locked_page_allocations_kb", "CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey * 1024 END"),
        ("sqlserver_start_time", "CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (s_suppkey % 86400) AS TIMESTAMP)"),
    ]),
    "cpu_text_output": ("{supplier}", [
        ("server_name", "s_name"),
        ("output", "CASE s_suppkey % 3 WHEN 0 THEN 'LoadPercentage    : ' || CAST(s_suppkey % 100 AS STRING) "
                   "WHEN 1 THEN 'Manufacturer      : Generic' ELSE NULL END"),
    ]),
    "cpu_load": ("{events}", [
        ("server_name", "'SRV' || CAST(user_id AS STRING)"),
        ("ts", "ts"),
        ("load_percentage", "event_id * 31 % 101"),
    ]),
    "event_log": ("{events}", [
        ("server_name", "'SRV' || CAST(user_id AS STRING)"),
        ("ts", "ts"),
        ("message", "event_type || ' ' || props"),
    ]),
    "restore_history": ("{orders}", [
        ("destination_database_name", "'DB' || CAST(o_custkey % 25 AS STRING)"),
        ("restore_id", "o_orderkey"),
        ("restore_date", "o_orderdate"),
        ("user_name", "'login ' || CAST(o_custkey % 10 AS STRING)"),
        ("backup_set_id", "o_orderkey * 3"),
        ("restore_type", "CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'L' ELSE 'I' END"),
        ("replace", "o_orderkey % 2"),
    ]),
    "snapshot_transactions": ("{orders}", [
        ("transaction_id", "o_orderkey"),
        ("session_id", "o_custkey"),
        ("is_snapshot", "o_orderkey % 2"),
        ("elapsed_time_seconds", "o_orderkey * 7919 % 1000003"),
        ("transaction_sequence_num", "o_orderkey + 5"),
        ("commit_sequence_num", "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 9 END"),
        ("first_snapshot_sequence_num", "o_orderkey - 1"),
        ("max_version_chain_traversed", "o_orderkey % 17"),
        ("average_version_chain_traversed", "CAST(o_orderkey % 17 AS DOUBLE) / 2"),
    ]),
    "file_space_usage": ("{part}", [
        ("file_id", "p_partkey"),
        ("user_object_reserved_page_count", "p_partkey % 97"),
        ("internal_object_reserved_page_count", "p_partkey % 89"),
        ("version_store_reserved_page_count", "p_partkey % 83"),
    ]),
    "missing_index_details": ("{part}", [
        ("index_handle", "p_partkey"),
        ("object_id", "p_partkey % 100"),
        ("equality_columns", "p_brand"),
        ("statement", "p_name"),
    ]),
    "mail_profile": ("{region}", [
        ("profile_id", "r_regionkey"),
        ("name", "'profile ' || r_name"),
    ]),
    "mail_profileaccount": ("{nation}", [
        ("profile_id", "n_regionkey"),
        ("account_id", "n_nationkey"),
    ]),
    "mail_account": ("{nation}", [
        ("account_id", "n_nationkey"),
        ("name", "n_name"),
        ("email_address", "lower(n_name) || '@example.com'"),
        ("display_name", "n_name"),
    ]),
    "system_views": ("{part}", [
        ("name", "CASE p_partkey % 3 WHEN 0 THEN 'dm_xe_' WHEN 1 THEN 'server_event_s_' ELSE 'dm_os_' END "
                 "|| CAST(p_partkey AS STRING)"),
        ("is_ms_shipped", "p_size % 2"),
        ("create_date", "CAST(TIMESTAMP '2024-01-30 00:00:00' + INTERVAL '1' SECOND * (p_partkey % 86400) AS TIMESTAMP)"),
    ]),
    "trace_events": (
        "(VALUES (20, 'Audit Login Failed', 8), (21, 'EventLog', 3), (22, 'ErrorLog', 3), "
        "(23, 'Lock:Released', 4), (24, 'Lock:Acquired', 4)) t(a, b, c)", [
            ("trace_event_id", "a"),
            ("name", "b"),
            ("category_id", "c"),
        ]),
    "trace_categories": ("(VALUES (3, 'Errors and Warnings'), (4, 'Locks'), (8, 'Security Audit')) t(a, b)", [
        ("category_id", "a"),
        ("name", "b"),
    ]),
    "trace_subclass_values": ("(VALUES (20, 8000, 'Database'), (21, 8001, 'Object'), (23, 8003, 'Table')) t(a, b, c)", [
        ("trace_event_id", "a"),
        ("subclass_value", "b"),
        ("subclass_name", "c"),
    ]),
    "output_files": ("{events}", [
        ("path", "CASE WHEN event_id % 3 = 0 THEN '/dba/backup_' ELSE '/dba/other_' END || CAST(event_id AS STRING) "
                 "|| CASE WHEN event_id % 5 = 0 THEN '.log' ELSE '.txt' END"),
        ("modification_time", "ts"),
    ]),
    "grid_servers": ("{pages}", [
        ("server", "'SRV' || CAST(page_id % 10 AS STRING)"),
        ("url", "url"),
    ]),
    "server_config": ("{supplier}", [
        ("server_name", "s_name"),
        ("name", "'blocked process threshold'"),
        ("value_in_use", "s_suppkey % 4 * 20"),
        ("trace_flag", "1000 + s_suppkey % 9"),
        ("node_name", "'NODE' || CAST(s_nationkey AS STRING)"),
    ]),
    "objects_space": ("{lineitem}", [
        ("object_id", "l_suppkey"),
        ("reserved_pages", "CAST(FLOOR(l_quantity) AS BIGINT)"),
        ("data_pages", "l_linenumber"),
    ]),
}

# Relations added here beyond FIXTURES.md section 1, for operators it gives no input for:
# a second database's index catalog (the same, except that a first column with return
# flag 'A' is an included column there) and the job-activity listing (status per job).
RELATIONS.update({
    "index_columns_b": (
        "(SELECT l_partkey, l_linenumber, MIN(l_returnflag) AS rf FROM {lineitem} GROUP BY l_partkey, l_linenumber) t", [
            ("object_id", "l_partkey % 100"),
            ("index_id", "l_partkey"),
            ("index_column_id", "l_linenumber"),
            ("column_name", "'col' || CAST(l_linenumber AS STRING)"),
            ("is_included_column", "CASE WHEN rf = 'R' OR (rf = 'A' AND l_linenumber = 1) THEN 1 ELSE 0 END"),
        ]),
    "job_activity": ("{supplier}", [
        ("job_id", "s_suppkey"),
        ("execution_status", "CAST(1 + s_suppkey % 5 AS INT)"),
    ]),
})

# Fixed clock of FIXTURES.md section 2.
AS_OF_ACTIVITY = "2024-01-31 00:00:00"
AS_OF_BACKUP = "2001-08-02 00:00:00"

_PLACEHOLDER_NAMES = set(BASE_TABLES) | set(RELATIONS)


def _deps(name: str) -> list[str]:
    src = RELATIONS[name][0]
    return [t for t in _PLACEHOLDER_NAMES if "{" + t + "}" in src]


def _select_sql(name: str) -> str:
    src, cols = RELATIONS[name]
    body = ", ".join(f"{expr} AS {col}" for col, expr in cols)
    return f"SELECT {body} FROM {src}"


def _spark_sql_text(name: str) -> str:
    # Spark reads parquet timestamps as TIMESTAMP_NTZ; keep every fixture
    # timestamp NTZ so no session time zone enters the values.
    return _select_sql(name).replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")


def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one telemetry relation from the driver tables under ``sf_dir``."""
    args = {}
    for dep in _deps(name):
        if dep in RELATIONS:
            args[dep] = relation(spark, sf_dir, dep)
        else:
            args[dep] = base_table(spark, sf_dir, dep)
    return spark.sql(_spark_sql_text(name), **args)


class Relations:
    """Lazy accessor: ``rel = Relations(spark, sf_dir); rel.sessions``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in RELATIONS:
            raise AttributeError(name)
        return relation(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return base_table(self.spark, self.sf_dir, name)


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in _deps(n):
            if d in RELATIONS:
                visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


@lru_cache(maxsize=None)
def oracle_ctes(names: tuple[str, ...]) -> str:
    """``WITH`` prefix defining the given relations for the DuckDB oracle."""
    parts = []
    for n in _closure(names):
        src = _select_sql(n).format(**{t: t for t in _PLACEHOLDER_NAMES})
        parts.append(f"{n} AS ({src})")
    return "WITH " + ",\n".join(parts) + "\n"


def with_relations(names: tuple[str, ...], body: str) -> str:
    """Prefix an oracle SQL body with the CTEs of the relations it reads.

    A body with its own ``WITH`` is merged into the same clause.
    """
    prefix = oracle_ctes(tuple(names))
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + prefix[5:].rstrip() + ",\n" + stripped[15:]
    if stripped[:5].upper() == "WITH ":
        return prefix.rstrip() + ",\n" + stripped[5:]
    return prefix + body
