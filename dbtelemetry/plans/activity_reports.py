"""Registered activity and consumer reports."""

from __future__ import annotations

from dbtelemetry.operators import activity, consumers
from dbtelemetry.plans.catalog import report
from dbtelemetry.sources.fixtures import AS_OF_ACTIVITY


@report("current_waits", ("waiting_tasks", "sessions", "requests", "sql_text", "query_plan"), """
SELECT session_id, exec_context_id, wait_duration_ms, wait_type, blocking_session_id, resource_description,
       program_name, text, dbid, query_plan, cpu_time, memory_usage
FROM waiting_tasks
JOIN (SELECT session_id, program_name, cpu_time, memory_usage FROM sessions WHERE is_user_process = 1) USING (session_id)
JOIN (SELECT session_id, sql_handle, plan_handle FROM requests) USING (session_id)
LEFT JOIN (SELECT sql_handle, dbid, text FROM sql_text) USING (sql_handle)
LEFT JOIN query_plan USING (plan_handle)
""")
def _current_waits(rel):
    """Waiting tasks of user sessions with request text and plan."""
    return activity.current_waits(rel.waiting_tasks, rel.sessions, rel.requests, rel.sql_text, rel.query_plan)


@report("current_waits_described",
        ("waiting_tasks", "sessions", "requests", "sql_text", "wait_type_description", "databases"), """
WITH named_db AS (SELECT database_id AS dbid, name AS database_name FROM databases)
SELECT session_id, blocking_session_id, database_name, wait_type, wait_type_desc, text, resource_description,
       program_name
FROM (SELECT session_id, blocking_session_id, wait_type, resource_description FROM waiting_tasks)
JOIN wait_type_description USING (wait_type)
JOIN (SELECT session_id, program_name FROM sessions WHERE is_user_process = 1) USING (session_id)
JOIN (SELECT session_id, sql_handle FROM requests) USING (session_id)
LEFT JOIN (SELECT sql_handle, dbid, text FROM sql_text) USING (sql_handle)
LEFT JOIN named_db USING (dbid)
""")
def _current_waits_described(rel):
    """Waits with wait-type description (inner) and database name."""
    return activity.current_waits_described(rel.waiting_tasks, rel.sessions, rel.requests, rel.sql_text,
                                            rel.wait_type_description, rel.databases)


@report("active_sessions", ("sessions", "requests", "sql_text", "query_plan", "databases"), """
SELECT session_id, host_name, login_name, status, database_name, program_name, text, query_plan
FROM (SELECT session_id, host_name, login_name, status, database_id, program_name FROM sessions
      WHERE is_user_process = 1)
JOIN (SELECT session_id, sql_handle, plan_handle FROM requests) USING (session_id)
LEFT JOIN (SELECT sql_handle, text FROM sql_text) USING (sql_handle)
LEFT JOIN query_plan USING (plan_handle)
LEFT JOIN (SELECT database_id, name AS database_name FROM databases) USING (database_id)
""")
def _active_sessions(rel):
    """User sessions with a request, text and plan."""
    return activity.active_sessions(rel.sessions, rel.requests, rel.sql_text, rel.query_plan, rel.databases)


@report("running_requests", ("requests", "sessions", "sql_text", "databases", "objects"), f"""
WITH live AS (
  SELECT q.*, u.host_name, u.client_interface_name, u.program_name, u.login_name, u.status AS session_status,
         u.last_request_start_time, t.text, t.objectid,
         CASE WHEN q.statement_end_offset = -1 THEN 2 * length(t.text) ELSE q.statement_end_offset END AS end_byte
  FROM requests q
  JOIN sessions u ON u.session_id = q.session_id AND u.is_user_process = 1
  JOIN sql_text t ON t.sql_handle = q.sql_handle),
cut AS (SELECT *, statement_start_offset // 2 + 1 AS first_char,
               (end_byte - statement_start_offset) // 2 + 1 AS n_chars FROM live)
SELECT (SELECT o.name FROM objects o WHERE o.object_id = cut.objectid) AS object_name,
       CASE WHEN n_chars < 0 THEN NULL ELSE substring(text, first_char, n_chars) END AS statement_text,
       d.name AS database_name, cpu_time,
       date_diff('minute', last_request_start_time, TIMESTAMP '{AS_OF_ACTIVITY}') AS running_minutes,
       percent_complete, host_name AS running_from, client_interface_name AS running_by, session_id,
       blocking_session_id AS blocking_with, reads, writes, program_name, login_name, session_status AS status,
       last_request_start_time, logical_reads
FROM cut LEFT JOIN databases d USING (database_id)
""")
def _running_requests(rel):
    """Running statements with statement text and minutes since last request start."""
    return activity.running_requests(rel.requests, rel.sessions, rel.sql_text, rel.databases, AS_OF_ACTIVITY, rel.objects)


@report("root_blockers", ("locks",), """
WITH clash AS (
  SELECT x.request_session_id AS sid, x.request_status AS st
  FROM locks x, locks y
  WHERE x.resource_associated_entity_id = y.resource_associated_entity_id
    AND x.resource_description IS NOT DISTINCT FROM y.resource_description
    AND x.request_status <> y.request_status),
holders AS (SELECT DISTINCT sid FROM clash WHERE st = 'GRANT'),
waiters AS (SELECT DISTINCT sid FROM clash WHERE st = 'WAIT')
SELECT sid AS request_session_id FROM holders WHERE sid NOT IN (SELECT sid FROM waiters)
""")
def _root_blockers(rel):
    """Sessions holding a conflicting lock while waiting on none (one-pass form)."""
    return activity.root_blockers(rel.locks)


@report("session_status", ("processes", "sql_text", "databases"), """
SELECT spid, status, loginame, hostname, program_name, blocked, open_tran, dbname, cmd, waittype, waittime, last_batch,
       text
FROM processes
JOIN (SELECT sql_handle, text FROM sql_text) USING (sql_handle)
LEFT JOIN (SELECT database_id AS dbid, name AS dbname FROM databases) USING (dbid)
""")
def _session_status(rel):
    """Process rows with database name and batch text, all sessions."""
    return activity.session_status(rel.processes, rel.sql_text, rel.databases)


@report("blocked_pairs", ("processes", "sql_text"), f"""
WITH buffer AS (SELECT spid, text AS event_info FROM processes JOIN sql_text USING (sql_handle)),
waiting AS (SELECT spid, blocked AS blocked1, waittype, waittime, lastwaittype, waitresource, dbid, cpu, physical_io,
                   memusage, open_tran, cmd, loginame FROM processes
            WHERE blocked <> 0 AND waittime > 60000),
chain AS (SELECT w.*, p.blocked AS blocked2 FROM waiting w JOIN processes p ON p.spid = w.blocked1)
SELECT TIMESTAMP '{AS_OF_ACTIVITY}' AS creation_date, chain.spid, blocked1, blocked2, waittype, waittime,
       lastwaittype, waitresource, dbid, cpu, physical_io, memusage, open_tran, cmd, loginame,
       (SELECT event_info FROM buffer WHERE buffer.spid = chain.spid) AS query_blocked,
       (SELECT event_info FROM buffer WHERE buffer.spid = chain.blocked1) AS query_blocked_by1,
       CASE WHEN blocked2 > 0 THEN (SELECT event_info FROM buffer WHERE buffer.spid = chain.blocked2) END
         AS query_blocked_by2
FROM chain
""")
def _blocked_pairs(rel):
    """Blocked sessions over 60 s with blocker, second-level blocker and their input buffers."""
    buffers = activity.input_buffers(rel.processes, rel.sql_text)
    return activity.blocked_pairs(rel.processes, buffers, AS_OF_ACTIVITY, min_wait_s=60)


@report("requests_by_command", ("requests", "databases"), """
SELECT percent_complete, session_id, command, database_name, dop, blocking_session_id, wait_type
FROM requests LEFT JOIN (SELECT database_id, name AS database_name FROM databases) USING (database_id)
WHERE lower(command) LIKE '%restore%' OR lower(command) LIKE '%backup%'
""")
def _requests_by_command(rel):
    """Backup and restore requests with progress."""
    return activity.requests_by_command(rel.requests, rel.databases)


@report("statement_of", ("processes", "sql_text"), """
SELECT spid, text FROM processes JOIN (SELECT sql_handle, text FROM sql_text) USING (sql_handle)
""")
def _statement_of(rel):
    """Batch text of every session's handle."""
    return activity.statement_of(rel.processes, rel.sql_text)


@report("kill_statements", ("processes", "databases"), """
SELECT name AS database_name, spid, concat('kill ', spid::VARCHAR, ' -- ') || loginame AS kill_statement
FROM processes JOIN (SELECT database_id AS dbid, name FROM databases) USING (dbid)
""")
def _kill_statements(rel):
    """Kill statement text per session, for all databases."""
    return activity.kill_statements(rel.processes, rel.databases)


def _top_sql(measure: str, with_handle: bool = False) -> str:
    handle = "sql_handle, " if with_handle else ""
    return f"""
WITH ranked AS (
  SELECT * FROM query_stats WHERE sql_handle IN (SELECT sql_handle FROM sql_text)
  ORDER BY {measure} DESC, sql_handle, plan_handle, statement_start_offset, statement_end_offset LIMIT 10)
SELECT {handle}{measure}, dbid, name AS db_name, text
FROM ranked JOIN (SELECT sql_handle, dbid, text FROM sql_text) USING (sql_handle)
LEFT JOIN (SELECT database_id AS dbid, name FROM databases) USING (dbid)
"""


_TOP_NAMES = {
    "execution_count": "top_queries_by_executions",
    "total_elapsed_time": "top_queries_by_duration",
    "total_worker_time": "top_queries_by_cpu",
    "total_logical_reads": "top_queries_by_reads",
    "total_logical_writes": "top_queries_by_writes",
    "plan_generation_num": "top_queries_by_recompiles",
}


def _register_top(measure: str, name: str):
    @report(name, ("query_stats", "sql_text", "databases"),
            _top_sql(measure, with_handle=measure == "total_worker_time"))
    def _build(rel):
        return consumers.top_queries(rel.query_stats, rel.sql_text, rel.databases, measure)

    _build.__doc__ = f"Top 10 statements by {measure}, with text."


for _m, _n in _TOP_NAMES.items():
    _register_top(_m, _n)


@report("log_consumers", ("database_transactions", "session_transactions", "requests", "sql_text", "databases"), """
WITH expanded AS (
  SELECT dt.transaction_id, dt.database_id, dt.begin_time, dt.log_bytes_reserved, dt.log_record_count,
         dt.state, dt.log_bytes_used_system, dt.log_bytes_reserved_system,
         q.session_id, q.request_id, t.text
  FROM database_transactions dt
  JOIN session_transactions USING (transaction_id)
  JOIN requests q USING (session_id)
  JOIN sql_text t ON t.sql_handle = q.sql_handle)
SELECT database_id, d.name AS db_name, text, begin_time, state, log_bytes_used_system, log_bytes_reserved,
       log_bytes_reserved_system, log_record_count, session_id, request_id
FROM expanded LEFT JOIN databases d USING (database_id)
ORDER BY log_record_count DESC, transaction_id, database_id, begin_time, log_bytes_reserved, state,
         log_bytes_used_system, log_bytes_reserved_system, session_id, request_id
LIMIT 10
""")
def _log_consumers(rel):
    """Top 10 transactions by log records with request text."""
    return consumers.log_consumers(rel.database_transactions, rel.session_transactions, rel.requests,
                                   rel.sql_text, rel.databases)
