"""Registered job, TempDB, trace and inventory reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from dbtelemetry.operators import inventory, jobs, tempdb
from dbtelemetry.plans.catalog import report
from dbtelemetry.plans.schema_reports import html_oracle
from dbtelemetry.sources import html, readers, sinks
# The trace report covers "today"; the last captured day of the event fixtures.
TRACE_AS_OF = "2024-01-30 00:00:00"

# ---------------------------------------------------------------- jobs

_FAILED_SQL = """
SELECT j.server_name, j.name AS job_name, srv.last_run_date, h.step_id
FROM (SELECT server_name, job_id, name FROM jobs SEMI JOIN categories USING (category_id) WHERE enabled = 1) j
JOIN (SELECT job_id, last_run_date FROM job_servers WHERE last_run_outcome = 0) srv USING (job_id)
JOIN (SELECT job_id FROM job_schedules JOIN (SELECT schedule_id FROM schedules WHERE enabled = 1) USING (schedule_id))
  USING (job_id)
JOIN (SELECT job_id, step_id FROM job_history WHERE run_status = 0 AND step_id <> 0) h USING (job_id)
"""


@report("failed_jobs", ("jobs", "job_servers", "job_schedules", "schedules", "job_history", "categories"), _FAILED_SQL)
def _failed_jobs(rel):
    """Failed steps of enabled scheduled jobs whose last run failed."""
    return jobs.failed_jobs(rel.jobs, rel.job_servers, rel.job_schedules, rel.schedules, rel.job_history, rel.categories)


_FAILED_ORDER = ("server_name", "job_name", "step_id", "last_run_date")


@report("failed_jobs_html", ("jobs", "job_servers", "job_schedules", "schedules", "job_history", "categories"),
        html_oracle(_FAILED_SQL, ("server_name", "job_name", "last_run_date", "step_id"), jobs.FAILED_HEADERS, _FAILED_ORDER,
                    "100%", "blue", title=jobs.FAILED_TITLE))
def _failed_jobs_html(rel):
    """The failed-jobs mail as an HTML table in ordered parts."""
    failed = jobs.failed_jobs(rel.jobs, rel.job_servers, rel.job_schedules, rel.schedules, rel.job_history, rel.categories)
    return html.document_parts(jobs.failed_jobs_rows(failed), jobs.FAILED_HEADERS, _FAILED_ORDER, title=jobs.FAILED_TITLE)


@report("failed_jobs_status", ("jobs", "job_servers", "job_schedules", "schedules", "job_history", "categories"), f"""
SELECT CAST(count(*) AS BIGINT) AS failed_rows,
       CASE WHEN count(*) > 0 THEN '{jobs.FAILED_TITLE}' ELSE '{jobs.FAILED_NONE}' END AS subject
FROM ({_FAILED_SQL}) t
""")
def _failed_jobs_status(rel):
    """The alert gate: one row with the failed-row count and the mail subject."""
    f = jobs.failed_jobs(rel.jobs, rel.job_servers, rel.job_schedules, rel.schedules, rel.job_history, rel.categories)
    return f.agg(F.count(F.lit(1)).alias("failed_rows")).select(
        "failed_rows", F.when(F.col("failed_rows") > 0, F.lit(jobs.FAILED_TITLE))
        .otherwise(F.lit(jobs.FAILED_NONE)).alias("subject"))


_SUMMARY_SQL = """
outcomes AS (
  SELECT job_id, map_from_entries(list({k: run_status, v: n})) AS n_of, arg_max(newest, newest.instance_id) AS newest
  FROM (SELECT job_id, run_status, count(*) AS n,
               max({instance_id: instance_id, dur: run_duration, d: run_date, t: run_time}) AS newest
        FROM job_history WHERE step_id = 0 GROUP BY job_id, run_status) GROUP BY job_id),
retries AS (SELECT job_id, sum((run_status = 2)::INTEGER)::BIGINT AS retry FROM job_history GROUP BY job_id),
job_summary AS (
  SELECT r.job_id, coalesce(n_of[1], 0) AS success, coalesce(n_of[3], 0) AS cancel, coalesce(n_of[0], 0) AS fail, r.retry,
         newest.instance_id AS last_execution_id,
         nullif(concat_ws(':', lpad((newest.dur // 10000)::VARCHAR, 2, '0'), lpad((newest.dur // 100 % 100)::VARCHAR, 2, '0'),
                          lpad((newest.dur % 100)::VARCHAR, 2, '0')), '') AS last_duration,
         coalesce(make_timestamp(newest.d // 10000, newest.d // 100 % 100, newest.d % 100, newest.t // 10000,
                                 newest.t // 100 % 100, (newest.t % 100)::DOUBLE), TIMESTAMP '1900-01-01') AS last_execution_start
  FROM retries r LEFT JOIN outcomes o USING (job_id))"""


@report("job_history_summary", ("job_history",), "WITH " + _SUMMARY_SQL + "\nSELECT * FROM job_summary")
def _job_history_summary(rel):
    """Outcome counts and last execution per job."""
    return jobs.job_history_summary(rel.job_history)


def _pad6(x: str) -> str:
    return f"CASE WHEN length({x}::VARCHAR) <= 6 THEN lpad({x}::VARCHAR, 6, '0') END"


# The VALUES lists are fixed values: the schedule words that the report must show, as in operators/jobs.py.
_DECODE_SQL = f"""
day_bits(bit, day) AS (VALUES (1, 'Sunday'), (2, 'Monday'), (4, 'Tuesday'), (8, 'Wednesday'), (16, 'Thursday'),
                             (32, 'Friday'), (64, 'Saturday')),
ordinal(code, word) AS (VALUES (1, 'First'), (2, 'Second'), (4, 'Third'), (8, 'Fourth'), (16, 'Last')),
day_kind(code, word) AS (VALUES (1, ' Sunday'), (2, ' Monday'), (3, ' Tuesday'), (4, ' Wednesday'), (5, ' Thursday'),
                               (6, ' Friday'), (7, ' Saturday'), (8, ' Day'), (9, ' Weekday'), (10, ' Weekend')),
unit(code, word) AS (VALUES (2, ' seconds'), (4, ' minutes'), (8, ' hours')),
active AS (
  SELECT s.*, js.job_id, js.next_run_date, js.next_run_time,
         (SELECT string_agg(day, ', ' ORDER BY bit) FROM day_bits WHERE s.freq_interval & bit <> 0) AS day_list,
         CASE WHEN s.freq_recurrence_factor = 1 THEN '; weekly'
              WHEN s.freq_recurrence_factor <> 0 THEN printf('; every %d weeks', s.freq_recurrence_factor) END
           AS every_weeks,
         CASE WHEN s.freq_recurrence_factor = 1 THEN '; monthly'
              WHEN s.freq_recurrence_factor <> 0 THEN printf('; every %d months', s.freq_recurrence_factor) END
           AS every_months
  FROM schedules s JOIN job_schedules js USING (schedule_id) WHERE s.enabled = 1),
decoded AS (
SELECT a.name AS schedule_name, a.schedule_id, a.job_id,
  CASE a.freq_type
    WHEN 1 THEN 'Once'
    WHEN 4 THEN CASE WHEN a.freq_interval = 1 THEN 'Daily' ELSE printf('Every %d days', a.freq_interval) END
    WHEN 8 THEN a.day_list || a.every_weeks
    WHEN 16 THEN printf('On day %d of every %d months', a.freq_interval, a.freq_recurrence_factor)
    WHEN 32 THEN o.word || k.word || a.every_months
    WHEN 64 THEN 'StartUp'
    WHEN 128 THEN 'Idle'
  END AS frequency,
  coalesce('Every ' || a.freq_subday_interval::VARCHAR || u.word, 'Once') AS sub_frequency,
  {_pad6('a.active_start_time')} AS start_time,
  {_pad6('a.active_end_time')} AS end_time,
  {_pad6('a.next_run_time')} AS next_run_time,
  CASE WHEN length(a.next_run_date::VARCHAR) <= 8 THEN rpad(a.next_run_date::VARCHAR, 8, ' ') ELSE '*' END
    AS next_run_date
FROM active a
LEFT JOIN ordinal o ON o.code = a.freq_relative_interval
LEFT JOIN day_kind k ON k.code = a.freq_interval
LEFT JOIN unit u ON u.code = a.freq_subday_type)"""


@report("decode_schedules", ("schedules", "job_schedules"), "WITH " + _DECODE_SQL + "\nSELECT * FROM decoded")
def _decode_schedules(rel):
    """Enabled job schedules decoded to text."""
    return jobs.decode_schedules(rel.schedules, rel.job_schedules)


@report("job_report", ("jobs", "schedules", "job_schedules", "job_history"), "WITH " + _SUMMARY_SQL + ",\n"
        + _DECODE_SQL + """
SELECT j.server_name, j.job_id, j.name AS job_name,
       CASE j.enabled WHEN 1 THEN 'Enabled' ELSE 'Disabled' END AS job_status,
       coalesce(d.schedule_name, '(unscheduled)') AS schedule_name,
       coalesce(d.frequency, '') AS frequency, coalesce(d.sub_frequency, '') AS sub_frequency,
       coalesce(d.start_time[1:2] || ':' || d.start_time[3:4] || ' - ' || d.end_time[1:2] || ':' || d.end_time[3:4], '')
         AS schedule_time,
       coalesce(d.next_run_date[1:4] || '/' || d.next_run_date[5:6] || '/' || d.next_run_date[7:8] || ' '
                || d.next_run_time[1:2] || ':' || d.next_run_time[3:4], '') AS next_run_date,
       coalesce(h.success, 0) AS success, coalesce(h.cancel, 0) AS cancel, coalesce(h.fail, 0) AS fail,
       coalesce(h.retry, 0) AS retry, coalesce(h.last_execution_id, 0) AS last_execution_id,
       h.last_execution_start, coalesce(h.last_duration, '00:00:01') AS last_duration,
       printf('EXECUTE msdb.dbo.sp_update_job @job_id = ''%s'', @enabled = 0;', j.job_id::VARCHAR)
         AS disable_script
FROM (SELECT * FROM jobs WHERE enabled = 1) j
LEFT JOIN decoded d USING (job_id)
LEFT JOIN job_summary h USING (job_id)
""")
def _job_report(rel):
    """Job status report: schedules decoded, history summarised, disable statement per job."""
    decoded = jobs.decode_schedules(rel.schedules, rel.job_schedules)
    summary = jobs.job_history_summary(rel.job_history)
    return jobs.job_report(rel.jobs, decoded, summary)


_MISSING_STEP_SQL = """
SELECT job_id, name AS job_name FROM jobs
WHERE lower(name) LIKE 'backup%'
  AND job_id IN (SELECT job_id FROM job_steps WHERE lower(command) LIKE '%backup%')
  AND job_id NOT IN (SELECT job_id FROM job_steps WHERE lower(step_name) LIKE '%output%' AND job_id IS NOT NULL)
"""


@report("jobs_missing_output_step", ("jobs", "job_steps"), _MISSING_STEP_SQL)
def _jobs_missing_step(rel):
    """Backup jobs without an output-file cleanup step."""
    return jobs.jobs_missing_step(rel.jobs, rel.job_steps)


@report("job_steps_report", ("jobs", "job_steps"), f"""
SELECT job_name, step_name, step_id, subsystem, command
FROM ({_MISSING_STEP_SQL}) JOIN job_steps USING (job_id)
""")
def _job_steps_report(rel):
    """Steps of the backup jobs lacking a cleanup step (read-back listing)."""
    missing = jobs.jobs_missing_step(rel.jobs, rel.job_steps)
    return jobs.job_steps_report(rel.jobs, rel.job_steps, missing)


# ---------------------------------------------------------------- TempDB

@report("user_waits", ("waiting_tasks", "sessions"), """
SELECT session_id, wait_duration_ms, wait_type, resource_description
FROM waiting_tasks JOIN (SELECT session_id FROM sessions WHERE is_user_process = 1) USING (session_id)
""")
def _user_waits(rel):
    """Waiting tasks of user sessions."""
    return tempdb.user_waits(rel.waiting_tasks, rel.sessions)


@report("contention_counts", ("waiting_tasks", "sessions"), """
SELECT resource_description, count(*) AS rowcount
FROM waiting_tasks JOIN (SELECT session_id FROM sessions WHERE is_user_process = 1) USING (session_id)
WHERE resource_description = '2:1:1' GROUP BY ALL
""")
def _contention_counts(rel):
    """User waits on the first PFS page of TempDB."""
    return tempdb.contention_counts(rel.waiting_tasks, rel.sessions)


@report("allocation_page_type", ("waiting_tasks",), """
WITH latch AS (
  SELECT session_id, wait_type, wait_duration_ms, blocking_session_id, resource_description,
         TRY_CAST(split_part(resource_description, ':', 3) AS INTEGER) AS pg
  FROM waiting_tasks WHERE wait_type ILIKE 'PAGE%LATCH_%' AND starts_with(resource_description, '2:')),
flags AS (SELECT *, pg = 1 OR pg % 8088 = 0 AS is_pfs, pg = 2 OR pg % 511232 = 0 AS is_gam,
                 pg = 3 OR (pg - 1) % 511232 = 0 AS is_sgam FROM latch)
SELECT session_id, wait_type, wait_duration_ms, blocking_session_id, resource_description,
       CASE WHEN is_pfs THEN 'Is PFS Page' WHEN is_gam THEN 'Is GAM Page' WHEN is_sgam THEN 'Is SGAM Page'
            ELSE 'Is Not PFS, GAM, or SGAM page' END AS resource_type
FROM flags
""")
def _allocation_page_type(rel):
    """Page-latch waits in TempDB classified by allocation page type."""
    return tempdb.allocation_page_type(rel.waiting_tasks)


@report("tempdb_sessions", ("task_space_usage", "requests", "sql_text", "query_plan"), """
WITH totals AS (SELECT session_id, request_id, sum(alloc_pages)::BIGINT AS a, sum(dealloc_pages)::BIGINT AS d
                FROM task_space_usage GROUP BY ALL),
joined AS (
  SELECT totals.*, q.statement_start_offset AS so, q.statement_end_offset AS eo, t.text, p.query_plan
  FROM totals JOIN requests q USING (session_id, request_id)
  LEFT JOIN sql_text t ON t.sql_handle = q.sql_handle
  LEFT JOIN query_plan p ON p.plan_handle = q.plan_handle
  WHERE t.text IS NOT NULL OR p.query_plan IS NOT NULL),
bounds AS (SELECT *, so // 2 AS pos, CASE WHEN eo < so THEN 0 ELSE (eo - so) // 2 END AS n FROM joined),
cut AS (SELECT *, CASE WHEN pos >= 1 THEN substring(text, pos, n)
                       WHEN pos + n - 1 > 0 THEN substring(text, 1, pos + n - 1) ELSE '' END AS piece FROM bounds)
SELECT session_id, a / 128.0::DOUBLE AS internal_object_mb, d / 128.0::DOUBLE AS internal_object_dealloc_mb, text,
       CASE WHEN rtrim(piece) = '' OR piece IS NULL THEN text ELSE piece END AS statement_text, query_plan
FROM cut
""")
def _tempdb_sessions(rel):
    """Internal-object space per request with statement text and plan."""
    return tempdb.tempdb_sessions(rel.task_space_usage, rel.requests, rel.sql_text, rel.query_plan)


@report("tempdb_requests", ("task_space_usage", "requests"), """
WITH totals AS (SELECT session_id, request_id, sum(alloc_pages)::BIGINT AS task_alloc,
                       sum(dealloc_pages)::BIGINT AS task_dealloc
                FROM task_space_usage GROUP BY ALL HAVING sum(alloc_pages) + sum(dealloc_pages) > 0)
SELECT session_id, request_id, task_alloc, task_dealloc, sql_handle, statement_start_offset, statement_end_offset,
       plan_handle
FROM totals JOIN requests USING (session_id, request_id)
""")
def _tempdb_requests(rel):
    """Requests with internal-object allocations."""
    return tempdb.tempdb_requests(rel.task_space_usage, rel.requests)


@report("tempdb_space", ("file_space_usage",), """
SELECT (8 * sum(user_object_reserved_page_count))::BIGINT AS user_object_reserved_kb,
       (8 * sum(internal_object_reserved_page_count))::BIGINT AS internal_object_reserved_kb,
       (8 * sum(version_store_reserved_page_count))::BIGINT AS version_store_kb
FROM file_space_usage
""")
def _tempdb_space(rel):
    """TempDB reserved space by consumer."""
    return tempdb.tempdb_space(rel.file_space_usage)


@report("long_snapshot_transactions", ("snapshot_transactions",), """
SELECT transaction_id, transaction_sequence_num, commit_sequence_num, session_id, is_snapshot, first_snapshot_sequence_num,
       max_version_chain_traversed, average_version_chain_traversed, elapsed_time_seconds FROM snapshot_transactions
ORDER BY elapsed_time_seconds DESC
""")
def _long_snapshot(rel):
    """Active snapshot transactions, longest first."""
    return tempdb.long_snapshot_transactions(rel.snapshot_transactions)


@report("snapshot_settings", ("databases",), """
SELECT name, database_id, snapshot_isolation_state, snapshot_isolation_state_desc, is_read_committed_snapshot_on
FROM databases
""")
def _snapshot_settings(rel):
    """Row-versioning settings per database."""
    return tempdb.snapshot_settings(rel.databases)


@report("session_query", ("sessions", "requests", "sql_text", "query_plan"), """
SELECT session_id, text, query_plan
FROM (SELECT session_id FROM sessions)
LEFT JOIN (SELECT session_id, sql_handle, plan_handle FROM requests) USING (session_id)
LEFT JOIN (SELECT sql_handle, text FROM sql_text) USING (sql_handle)
LEFT JOIN query_plan USING (plan_handle)
""")
def _session_query(rel):
    """Text and plan of every session's requests, idle sessions kept."""
    return tempdb.session_query(rel.sessions, rel.requests, rel.sql_text, rel.query_plan)


# ---------------------------------------------------------------- trace, principals, inventory

_TRACE_SQL = f"""
WITH today AS (
  SELECT * FROM trace_rows
  WHERE spid > 50 AND object_type <> 21587 AND database_name <> 'tempdb'
    AND start_time >= date_trunc('day', TIMESTAMP '{TRACE_AS_OF}')
    AND start_time < date_trunc('day', TIMESTAMP '{TRACE_AS_OF}') + INTERVAL 1 DAY)
SELECT r.server_name, r.object_name, r.login_name, r.application_name, r.database_name, r.spid, r.start_time, r.object_type AS object_type_id, sub.subclass_name AS object_type,
       ev.category_id, cat.name AS category, r.event_class AS event_id, ev.name AS event_name, r.text_data
FROM today r
JOIN trace_events ev ON ev.trace_event_id = r.event_class
JOIN trace_categories cat ON cat.category_id = ev.category_id
LEFT JOIN trace_subclass_values sub ON sub.trace_event_id = r.event_class AND sub.subclass_value = r.object_type
"""
_TRACE_RELATIONS = ("trace_rows", "trace_subclass_values", "trace_events", "trace_categories")


@report("trace_from_files", _TRACE_RELATIONS, _TRACE_SQL)
def _trace_from_files(rel):
    """S3: the trace exported as rollover files, read back by the path of its current file, then the day's events."""
    folder = sinks.new_folder(rel.trace_rows.sparkSession)
    for n in range(3):
        part = rel.trace_rows.filter(F.pmod(F.xxhash64("start_time"), F.lit(3)) == n)
        part.write.parquet(f"{folder}/log_{n + 1}.trc.parquet")
    files = readers.trace_rollover_glob(f"{folder}/log_3.trc", ".parquet")
    trace = readers.trace_source(rel.trace_rows.sparkSession, files)
    return inventory.default_trace_today(trace, rel.trace_subclass_values, rel.trace_events, rel.trace_categories, TRACE_AS_OF)


@report("default_trace_today", _TRACE_RELATIONS, _TRACE_SQL)
def _default_trace(rel):
    """Default-trace events of the day with names."""
    return inventory.default_trace_today(rel.trace_rows, rel.trace_subclass_values, rel.trace_events,
                                         rel.trace_categories, TRACE_AS_OF)


@report("orphaned_users", ("database_principals", "server_principals"), """
SELECT type_desc, sid, name AS user_name FROM database_principals u
WHERE authentication_type_desc = 'INSTANCE' AND NOT EXISTS (SELECT 1 FROM server_principals l WHERE l.sid = u.sid)
""")
def _orphaned_users(rel):
    """Database users without a matching server login."""
    return inventory.orphaned_users(rel.database_principals, rel.server_principals)


@report("database_overview", ("databases", "helpdb_output"), """
SELECT name AS database_name, db_size AS size, owner, compatibility_level AS compatibility,
       is_query_store_on AS query_store_on, state_desc AS database_state, recovery_model_desc AS recovery_model,
       created AS create_date, collation_name, snapshot_isolation_state_desc AS snapshot_isolation_state,
       is_read_committed_snapshot_on AS read_committed_snapshot, target_recovery_time_in_seconds
FROM (SELECT * FROM databases WHERE database_id >= 5)
JOIN (SELECT dbid AS database_id, db_size, owner, created FROM helpdb_output) USING (database_id)
""")
def _database_overview(rel):
    """User databases with size, owner and settings."""
    return inventory.database_overview(rel.databases, rel.helpdb_output)


@report("mail_profiles", ("mail_profile", "mail_profileaccount", "mail_account"), """
SELECT account_id, profile_id, a.name, email_address, display_name, p.name AS profile_name
FROM mail_profileaccount
JOIN mail_profile p USING (profile_id)
JOIN mail_account a USING (account_id)
""")
def _mail_profiles(rel):
    """Mail accounts with their profiles."""
    return inventory.mail_profiles(rel.mail_profile, rel.mail_profileaccount, rel.mail_account)


@report("system_views", ("system_views",), """
SELECT name, create_date, is_ms_shipped FROM system_views
WHERE lower(name) LIKE '%dm_xe%' OR (is_ms_shipped = 1 AND lower(name) LIKE '%server_event_s%')
""")
def _system_views(rel):
    """Extended-events system views."""
    return inventory.system_views(rel.system_views)


@report("alert_recipients", ("alert_contacts",), """
SELECT email FROM alert_contacts WHERE notify_primary = 1 AND category = 'DATABASE'
""")
def _alert_recipients(rel):
    """Primary contacts for database alerts."""
    return inventory.alert_recipients(rel.alert_contacts)


@report("pool_names", ("grid_servers",), """
SELECT server, regexp_extract(url, '([^/]*)$', 1) AS pool_name FROM grid_servers
""")
def _pool_names(rel):
    """Application-pool name per server from its URL."""
    return inventory.pool_names(rel.grid_servers)


@report("drop_user_statements", ("database_principals",), """
SELECT printf('sp_dropuser [%s] GO ', name) AS drop_statement FROM database_principals WHERE name IS NOT NULL
""")
def _drop_user_statements(rel):
    """Drop-user statements for every database user."""
    return inventory.drop_user_statements(rel.database_principals)


@report("enabled_trace_flags", ("server_config",), "SELECT server_name, trace_flag FROM server_config")
def _trace_flags(rel):
    """Trace flags per server."""
    return inventory.enabled_trace_flags(rel.server_config)


@report("cluster_nodes", ("server_config",), "SELECT server_name, node_name FROM server_config")
def _cluster_nodes(rel):
    """Cluster nodes per server."""
    return inventory.cluster_nodes(rel.server_config)


@report("blocked_process_threshold", ("server_config",), """
SELECT server_name, name, value_in_use FROM server_config WHERE name = 'blocked process threshold'
""")
def _server_settings(rel):
    """The blocked-process threshold setting per server."""
    return inventory.server_settings(rel.server_config, "blocked process threshold")



@report("running_jobs", ("jobs", "job_activity"), """
SELECT server_name, job_id, name, enabled, category_id, notify_page_operator_id, execution_status
FROM jobs JOIN (SELECT * FROM job_activity WHERE execution_status = 1) USING (job_id)
""")
def _running_jobs(rel):
    """Jobs currently executing."""
    return jobs.running_jobs(rel.jobs, rel.job_activity)
