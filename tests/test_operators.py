"""Operator traps on hand-made rows (FIXTURES section 4) and formulation equivalences."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dbtelemetry.operators import activity, backups, consumers, jobs, schema_health, storage
from dbtelemetry.sources import readers, sinks
from dbtelemetry.sources.fixtures import relation

from conftest import SF_SMALL

LOCKS = "request_session_id long, resource_associated_entity_id long, resource_description string, " \
        "request_status string"


def ids(df, col="request_session_id"):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is None, v))


def test_root_blocker_null_resource_is_null_safe(spark):
    locks = spark.createDataFrame([(1, 10, None, "GRANT"), (2, 10, None, "WAIT")], LOCKS)
    assert ids(activity.root_blockers(locks)) == [1]


def test_root_blocker_null_waiting_session_empties_result(spark):
    locks = spark.createDataFrame([(1, 10, "a", "GRANT"), (None, 10, "a", "WAIT"), (3, 11, "b", "GRANT"),
                                   (4, 11, "b", "WAIT")], LOCKS)
    assert ids(activity.root_blockers(locks)) == []


def test_root_blocker_waiting_holder_is_not_root(spark):
    locks = spark.createDataFrame([(1, 10, "a", "GRANT"), (2, 10, "a", "WAIT"), (2, 11, "b", "GRANT"),
                                   (3, 11, "b", "WAIT"), (5, None, "c", "GRANT"), (6, None, "c", "WAIT")], LOCKS)
    assert ids(activity.root_blockers(locks)) == [1]


def root_blockers_brute(rows):
    """Holders and waiters among rows that clash with another, then NOT IN in three-valued logic."""
    clashing = [r for r in rows if r[1] is not None and r[3] is not None
                and any(o[1] == r[1] and o[2] == r[2] and o[3] not in (None, r[3]) for o in rows)]
    holders = {r[0] for r in clashing if r[3] == "GRANT"}
    waiters = {r[0] for r in clashing if r[3] == "WAIT"}
    if None in waiters:
        return []
    return sorted((h for h in holders if not waiters or (h is not None and h not in waiters)),
                  key=lambda v: (v is None, v))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 3)),
                          st.sampled_from([None, "a", "b"]), st.sampled_from([None, "GRANT", "WAIT", "CONVERT"])),
                min_size=0, max_size=14))
def test_root_blockers_equal_brute_force(spark, rows):
    locks = spark.createDataFrame(rows, LOCKS)
    assert ids(activity.root_blockers(locks)) == root_blockers_brute(rows)


def test_root_blockers_plan_has_no_nested_loop(spark):
    plan = activity.root_blockers(relation(spark, SF_SMALL, "locks"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortAggregate" not in plan


def test_reports_keep_their_order(spark):
    import __spark_entry__ as entry

    qs = entry.queries()
    cases = {"current_waits": ("session_id", "exec_context_id"), "active_sessions": ("session_id",), "root_blockers": ("request_session_id",),
             "file_locations": ("free_space_mb",), "job_report": ("next_run_date",), "tempdb_requests": ("-task_alloc",),
             "backup_history": ("-backup_start_date",), "weekly_backup_report": ("backup_start_date",),
             "tempdb_sessions": ("-internal_object_dealloc_mb",), "long_snapshot_transactions": ("-elapsed_time_seconds",)}
    for name, cols in cases.items():
        down = cols[0].startswith("-")
        names = [c.lstrip("-") for c in cols]
        got = [tuple(r[c] for c in names) for r in qs[name](spark, SF_SMALL).select(*names).collect()]
        assert got and got == sorted(got, key=lambda t: tuple((v is not None, v) for v in t), reverse=down), name


def test_kill_statement_keeps_long_ids(spark):
    procs = spark.createDataFrame([(123456, 1, "l", "h")], "spid long, dbid long, loginame string, hostname string")
    dbs = spark.createDataFrame([(1, "db")], "database_id long, name string")
    assert activity.kill_statements(procs, dbs).first().kill_statement == "kill 123456 -- l"


def test_blocked_pairs_keep_whole_texts(spark):
    procs = spark.createDataFrame([(1, 2, 90_000, 1, "c", "l"), (2, 0, 0, 1, "c", "l")],
                                  "spid long, blocked long, waittime long, dbid long, cmd string, loginame string")
    bufs = spark.createDataFrame([(1, "x" * 4000), (2, "y" * 300)], "spid long, event_info string")
    r = activity.blocked_pairs(procs, bufs, "2024-01-01 00:00:00").first()
    assert (len(r.query_blocked), len(r.query_blocked_by1), r.query_blocked_by2) == (4000, 300, None)


def test_scan_between_captures(spark, scratch):
    """As of a moment between captures: each server's latest capture before it."""
    rows = [("s1", "2024-01-01 10:00:00", 1), ("s1", "2024-01-02 10:00:00", 2), ("s1", "2024-01-02 12:00:00", 3),
            ("s2", "2024-01-01 09:00:00", 4), ("s2", "2024-01-03 09:00:00", 5)]
    df = spark.createDataFrame([(a, dt.datetime.fromisoformat(b), c) for a, b, c in rows],
                               "server_name string, captured_at timestamp_ntz, v int")
    df.withColumn("captured_date", F.to_date("captured_at")).write.partitionBy("captured_date").parquet(scratch + "/s")
    at = lambda t: sorted(r.v for r in readers.scan(spark, scratch + "/s", as_of=t).collect())
    assert at("2024-01-02 11:00:00") == [2, 4] and at("2024-01-02 12:00:00") == [3, 4]
    assert at("2024-01-01 09:30:00") == [4] and at("2023-12-31 00:00:00") == [] and at("2024-02-01 00:00:00") == [3, 5]


def test_current_waits_multiply_by_requests(spark):
    waits = spark.createDataFrame([(1, 0, 5, "LCK_M_X", None, None)],
                                  "session_id long, exec_context_id long, wait_duration_ms long, wait_type string, "
                                  "blocking_session_id long, resource_description string")
    sessions = spark.createDataFrame([(1, "app", 1, 2, 1)], "session_id long, program_name string, cpu_time long, "
                                                            "memory_usage long, is_user_process int")
    requests = spark.createDataFrame([(1, 7, 70), (1, 8, None)], "session_id long, sql_handle long, plan_handle long")
    text = spark.createDataFrame([(7, 3, "select 1")], "sql_handle long, dbid long, text string")
    plans = spark.createDataFrame([(70, "<p/>")], "plan_handle long, query_plan string")
    out = activity.current_waits(waits, sessions, requests, text, plans).collect()
    assert len(out) == 2
    assert sorted((r.text or "", r.query_plan or "") for r in out) == [("", ""), ("select 1", "<p/>")]


def test_top_queries_with_fleet_keys(spark):
    rows = [("s1", h, h, 0, -1, v) for h, v in enumerate([5, 9, 1, 7])] + \
           [("s2", h, h, 0, -1, v) for h, v in enumerate([3, 2, 8])]
    qs = spark.createDataFrame(rows, "server_name string, sql_handle long, plan_handle long, "
                                     "statement_start_offset long, statement_end_offset long, execution_count long")
    text = spark.createDataFrame([(s, h, 0, f"q{h}") for s in ("s1", "s2") for h in range(4)],
                                 "server_name string, sql_handle long, dbid long, text string")
    dbs = spark.createDataFrame([("s1", 0, "master"), ("s2", 0, "master")],
                                "server_name string, database_id long, name string")
    out = consumers.top_queries(qs, text, dbs, "execution_count", k=2, keys=("server_name",))
    got = sorted((r.server_name, r.execution_count) for r in out.collect())
    assert got == [("s1", 7), ("s1", 9), ("s2", 3), ("s2", 8)]


def test_table_row_counts_heap_or_clustered(spark):
    objects = spark.createDataFrame([(1, "t1", 0, "U"), (2, "v1", 0, "V")],
                                    "object_id long, name string, is_ms_shipped int, type string")
    indexes = spark.createDataFrame([(1, 1, "pk", "CLUSTERED", 100), (1, 2, "ix", "NONCLUSTERED", 100),
                                     (2, 1, "cv", "CLUSTERED", 5)],
                                    "object_id long, index_id long, name string, type_desc string, row_count long")
    out = schema_health.table_row_counts(objects, indexes).collect()
    assert [(r.id, r.table_name, r.rows) for r in out] == [(1, "dbo.t1", 100)]


def test_index_sets_join_and_difference(spark):
    schema = "table_name string, index_name string, key_columns string"
    a = spark.createDataFrame([("t", "ix1", "a, "), ("t", "ix2", "b, "), ("u", "ix3", None)], schema)
    b = spark.createDataFrame([("t", "ix1", "a, "), ("t", "ix2", "c, "), ("u", "ix3", None)], schema)
    diff = schema_health.index_difference(a, b).collect()
    assert [(r.table_name, r.index_name, r.key_columns) for r in diff] == [("t", "ix2", "b, ")]
    assert schema_health.index_difference(a, b, index_name="ix1").count() == 0
    joined = {(r.index_name, r.in_b) for r in schema_health.join_index_sets(a, b.filter("index_name <> 'ix3'"))
              .collect()}
    assert joined == {("ix1", True), ("ix2", True), ("ix3", False)}


def test_running_jobs(spark):
    j = spark.createDataFrame([(1, "a"), (2, "b")], "job_id long, name string")
    act = spark.createDataFrame([(1, 1), (2, 4)], "job_id long, execution_status int")
    assert [r.job_id for r in jobs.running_jobs(j, act).collect()] == [1]


def test_weekly_schedule_texts(spark):
    sched = spark.createDataFrame(
        [(1, "w1", 1, 8, 62, 1, 1, 1, 0, 0, 235959), (2, "w0", 1, 8, 62, 1, 0, 1, 0, 0, 235959),
         (3, "m", 1, 32, 9, 2, 2, 4, 15, 90000, 235959), (4, "off", 0, 1, 0, 1, 0, 1, 0, 0, 0)],
        "schedule_id long, name string, enabled int, freq_type int, freq_interval int, freq_relative_interval int, "
        "freq_recurrence_factor long, freq_subday_type int, freq_subday_interval int, active_start_time long, "
        "active_end_time int")
    js = spark.createDataFrame([(s, 10 + s, 20240105, 930) for s in (1, 2, 3, 4)],
                               "schedule_id long, job_id long, next_run_date long, next_run_time long")
    dec = {r.schedule_id: r for r in jobs.decode_schedules(sched, js).collect()}
    assert dec[1].frequency == "Monday, Tuesday, Wednesday, Thursday, Friday; weekly"
    assert dec[2].frequency is None
    assert dec[3].frequency == "Second Weekday; every 2 months"
    assert dec[3].sub_frequency == "Every 15 minutes"
    assert dec[1].sub_frequency == "Once"
    assert dec[1].start_time == "000000"
    assert 4 not in dec
    jobs_df = spark.createDataFrame([(12, "nightly", 1), (99, "idle job", 1), (98, "off", 0)],
                                    "job_id long, name string, enabled int")
    hist = spark.createDataFrame([], "job_id long, instance_id long, step_id int, run_status long, run_date int, "
                                     "run_time long, run_duration long")
    rep = {r.job_id: r for r in jobs.job_report(jobs_df, jobs.decode_schedules(sched, js),
                                                jobs.job_history_summary(hist)).collect()}
    assert rep[12].frequency == "" and rep[12].schedule_time == "00:00 - 23:59"
    assert rep[99].schedule_name == "(unscheduled)" and rep[99].last_duration == "00:00:01"
    assert 98 not in rep


def test_job_history_summary_counts(spark):
    hist = spark.createDataFrame(
        [(1, 10, 0, 1, 20240101, 10000, 130), (1, 11, 1, 2, 20240101, 10000, 5), (1, 12, 0, 0, 20240102, 20000, 45),
         (1, 12, 2, 2, 20240102, 20000, 10), (2, 20, 1, 1, 20240103, 0, 1)],
        "job_id long, instance_id long, step_id int, run_status long, run_date int, run_time long, "
        "run_duration long")
    got = {r.job_id: r for r in jobs.job_history_summary(hist).collect()}
    one = got[1]
    assert (one.success, one.cancel, one.fail, one.retry, one.last_execution_id) == (1, 0, 1, 2, 12)
    assert one.last_duration == "00:00:45"  # max over rows of the last instance (45 and 10)
    assert str(one.last_execution_start) == "2024-01-02 02:00:00"
    assert got[2].last_duration is None and str(got[2].last_execution_start) == "1900-01-01 00:00:00"


def test_backup_labels(spark):
    bs = spark.createDataFrame([(1, "s", "d", 110, "FULL", "D", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 5)],
                               "media_set_id long, server_name string, database_name string, "
                               "compatibility_level long, recovery_model string, type string, "
                               "backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz, backup_size long")
    m = spark.createDataFrame([(1, "/b", 105)], "media_set_id long, physical_device_name string, device_type int")
    ref = backups.backup_history(bs, m).first()
    fixed = backups.backup_history(bs, m, labels="corrected").first()
    assert (ref.compatibility_level, ref.device_type) == ("SQL Server 2011", "Tape - Temporary")
    assert (fixed.compatibility_level, fixed.device_type) == ("SQL Server 2012", "Tape - Permanent")


def test_html_document_escapes_and_skips_null(spark):
    rows = spark.createDataFrame([("a<b", None, 1), ("c&d", "x", 2)], "n string, m string, o long")
    frags = sinks.html_rows(rows, ["n", "m"], ["o"])
    doc = sinks.html_document(frags, ["N", "M"], ["o"]).first().html
    assert "<tr><td>a&lt;b</td></tr><tr><td>c&amp;d</td><td>x</td></tr></table>" in doc
    empty = sinks.html_document(frags.filter("o > 5"), ["N", "M"], ["o"]).first().html
    assert empty.endswith('<th ALIGN="left">M</th></table>')


def test_stale_files_and_listing(spark, scratch):
    import os
    import time
    p = os.path.join(scratch, "backup_job1.txt")
    with open(p, "w") as f:
        f.write("x")
    old = time.time() - 10 * 86400
    os.utime(p, (old, old))
    listing = storage.list_files(spark, scratch + "/*.txt")
    now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    got = storage.stale_output_files(listing, "file:" + scratch + "/backup_", ".txt", now).collect()
    assert len(got) == 1


def test_text_source_and_cpu_parse(spark, scratch):
    import os
    d = os.path.join(scratch, "srvA")
    os.makedirs(d)
    with open(os.path.join(d, "cpu.txt"), "w") as f:
        f.write("Manufacturer      : Generic\nLoadPercentage    : 42\n")
    lines = readers.text_source(spark, d + "/*.txt")
    out = storage.cpu_from_text(lines).collect()
    assert [(r.server_name, r.utilization) for r in out] == [("srvA", " 42 %")]


def test_scan_prunes_partition(spark, scratch):
    df = spark.createDataFrame([("s1", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0), 1),
                                ("s1", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0), 2)],
                               "server_name string, captured_date date, captured_at timestamp_ntz, v long")
    df.write.partitionBy("captured_date").parquet(scratch + "/snap")
    got = readers.scan(spark, scratch + "/snap", as_of="2024-01-02 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(captured_date" in plan
    assert [r.v for r in got.collect()] == [2]


def test_across_databases(spark):
    df = spark.createDataFrame([("master",), ("sales",), (None,), ("salt",)], "database_name string")
    assert [r.database_name for r in readers.across_databases(df, exclude=("master",)).collect()] == ["sales", "salt"]
    assert [r.database_name for r in readers.across_databases(df, like="SAL_").collect()] == ["salt"]


def test_kill_statement_null_login(spark):
    p = spark.createDataFrame([(5, 1, None, "h"), (6, 1, "bob", "")], "spid long, dbid int, loginame string, "
                                                                      "hostname string")
    d = spark.createDataFrame([(1, "db1")], "database_id int, name string")
    got = {r.spid: r.kill_statement for r in activity.kill_statements(p, d, "db1").collect()}
    assert got == {5: None, 6: "kill 6 -- bob"}
    assert [r.spid for r in activity.kill_statements(p, d, require_host=True).collect()] == [5]


def test_across_tables(spark):
    df = spark.createDataFrame([("t1", 2), ("t1", 3), ("t2", 1)], "table_name string, rows long")
    assert sorted(tuple(r) for r in readers.across_tables(df, measures=["rows"]).collect()) == [("t1", 5), ("t2", 1)]


def test_job_report_last_day_filter(spark):
    jobs_df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "job_id long, name string, enabled int")
    sched = spark.createDataFrame([], "schedule_id long, name string, enabled int, freq_type int, freq_interval int, "
                                      "freq_relative_interval int, freq_recurrence_factor long, freq_subday_type int, "
                                      "freq_subday_interval int, active_start_time long, active_end_time int")
    js = spark.createDataFrame([], "schedule_id long, job_id long, next_run_date long, next_run_time long")
    hist = spark.createDataFrame([(1, 10, 0, 1, 20240130, 120000, 5), (2, 20, 0, 1, 20240101, 0, 5)],
                                 "job_id long, instance_id long, step_id int, run_status long, run_date int, "
                                 "run_time long, run_duration long")
    rep = jobs.job_report(jobs_df, jobs.decode_schedules(sched, js), jobs.job_history_summary(hist),
                          since_hours=24, as_of="2024-01-31 00:00:00")
    assert [r.job_id for r in rep.collect()] == [1]


def test_trace_source_feeds_default_trace(spark, scratch):
    from dbtelemetry.operators import inventory
    rows = [("DB1", 60, "2024-01-30 10:00:00", 8000, 20, "login failed"),
            ("tempdb", 61, "2024-01-30 10:00:00", 8000, 20, "skip: tempdb"),
            ("DB1", 12, "2024-01-30 10:00:00", 8000, 20, "skip: system spid"),
            ("DB1", 62, "2024-01-29 23:59:59", 8000, 20, "skip: yesterday")]
    df = spark.createDataFrame(rows, "database_name string, spid long, start_time string, object_type long, "
                                     "event_class long, text_data string")
    df.write.json(scratch + "/trace/log_1.trc.json")
    df.limit(1).write.json(scratch + "/trace/log_2.trc.json")  # a rollover file
    schema = ("database_name string, spid long, start_time timestamp_ntz, object_type long, event_class long, "
              "text_data string")
    trace = readers.trace_source(spark, scratch + "/trace/*", fmt="json", schema=schema)
    ev = spark.createDataFrame([(20, "Audit Login Failed", 8)], "trace_event_id int, name string, category_id int")
    cat = spark.createDataFrame([(8, "Security Audit")], "category_id int, name string")
    sub = spark.createDataFrame([(20, 8000, "Database")], "trace_event_id int, subclass_value int, subclass_name string")
    out = inventory.default_trace_today(trace, sub, ev, cat, "2024-01-30 12:00:00").collect()
    assert len(out) == 2 and {r.text_data for r in out} == {"login failed"}
    assert out[0].event_name == "Audit Login Failed" and out[0].object_type == "Database"


def test_write_html_keeps_report_order(spark, scratch):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(200)], "o long, n string")
    frags = sinks.html_rows(rows, ["n"], ["o"])
    sinks.write_html(frags, scratch + "/report", ["o"], num_files=4)
    import glob
    text = "".join(open(f).read() for f in sorted(glob.glob(scratch + "/report/part-*")))
    cells = [line for line in text.splitlines() if line]
    assert cells == [f"<tr><td>n{i}</td></tr>" for i in range(200)]


def test_trace_rollover_glob():
    assert readers.trace_rollover_glob(r"D:\traces\log_1234.trc", ".parquet") == "D:/traces/log*.trc.parquet"
    assert readers.trace_rollover_glob("/data/traces/log_7.trc") == "/data/traces/log*.trc"


def test_running_requests_utf16_cut(spark):
    text = "\U0001F600abc def"
    req = spark.createDataFrame([(1, 7, 4, 10, 0, 5, 0, 0, 1, 1, 1)],
                                "session_id long, sql_handle long, statement_start_offset long, "
                                "statement_end_offset long, database_id long, cpu_time long, percent_complete long, "
                                "blocking_session_id long, reads long, writes long, logical_reads long")
    ses = spark.createDataFrame([(1, "h", "c", "p", "l", "running", dt.datetime(2024, 1, 1), 1)],
                                "session_id long, host_name string, client_interface_name string, "
                                "program_name string, login_name string, status string, "
                                "last_request_start_time timestamp_ntz, is_user_process int")
    txt = spark.createDataFrame([(7, text)], "sql_handle long, text string")
    dbs = spark.createDataFrame([(0, "db")], "database_id long, name string")
    cut = activity.running_requests(req, ses, txt, dbs, "2024-01-01 00:10:00").first()
    assert cut.statement_text == "abc " and cut.running_minutes == 10


def test_low_disk_space_alert(spark):
    files = spark.createDataFrame([(1, 1), (1, 2)], "database_id long, file_id long")
    vols = spark.createDataFrame([(1, 1, "V1", "/a", 2000 * 1048576), (1, 2, "V2", "/b", 10 * 1048576)],
                                 "database_id long, file_id long, logical_volume_name string, "
                                 "volume_mount_point string, available_bytes long")
    row = storage.low_disk_space_alert(files, vols).first()
    assert (row.low_volumes, row.send_alert) == (1, True)
    none = storage.low_disk_space_alert(files, vols, threshold_mb=5).first()
    assert (none.low_volumes, none.send_alert) == (0, False)


def test_blocked_pairs_keeps_duplicate_rows_and_roles(spark):
    procs = spark.createDataFrame(
        [(1, 2, 90000, 5, "SELECT", "a"), (1, 2, 90000, 5, "SELECT", "a"),  # session 1 listed twice
         (2, 3, 10, 5, "UPDATE", "b"), (3, 0, 0, 5, "SELECT", "c"), (4, 5, 70000, 5, "SELECT", "d"),
         (5, 0, 0, 5, "SELECT", "e")],
        "spid long, blocked long, waittime long, dbid int, cmd string, loginame string")
    bufs = spark.createDataFrame([(1, "q1"), (2, "q2"), (3, "q3" * 200), (4, "q4")], "spid long, event_info string")
    out = sorted((r.spid, r.blocked1, r.blocked2, r.query_blocked, r.query_blocked_by1, r.query_blocked_by2)
                 for r in activity.blocked_pairs(procs, bufs, "2024-01-31 00:00:00").collect())
    assert out == [(1, 2, 3, "q1", "q2", "q3" * 200), (1, 2, 3, "q1", "q2", "q3" * 200),
                   (4, 5, 0, "q4", None, None)]


def test_index_definitions_through_column_catalog(spark):
    idx = spark.createDataFrame([(1, 1, "ix", "NONCLUSTERED", 0, 0)],
                                "object_id long, index_id long, name string, type_desc string, is_unique long, "
                                "is_primary_key int")
    objs = spark.createDataFrame([(1, "t", 0)], "object_id long, name string, is_ms_shipped int")
    ic = spark.createDataFrame([(1, 1, 2, 20, 0), (1, 1, 1, 10, 0), (1, 1, 3, 30, 1)],
                               "object_id long, index_id long, index_column_id int, column_id int, "
                               "is_included_column int")
    cols = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 30, "c")], "object_id long, column_id int, name string")
    r = schema_health.index_definitions(idx, objs, ic, columns=cols).first()
    assert (r.key_columns, r.included_columns) == ("a, b, ", "c, ")
    r2 = schema_health.index_definitions(idx, objs, ic, columns=cols, trailing_separator=False).first()
    assert (r2.key_columns, r2.included_columns) == ("a, b", "c")


def test_unused_indexes_usage_per_database(spark):
    idx = spark.createDataFrame([(1, 1, 7, "ix1", "NONCLUSTERED", 0), (1, 2, 7, "ix2", "NONCLUSTERED", 0)],
                                "object_id long, index_id long, database_id long, name string, type_desc string, "
                                "is_primary_key int")
    objs = spark.createDataFrame([(1, "t", "U ")], "object_id long, name string, type string")
    usage = spark.createDataFrame([(1, 1, 7, 5, None, None), (1, 2, 8, 5, None, None)],
                                  "object_id long, index_id long, database_id long, user_seeks long, user_scans long, "
                                  "user_lookups long")
    names = [r.index_name for r in schema_health.unused_indexes(idx, usage, objs).collect()]
    assert names == ["ix2"]  # ix2's usage row is for another database; 'U ' is a char(2) type


def test_append_sink_partitions(spark, scratch):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "captured_date date, v long")
    sinks.append(df, scratch + "/log", partition_by=["captured_date"])
    sinks.append(df.limit(1), scratch + "/log", partition_by=["captured_date"])
    back = spark.read.parquet(scratch + "/log")
    assert back.count() == 3 and back.filter("captured_date = DATE '2024-01-01'").count() == 2


def test_pages_to_mb_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(16,), (-16,), (1000,), (0,)], "p long")
    got = [str(r.mb) for r in df.select(storage.pages_to_mb("p").alias("mb")).collect()]
    assert got == ["0.13", "-0.13", "7.81", "0.00"]  # 0.125 -> 0.13, 7.8125 -> 7.81


def test_pool_name_without_slash(spark):
    from dbtelemetry.operators import inventory
    df = spark.createDataFrame([("s1", "https://host/pools/appA"), ("s2", "appB"), ("s3", "https://host/")],
                               "server string, url string")
    assert [r.pool_name for r in inventory.pool_names(df).collect()] == ["appA", "appB", ""]


def test_scan_server_filter_and_columns(spark, scratch):
    df = spark.createDataFrame([("s1", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 1),
                                ("s2", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 2)],
                               "server_name string, captured_date date, captured_at timestamp_ntz, v long")
    df.write.partitionBy("captured_date").parquet(scratch + "/snap")
    got = readers.scan(spark, scratch + "/snap", as_of="2024-01-01 00:00:00", columns=["server_name", "v"],
                       servers=["s2"])
    assert [tuple(r) for r in got.collect()] == [("s2", 2)]


def test_log_consumers_state_filter(spark):
    dt_rows = [(1, 5, dt.datetime(2024, 1, 1), 10, 100, 4), (2, 5, dt.datetime(2024, 1, 1), 10, 900, 3)]
    dtx = spark.createDataFrame(dt_rows, "transaction_id long, database_id long, begin_time timestamp_ntz, "
                                         "log_bytes_reserved long, log_record_count long, state int")
    stx = spark.createDataFrame([(1, 7), (2, 7)], "transaction_id long, session_id long")
    req = spark.createDataFrame([(7, 70, 1)], "session_id long, request_id long, sql_handle long")
    txt = spark.createDataFrame([(1, "update t")], "sql_handle long, text string")
    dbs = spark.createDataFrame([(5, "db5")], "database_id long, name string")
    everything = consumers.log_consumers(dtx, stx, req, txt, dbs).collect()
    only_logging = consumers.log_consumers(dtx, stx, req, txt, dbs, state=4).collect()
    assert sorted(r.log_record_count for r in everything) == [100, 900]
    assert [(r.log_record_count, r.db_name, r.text) for r in only_logging] == [(100, "db5", "update t")]


def test_parameter_filters(spark):
    from dbtelemetry.operators import inventory
    r = lambda n: relation(spark, SF_SMALL, n)
    sid = activity.current_waits(r("waiting_tasks"), r("sessions"), r("requests"), r("sql_text"), r("query_plan"),
                                 session_id=2)
    assert {x.session_id for x in sid.collect()} <= {2}
    assert {x.spid for x in activity.statement_of(r("processes"), r("sql_text"), spid=3).collect()} <= {3}
    restored = backups.last_restore(r("restore_history"), database="DB3").collect()
    assert [x.destination_database_name for x in restored] == ["DB3"]
    users = r("database_principals")
    some = users.limit(2).collect()
    kept = inventory.drop_user_statements(users, keep=[u.name for u in some])
    assert kept.count() == users.count() - 2
    cats = spark.createDataFrame([(c,) for c in range(0, 25, 2)], "category_id int")  # even categories only
    with_cat = jobs.failed_jobs(r("jobs"), r("job_servers"), r("job_schedules"), r("schedules"), r("job_history"),
                                categories=cats).count()
    without = jobs.failed_jobs(r("jobs"), r("job_servers"), r("job_schedules"), r("schedules"),
                               r("job_history")).count()
    assert with_cat <= without
    assert storage.event_log_search(r("event_log"), "%ERROR%", case_sensitive=True).count() == 0


def test_no_column_of_these_reports_is_null_throughout(spark):
    import __spark_entry__ as entry

    qs = entry.queries()
    for name in ("running_requests", "unused_indexes", "failed_jobs", "job_report", "blocked_process_events", "table_row_counts",
                 "last_restore", "low_disk_space_html"):
        df = qs[name](spark, SF_SMALL)
        row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
        assert all(row[c] for c in ("__rows", *df.columns)), (name, row)


def test_left_lookups_spread_the_rows_without_a_key(spark):
    """rows whose lookup column is NULL are many tasks' rows, not one's."""
    from dbtelemetry.operators.common import lookup_text, spread_left_join

    n = 4000
    left = spark.range(n).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 50).alias("sql_handle"))
    right = spark.range(1, 60).select(F.col("id").alias("sql_handle"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (spread_left_join(left, right, ["sql_handle"], "sql_handle"), lookup_text(left, right)):
            got = out.withColumn("at", F.spark_partition_id()).collect()
            assert len(got) == n
            assert all(r.text == (f"t{r.sql_handle}" if r.sql_handle else None) for r in got)
            loads = {}
            for r in got:
                if r.sql_handle is None:
                    loads[r["at"]] = loads.get(r["at"], 0) + 1
            assert max(loads.values()) < n / 2, loads
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_captured_output_of_many_servers_is_few_files(spark):
    """files follow the table's partitions, not its servers; lines and names come back as they were."""
    import glob

    from dbtelemetry.sources import sinks

    odd = [("a b/c=%41", "Load : 1"), ("tab\tname", "x\nLoad : 2\r\nLoad : 3"), ("nul", None), ("ü+1", "\tLoad : 4"), ("", "Load : 5"), (None, "Load : 6")]
    rows = spark.createDataFrame(odd + [(f"s{i}", f"Load : {i}") for i in range(500)], "server_name string, output string").coalesce(2)
    folder = sinks.new_folder(spark)
    sinks.write_output(rows, folder)
    assert 1 <= len(glob.glob(folder.removeprefix("file:") + "/**/part-*", recursive=True)) <= 2
    lines = readers.text_source(spark, folder, server_from_path=False, server_in_line=True)
    want = {("a b/c=%41", "Load : 1"), ("tab\tname", "x"), ("tab\tname", "Load : 2"), ("tab\tname", "Load : 3"), ("nul", ""), ("ü+1", "\tLoad : 4"),
            ("__HIVE_DEFAULT_PARTITION__", "Load : 5"), ("__HIVE_DEFAULT_PARTITION__", "Load : 6")}
    got = [(r.server_name, r.output) for r in lines.collect()]
    assert len(got) == 508 and set(got) == want | {(f"s{i}", f"Load : {i}") for i in range(500)}
    parsed = storage.cpu_from_text(lines).collect()
    assert len(parsed) == 505 and ("tab\tname", " 3 %") in {(r.server_name, r.utilization) for r in parsed}
