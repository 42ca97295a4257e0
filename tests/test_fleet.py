"""Fleet keys: one run over two servers equals one run per server."""

import pytest
from pyspark.sql import functions as F

from dbtelemetry.operators import activity, backups, consumers, inventory, jobs, schema_health, storage, tempdb
from dbtelemetry.sources.fixtures import relation

SERVERS = {"a": "/root/testdata/sf0.001", "b": "/root/testdata/sf0.01"}
KEYS = ("srv",)


class Fleet:
    """Relations of each server tagged with ``srv``, and their union."""

    def __init__(self, spark):
        self.spark = spark

    def one(self, srv, name):
        return relation(self.spark, SERVERS[srv], name).withColumn("srv", F.lit(srv))

    def all(self, name):
        return self.one("a", name).unionByName(self.one("b", name))


CASES = {
    "current_waits": (lambda r: activity.current_waits(r("waiting_tasks"), r("sessions"), r("requests"),
                                                       r("sql_text"), r("query_plan"), keys=KEYS)),
    "active_sessions": (lambda r: activity.active_sessions(r("sessions"), r("requests"), r("sql_text"),
                                                           r("query_plan"), r("databases"), keys=KEYS)),
    "root_blockers": (lambda r: activity.root_blockers(r("locks"), keys=KEYS)),
    "blocked_pairs": (lambda r: activity.blocked_pairs(r("processes"), activity.input_buffers(
        r("processes"), r("sql_text"), keys=KEYS), "2024-01-31 00:00:00", keys=KEYS)),
    "top_queries": (lambda r: consumers.top_queries(r("query_stats"), r("sql_text"), r("databases"),
                                                    "total_worker_time", keys=KEYS)),
    "log_consumers": (lambda r: consumers.log_consumers(r("database_transactions"), r("session_transactions"),
                                                        r("requests"), r("sql_text"), r("databases"), keys=KEYS)),
    "unused_indexes": (lambda r: schema_health.unused_indexes(r("indexes"), r("index_usage_stats"), r("objects"),
                                                              keys=KEYS)),
    "index_definitions": (lambda r: schema_health.index_definitions(r("indexes"), r("objects"), r("index_columns"),
                                                                    keys=KEYS)),
    "file_free_space": (lambda r: storage.file_free_space(r("database_files"), r("filegroups"), keys=KEYS)),
    "job_report": (lambda r: jobs.job_report(r("jobs"), jobs.decode_schedules(r("schedules"), r("job_schedules"),
                                                                              keys=KEYS),
                                             jobs.job_history_summary(r("job_history"), keys=KEYS), keys=KEYS)),
    "failed_jobs": (lambda r: jobs.failed_jobs(r("jobs"), r("job_servers"), r("job_schedules"), r("schedules"),
                                               r("job_history"), keys=KEYS)),
    "tempdb_sessions": (lambda r: tempdb.tempdb_sessions(r("task_space_usage"), r("requests"), r("sql_text"),
                                                         r("query_plan"), keys=KEYS)),
    "running_requests": (lambda r: activity.running_requests(r("requests"), r("sessions"), r("sql_text"),
                                                             r("databases"), "2024-01-31 00:00:00", keys=KEYS)),
    "session_status": (lambda r: activity.session_status(r("processes"), r("sql_text"), r("databases"), keys=KEYS)),
    "kill_statements": (lambda r: activity.kill_statements(r("processes"), r("databases"), keys=KEYS)),
    "requests_by_command": (lambda r: activity.requests_by_command(r("requests"), r("databases"), keys=KEYS)),
    "tables_without_primary_key": (lambda r: schema_health.tables_without_primary_key(r("objects"), r("indexes"),
                                                                                      keys=KEYS)),
    "table_space": (lambda r: schema_health.table_space(r("objects"), r("objects_space"), keys=KEYS)),
    "drop_statistics": (lambda r: schema_health.drop_statistics_statements(r("objects"), r("indexes"), keys=KEYS)),
    "missing_index_requests": (lambda r: schema_health.requests_with_missing_indexes(
        r("requests"), r("sql_text"), r("query_plan"), r("databases"), "2024-01-31 00:00:00", keys=KEYS)),
    "backup_history": (lambda r: backups.backup_history(r("backupset"), r("backupmediafamily"), keys=KEYS)),
    "last_restore": (lambda r: backups.last_restore(r("restore_history"), keys=KEYS)),
    "file_sizes": (lambda r: storage.file_sizes(r("database_files"), r("databases"), keys=KEYS)),
    "file_locations": (lambda r: storage.file_locations(r("database_files"), r("volume_stats"), r("databases"),
                                                        keys=KEYS)),
    "low_disk_space": (lambda r: storage.low_disk_space(r("database_files"), r("volume_stats"), keys=KEYS)),
    "jobs_missing_step": (lambda r: jobs.jobs_missing_step(r("jobs"), r("job_steps"), keys=KEYS)),
    "contention_counts": (lambda r: tempdb.contention_counts(r("waiting_tasks"), r("sessions"), keys=KEYS)),
    "tempdb_requests": (lambda r: tempdb.tempdb_requests(r("task_space_usage"), r("requests"), keys=KEYS)),
    "tempdb_space": (lambda r: tempdb.tempdb_space(r("file_space_usage"), keys=KEYS)),
    "session_query": (lambda r: tempdb.session_query(r("sessions"), r("requests"), r("sql_text"), r("query_plan"),
                                                     keys=KEYS)),
    "orphaned_users": (lambda r: inventory.orphaned_users(r("database_principals"), r("server_principals"),
                                                          keys=KEYS)),
    "database_overview": (lambda r: inventory.database_overview(r("databases"), r("helpdb_output"), keys=KEYS)),
    "unused_procedures": (lambda r: schema_health.unused_procedures(r("objects").filter("type = 'P'"),
                                                                    r("procedure_stats"), keys=KEYS)),
    "index_difference": (lambda r: schema_health.index_difference(
        schema_health.index_definitions(r("indexes"), r("objects"), r("index_columns"), keys=KEYS),
        schema_health.index_definitions(r("indexes"), r("objects"), r("index_columns_b"), keys=KEYS), keys=KEYS)),
    "mail_profiles": (lambda r: inventory.mail_profiles(r("mail_profile"), r("mail_profileaccount"),
                                                        r("mail_account"), keys=KEYS)),
}


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(CASES))
def test_fleet_run_equals_per_server_runs(spark, name):
    fleet = Fleet(spark)
    together = CASES[name](fleet.all)
    assert "srv" in together.columns
    separate = None
    for srv in SERVERS:
        part = CASES[name](lambda n, s=srv: fleet.one(s, n))
        separate = part if separate is None else separate.unionByName(part)
    assert rows(together.select(*sorted(together.columns))) == rows(separate.select(*sorted(together.columns)))


def test_reports_on_partitioned_snapshots(spark, scratch):
    """The README's usage: snapshots partitioned by capture date, read as of one capture."""
    from dbtelemetry.sources import readers, sinks

    snaps = ["2024-01-30 10:00:00", "2024-01-31 10:00:00"]
    for name in ["waiting_tasks", "sessions", "requests", "sql_text", "query_plan"]:
        base = relation(spark, SERVERS["a"], name)
        for snap in snaps:
            (base.withColumn("server_name", F.lit("srv1")).withColumn("captured_at", F.expr(f"TIMESTAMP_NTZ '{snap}'"))
             .withColumn("captured_date", F.to_date("captured_at"))
             .write.mode("append").partitionBy("captured_date").parquet(f"{scratch}/{name}"))
    keys = ("server_name", "captured_at")

    def rd(n):
        return readers.scan(spark, f"{scratch}/{n}", as_of=snaps[1])

    got = activity.current_waits(rd("waiting_tasks"), rd("sessions"), rd("requests"), rd("sql_text"),
                                 rd("query_plan"), keys=keys)
    sinks.append(got, f"{scratch}/report", partition_by=["server_name"])
    plain = activity.current_waits(*(relation(spark, SERVERS["a"], n) for n in
                                     ["waiting_tasks", "sessions", "requests", "sql_text", "query_plan"]))
    assert spark.read.parquet(f"{scratch}/report").count() == plain.count() > 0
