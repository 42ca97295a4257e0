"""The streaming job against the batch form: sparse, late, duplicate and two-server input, restarts and replays."""

import datetime as dt
import os

from pyspark.sql import functions as F

from dbtelemetry.sources.queue import read_queue
from dbtelemetry.streaming import blocked_process as bp

from test_blocked_process import _msg

MESSAGE = "server_name string, message_type_name string, event_ts timestamp_ntz, message_body string"
NOON = dt.datetime(2024, 1, 1, 12)
TABLES = ("changes", "late", "alerts", "events")


class Queue:
    """A folder to which files are published one after another."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files, self.messages = spark, folder, 0, 0

    def publish(self, rows):
        """Rows: (server, report minute, wait in ms or a whole body); they arrive in this order."""
        out = []
        for server, minute, body in rows:
            if isinstance(body, int):
                body = _msg(1, body, (NOON + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S"))
            self.messages += 1
            out.append((server, "EventNotification", NOON + dt.timedelta(seconds=self.messages), body))
        staged = f"{self.folder}-staged/{self.files}"
        self.spark.createDataFrame(out, MESSAGE).coalesce(1).write.parquet(staged)
        name = next(n for n in os.listdir(staged) if n.startswith("part-"))
        os.makedirs(self.folder, exist_ok=True)
        with open(f"{staged}/{name}", "rb") as f:
            data = f.read()
        path = f"{self.folder}/file-{self.files:04d}.parquet"
        with open(path, "wb") as f:
            f.write(data)
        os.utime(path, (1_700_000_000 + 60 * self.files, 1_700_000_000 + 60 * self.files))
        self.files += 1


def run(spark, scratch, **args):
    """Take what the queue holds, in one run of the job on the same checkpoint."""
    for q in bp.start_blocking_job(spark, scratch + "/queue", scratch + "/out", scratch + "/ckpt", trigger={"availableNow": True}, **args):
        q.awaitTermination()


def table(spark, scratch, name):
    return spark.read.parquet(f"{scratch}/out/{name}")


def batch_incidents(spark, scratch):
    inc = bp.merge_reports(bp.reports(bp.parse_messages(read_queue(spark, scratch + "/queue"))))
    return {r.incident_id: (r.server_name, r.wait_time, str(r.event_date)) for r in inc.collect()}


def stream_incidents(spark, scratch):
    return {r.incident_id: (r.server_name, r.wait_time, str(r.event_date))
            for r in bp.current_incidents(table(spark, scratch, "changes")).collect()}


def test_sparse_reports_are_one_incident(spark, scratch):
    """Reported every 30 minutes, with other traffic and quiet batches between: one incident, as in batch."""
    queue = Queue(spark, scratch + "/queue")
    for k in range(4):
        queue.publish([("a", 30 * k, 30 * k * 60_000 + 1000)])
        run(spark, scratch, interval_seconds=1800)
        queue.publish([("b", 30 * k + 15, 100)])
        run(spark, scratch, interval_seconds=1800)
    want = batch_incidents(spark, scratch)
    assert stream_incidents(spark, scratch) == want
    assert [v[1] for v in want.values() if v[0] == "a"] == [90 * 60_000 + 1000]


def test_closed_incident_opens_again(spark, scratch):
    """The timer closes an incident; a report whose wait reaches back before the close continues it."""
    queue = Queue(spark, scratch + "/queue")
    queue.publish([("a", 0, 1000)])
    run(spark, scratch)
    for minute in (60, 120):
        queue.publish([("b", minute, 100)])
        run(spark, scratch)
    closed = table(spark, scratch, "changes").filter("change = 'close' and server_name = 'a'").collect()
    assert [r.wait_time for r in closed] == [1000]
    queue.publish([("a", 121, 121 * 60_000 + 1000)])
    run(spark, scratch)
    now = bp.current_incidents(table(spark, scratch, "changes")).filter("server_name = 'a'").collect()
    assert [(r.wait_time, r.closed) for r in now] == [(121 * 60_000 + 1000, False)]
    assert stream_incidents(spark, scratch) == batch_incidents(spark, scratch)


def test_late_reports_go_to_the_side_output(spark, scratch):
    """Every message is merged, captured as an event, an error or late; none is lost."""
    queue = Queue(spark, scratch + "/queue")
    queue.publish([("a", 0, 1000), ("a", 60, 1000)])
    run(spark, scratch)
    queue.publish([("a", 61, 61_000), ("a", 5, 1000), ("a", 55, 1000), ("a", 62, "<EVENT_INSTANCE><"),
                   ("a", 62, "<EVENT_INSTANCE><EventType>DEADLOCK_GRAPH</EventType></EVENT_INSTANCE>")])
    run(spark, scratch)
    late = table(spark, scratch, "late").collect()
    # 12:05 is older than 13:00 less ten minutes, 12:55 is not.
    assert [(str(r.event_date), r.delay_ms) for r in late] == [("2024-01-01 12:05:00", 55 * 60_000)]
    capture = table(spark, scratch, "capture")
    kinds = {r.kind: r["count"] for r in capture.groupBy("kind").count().collect()}
    assert kinds == {"report": 5, "event": 1, "error": 1}
    assert capture.count() == read_queue(spark, scratch + "/queue").count() == 7
    on_time = read_queue(spark, scratch + "/queue").filter(~F.col("message_id").isin([r.report_id for r in late]))
    want = {r.incident_id: r.wait_time for r in bp.merge_reports(bp.reports(bp.parse_messages(on_time))).collect()}
    assert {k: v[1] for k, v in stream_incidents(spark, scratch).items()} == want
    events = bp.captured_events(capture).collect()
    assert len(events) == 6 and all(e.blocking_event_data and e.audit_date for e in events)


def test_equal_messages_without_a_key_are_two_incidents(spark, scratch):
    body = _msg(1, 5000, "2024-01-01T12:00:00", handle="")
    queue = Queue(spark, scratch + "/queue")
    queue.publish([("a", 0, body), ("a", 0, body)])
    run(spark, scratch)
    assert stream_incidents(spark, scratch) == batch_incidents(spark, scratch)
    assert len(stream_incidents(spark, scratch)) == 2
    run(spark, scratch)  # nothing new: nothing repeated
    assert table(spark, scratch, "capture").count() == 2


def lookups(spark):
    end = dt.datetime(2024, 2, 1)
    return {
        "sql_text": spark.createDataFrame([("a", "0x01", "text of a")], "server_name string, sql_handle string, text string"),
        "requests": spark.createDataFrame([], "server_name string, session_id long, sql_handle string, statement_start_offset long, "
                                              "statement_end_offset long, plan_handle long"),
        "query_stats": spark.createDataFrame(
            [("a", "0x01", 0, -1, NOON - dt.timedelta(days=1), NOON + dt.timedelta(minutes=30), 7),
             ("a", "0x01", 0, -1, NOON + dt.timedelta(minutes=40), end, 8)],
            "server_name string, sql_handle string, statement_start_offset long, statement_end_offset long, "
            "creation_time timestamp_ntz, last_execution_time timestamp_ntz, plan_handle long"),
        "plans": spark.createDataFrame([("a", 7, "<p7/>"), ("a", 8, "<p8/>")], "server_name string, plan_handle long, query_plan string")}


def test_event_table_equals_batch(spark, scratch):
    """All columns of the event table, text and plans included; alerts hold resource, blocker and report."""
    queue = Queue(spark, scratch + "/queue")
    queue.publish([("a", 0, 1000), ("b", 0, 1000)])
    run(spark, scratch, lookups=lookups(spark))
    queue.publish([("a", 1, 61_000), ("a", 50, 1000)])
    run(spark, scratch, lookups=lookups(spark))
    got = bp.current_event_log(table(spark, scratch, "events"), table(spark, scratch, "changes"))
    want = bp.event_log(read_queue(spark, scratch + "/queue"), **lookups(spark)).select("server_name", *bp.EVENT_LOG_COLUMNS)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(r.blocked_query_plan or "" for r in got.collect()) == ["", "<p7/>", "<p8/>"]
    alert = table(spark, scratch, "alerts").collect()
    assert len(alert) == 3 and all("<td>KEY: 1</td><td>2</td><td>&lt;blocked-process-report&gt;" in r.html for r in alert)


def test_replayed_batch_changes_nothing(spark, scratch):
    """The last batch's commit is lost: it runs again after the restart and replaces its own rows."""
    queue = Queue(spark, scratch + "/queue")
    queue.publish([("a", 0, 1000), ("b", 0, 1000)])
    run(spark, scratch)
    queue.publish([("a", 30, 1000), ("a", 31, 61_000)])
    run(spark, scratch)
    queue.publish([("a", 60, 1000), ("b", 0, 1000), ("b", 58, 58 * 60_000)])
    run(spark, scratch)
    before = {n: sorted(map(str, table(spark, scratch, n).collect())) for n in TABLES}
    commits = f"{scratch}/ckpt/changes/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for n in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{n}"):
            os.remove(f"{commits}/{n}")
    run(spark, scratch)
    after = {n: sorted(map(str, table(spark, scratch, n).collect())) for n in TABLES}
    assert after == before


def test_reporting_interval(spark):
    conf = spark.createDataFrame([("a", "blocked process threshold (s)", 20), ("b", "blocked process threshold (s)", 60),
                                  ("b", "max degree of parallelism", 900)], "server_name string, name string, value_in_use int")
    assert bp.report_interval(conf) == 60 and bp.report_interval(conf.limit(0)) == 0
