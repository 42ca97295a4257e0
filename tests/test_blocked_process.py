"""Blocked-process job: fold exactness, merge traps, streaming equals batch."""

import datetime as dt
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dbtelemetry.sources.fixtures import relation
from dbtelemetry.sources.queue import read_queue
from dbtelemetry.streaming import blocked_process as bp
from dbtelemetry.streaming.merge_fold import KeyFold

from conftest import SF_SMALL

SLACK = 100_000  # 100 ms in microseconds


def brute_force(reports):
    """The reference's MERGE, one message at a time, on a plain list."""
    table = []
    for t, w, rid in reports:
        thr = t - (w * 1000 + SLACK)
        hits = [row for row in table if row[0] >= thr]
        if hits:
            for row in hits:
                row[1] = w
        else:
            table.append([t, w, rid])
    return sorted((rid, t0, w) for t0, w, rid in table)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5_000_000), st.integers(0, 4000)), max_size=40))
def test_fold_equals_brute_force(raw):
    reports = [(t, w, i) for i, (t, w) in enumerate(raw)]  # arbitrary (even out of order) times
    fold = KeyFold()
    for t, w, rid in reports:
        fold.step(t, w, rid, SLACK)
    assert sorted(fold.final_waits()) == brute_force(reports)


def test_fold_state_roundtrip():
    f = KeyFold()
    rng = random.Random(7)
    for i in range(200):
        f.step(i * 1_000_000 + rng.randint(0, 10), rng.randint(0, 5000), i, SLACK)
    g = KeyFold.loads(f.dumps())
    assert list(g.final_waits()) == list(f.final_waits())


def _msg(spid, wait_ms, start, handle='sqlhandle="0x01" ', blocker=2):
    return ("<EVENT_INSTANCE><EventType>BLOCKED_PROCESS_REPORT</EventType><DatabaseID>5</DatabaseID>"
            f"<StartTime>{start}</StartTime><TextData><blocked-process-report><blocked-process>"
            f'<process spid="{spid}" waittime="{wait_ms}" waitresource="KEY: 1" xactid="9" lockMode="S">'
            f"<executionStack><frame {handle}/></executionStack><inputbuf>select 1</inputbuf></process>"
            f'</blocked-process><blocking-process><process spid="{blocker}" status="sleeping" trancount="1"/>'
            "</blocking-process></blocked-process-report></TextData></EVENT_INSTANCE>")


def _messages(spark, bodies):
    rows = [("EventNotification", dt.datetime(2024, 1, 1, 0, 0, i), b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "message_type_name string, event_ts timestamp_ntz, message_body string")


def test_repeat_within_wait_merges(spark):
    msgs = _messages(spark, [_msg(1, 5000, "2024-01-01T10:00:00"), _msg(1, 9000, "2024-01-01T10:00:04")])
    out = bp.merge_reports(bp.reports(bp.parse_messages(msgs))).collect()
    assert len(out) == 1
    assert out[0].wait_time == 9000 and str(out[0].event_date) == "2024-01-01 10:00:00"


def test_repeat_outside_window_is_new_incident(spark):
    msgs = _messages(spark, [_msg(1, 1000, "2024-01-01T10:00:00"), _msg(1, 1000, "2024-01-01T10:00:05")])
    assert bp.merge_reports(bp.reports(bp.parse_messages(msgs))).count() == 2


def test_null_handle_never_merges(spark):
    msgs = _messages(spark, [_msg(1, 5000, "2024-01-01T10:00:00", handle=""),
                             _msg(1, 9000, "2024-01-01T10:00:04", handle="")])
    assert bp.merge_reports(bp.reports(bp.parse_messages(msgs))).count() == 2


def test_malformed_xml_goes_to_error_output(spark):
    msgs = _messages(spark, ["<EVENT_INSTANCE><", _msg(1, 5000, "2024-01-01T10:00:00")])
    parsed = bp.parse_messages(msgs)
    assert bp.parse_errors(parsed).count() == 1
    assert bp.merge_reports(bp.reports(parsed)).count() == 1


def test_end_dialog_is_skipped(spark):
    msgs = spark.createDataFrame([("http://x/EndDialog", dt.datetime(2024, 1, 1), "")],
                                 "message_type_name string, event_ts timestamp_ntz, message_body string")
    assert bp.parse_messages(msgs).count() == 0


def test_merge_is_partition_invariant(spark):
    msgs = relation(spark, SF_SMALL, "blocked_process_messages")
    reps = bp.reports(bp.parse_messages(msgs))
    a = sorted((r.report_id, r.wait_time) for r in bp.merge_reports(reps, num_partitions=1).collect())
    b = sorted((r.report_id, r.wait_time) for r in bp.merge_reports(reps.repartition(7), num_partitions=13)
               .collect())
    assert a == b and len(a) > 0


def test_enrich_lookups(spark):
    msgs = _messages(spark, [_msg(1, 5000, "2024-01-01T10:00:00", handle='sqlhandle="0x07" stmtstart="2" stmtend="8" ')])
    inc = bp.merge_reports(bp.reports(bp.parse_messages(msgs)))
    text = spark.createDataFrame([(7, "abcdefghij")], "sql_handle long, text string")
    requests = spark.createDataFrame([(1, 7, 2, 8, 70)], "session_id long, sql_handle long, "
                                     "statement_start_offset long, statement_end_offset long, plan_handle long")
    qs = spark.createDataFrame([(7, 2, 8, dt.datetime(2023, 1, 1), dt.datetime(2025, 1, 1), 71)],
                               "sql_handle long, statement_start_offset long, statement_end_offset long, "
                               "creation_time timestamp_ntz, last_execution_time timestamp_ntz, plan_handle long")
    plans = spark.createDataFrame([(70, "<er/>"), (71, "<qs/>")], "plan_handle long, query_plan string")
    r = bp.enrich(inc, requests, qs, text, plans).first()
    assert r.blocked_sql == "bcde" and r.blocked_query_plan == "<er/>"
    r2 = bp.enrich(inc, requests.filter("false"), qs, text, plans).first()
    assert r2.blocked_query_plan == "<qs/>"


def test_stream_inserts_equal_batch_incidents(spark, scratch):
    msgs = relation(spark, SF_SMALL, "blocked_process_messages")
    src = scratch + "/queue"
    # Three files, arriving in queue order, as a queue exporter would write
    # them: the file source takes files oldest first, so their times are set.
    import glob
    import os
    msgs.repartitionByRange(3, "event_ts").sortWithinPartitions("event_ts").write.parquet(src)
    for i, f in enumerate(sorted(glob.glob(src + "/part-*.parquet"))):
        os.utime(f, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
    batch = bp.merge_reports(bp.reports(bp.parse_messages(msgs)))
    expected = {(r.report_id, r.wait_time) for r in batch.collect()}

    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    changes = bp.merge_stream(bp.reports(bp.parse_messages(stream)), lateness_seconds=1000 * 86400)
    out = scratch + "/changes"
    q = (changes.writeStream.trigger(availableNow=True).option("checkpointLocation", scratch + "/ckpt")
         .foreachBatch(lambda df, i: bp.write_changes(df, i, out)).start())
    q.awaitTermination()
    log = spark.read.parquet(out)
    inserted = {r.incident_id for r in log.filter(F.col("change") == "insert").collect()}
    assert inserted == {rid for rid, _ in expected}
    closed = {(r.incident_id, r.wait_time) for r in log.filter(F.col("change") == "close").collect()}
    assert closed <= expected


def test_streaming_job_end_to_end_with_bad_message(spark, scratch):
    good = [_msg(1, 5000, "2024-01-01T10:00:00"), _msg(1, 9000, "2024-01-01T10:00:04"),
            _msg(2, 100, "2024-01-01T11:00:00")]
    msgs = _messages(spark, good + ["<EVENT_INSTANCE><"])
    msgs.coalesce(1).write.parquet(scratch + "/queue")
    q1, q2 = bp.start_blocking_job(spark, scratch + "/queue", scratch + "/out", scratch + "/ckpt",
                               trigger={"availableNow": True})
    q1.awaitTermination()
    q2.awaitTermination()
    changes = spark.read.parquet(scratch + "/out/changes")
    assert changes.filter("change = 'insert'").count() == 2
    assert spark.read.parquet(scratch + "/out/alerts").count() == 2
    assert spark.read.parquet(scratch + "/out/capture").filter("kind = 'error'").count() == 1
    cur = {r.event_date.hour: r.wait_time for r in bp.current_incidents(changes).collect()}
    assert cur[11] == 100


def test_hot_keys_split_into_episodes_exactly(spark):
    """The same incidents whatever partitions the keys are cut over."""
    msgs = relation(spark, SF_SMALL, "blocked_process_messages")
    reps = bp.reports(bp.parse_messages(msgs))
    plain = sorted((r.report_id, r.wait_time) for r in bp.merge_reports(reps).collect())
    split = sorted((r.report_id, r.wait_time) for r in bp.merge_reports(reps, num_partitions=7)
                   .collect())
    assert split == plain and len(plain) > 0


def test_one_hot_key_many_episodes(spark):
    """A single key with many episodes spread over partitions equals the brute-force fold."""
    rng = random.Random(3)
    bodies, raw, t = [], [], dt.datetime(2024, 1, 1, 10, 0, 0)
    for i in range(400):
        t += dt.timedelta(seconds=rng.choice([1, 2, 3, 30, 200]))
        w = rng.choice([500, 1500, 2500, 60000, 400000])
        bodies.append(_msg(1, w, t.strftime("%Y-%m-%dT%H:%M:%S")))
        raw.append((int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000), w))
    rows = [("EventNotification", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), b) for i, b in enumerate(bodies)]
    msgs = spark.createDataFrame(rows, "message_type_name string, event_ts timestamp_ntz, message_body string")
    got = sorted((int((r.event_date - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000), r.wait_time)
                 for r in bp.merge_reports(bp.reports(bp.parse_messages(msgs)), num_partitions=9)
                 .collect())
    want = sorted((t0, w) for _rid, t0, w in brute_force([(t, w, i) for i, (t, w) in enumerate(raw)]))
    assert got == want and len(want) > 5


def test_identical_messages(spark):
    """A message delivered twice is one incident; with a NULL in the key, two, with ids of their own."""
    full = _msg(1, 5000, "2024-01-01T10:00:00")
    null = _msg(2, 5000, "2024-01-01T10:00:00").replace('waitresource=', 'nowaitresource=')
    rows = [("EventNotification", dt.datetime(2024, 1, 1), b) for b in (full, full, null, null)]
    msgs = spark.createDataFrame(rows, "message_type_name string, event_ts timestamp_ntz, message_body string")
    for n in (None, 5):
        inc = bp.merge_reports(bp.reports(bp.parse_messages(msgs)), num_partitions=n).collect()
        assert sorted(r.blocked_spid for r in inc) == [1, 2, 2]
        assert len({r.incident_id for r in inc}) == 3


def test_resources_with_a_common_prefix_stay_apart(spark):
    a = _msg(1, 5000, "2024-01-01T10:00:00")
    res = re.search(r'waitresource="([^"]*)"', a).group(1)
    long = [a.replace(res, "KEY: " + "9" * 80 + end) for end in "ab"]
    inc = bp.merge_reports(bp.reports(bp.parse_messages(_messages(spark, long)))).collect()
    assert sorted(r.resource[-1] for r in inc) == ["a", "b"]


def test_stream_keeps_servers_apart_and_queue_order(spark, scratch):
    """Two servers, one key's reports in reverse file order, Arrow chunks of two rows: the batch result."""
    rows = []
    for server in ("A", "B"):
        for i in range(12):
            at = dt.datetime(2024, 1, 1, 10) + dt.timedelta(seconds=5 * i)
            rows.append((server, "EventNotification", at, _msg(1, 5000 * i, at.strftime("%Y-%m-%dT%H:%M:%S"))))
    msgs = spark.createDataFrame(rows[::-1], "server_name string, message_type_name string, event_ts timestamp_ntz, message_body string")
    msgs.coalesce(1).write.parquet(scratch + "/queue")
    exported = read_queue(spark, scratch + "/queue")  # the batch form, with the queue's message ids
    want = sorted((r.server_name, r.incident_id) for r in bp.merge_reports(bp.reports(bp.parse_messages(exported))).collect())
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        for q in bp.start_blocking_job(spark, scratch + "/queue", scratch + "/out", scratch + "/ckpt", trigger={"availableNow": True}):
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    log = spark.read.parquet(scratch + "/out/changes").filter("change = 'insert'").collect()
    assert sorted((r.server_name, r.incident_id) for r in log) == want and len(want) == 2


def test_change_log_sink_is_idempotent_per_batch(spark, scratch):
    changes = spark.createDataFrame([("s", "r1", "insert", dt.datetime(2024, 1, 1), 5, None),
                                     ("s", "r2", "insert", dt.datetime(2024, 1, 1), 7, None)], bp.CHANGE_SCHEMA)
    seen = []
    for _ in range(2):  # a replayed micro-batch (same id) after a failure
        bp.write_changes(changes, 4, scratch + "/log", on_insert=lambda df, i: seen.append((df.count(), i)))
    bp.write_changes(changes.limit(1), 5, scratch + "/log")
    log = spark.read.parquet(scratch + "/log")
    assert log.count() == 3
    assert seen == [(2, 4), (2, 4)]


def test_servers_never_merge_with_each_other(spark):
    one = _messages(spark, [_msg(1, 5000, "2024-01-01T10:00:00"), _msg(1, 9000, "2024-01-01T10:00:04")])
    two = one.withColumn("server_name", F.lit("A")).unionByName(one.withColumn("server_name", F.lit("B")))
    inc = bp.merge_reports(bp.reports(bp.parse_messages(two))).collect()
    assert sorted((r.server_name, r.wait_time) for r in inc) == [("A", 9000), ("B", 9000)]
    text = spark.createDataFrame([("A", 1, "text of A"), ("B", 1, "text of B")],
                                 "server_name string, sql_handle long, text string")
    req = spark.createDataFrame([], "server_name string, session_id long, sql_handle long, "
                                    "statement_start_offset long, statement_end_offset long, plan_handle long")
    qs = spark.createDataFrame([], "server_name string, sql_handle long, statement_start_offset long, "
                                   "statement_end_offset long, creation_time timestamp_ntz, "
                                   "last_execution_time timestamp_ntz, plan_handle long")
    plans = spark.createDataFrame([], "server_name string, plan_handle long, query_plan string")
    log = bp.event_log(two, req, qs, text, plans).collect()
    assert sorted((r.server_name, r.blocked_sql) for r in log) == [("A", "text of A"), ("B", "text of B")]


def test_stream_restart_resumes_state(spark, scratch):
    """Stop after two queue files, restart on the same checkpoint with a third: same incidents as batch."""
    import glob
    import os
    msgs = relation(spark, SF_SMALL, "blocked_process_messages")
    staged = scratch + "/staged"
    msgs.repartitionByRange(3, "event_ts").sortWithinPartitions("event_ts").write.parquet(staged)
    files = sorted(glob.glob(staged + "/part-*.parquet"))
    queue = scratch + "/queue"
    os.makedirs(queue)

    def arrive(i):
        data = open(files[i], "rb").read()
        with open(f"{queue}/part-{i:05d}.parquet", "wb") as f:
            f.write(data)
        os.utime(f"{queue}/part-{i:05d}.parquet", (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))

    def run():
        stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(queue)
        changes = bp.merge_stream(bp.reports(bp.parse_messages(stream)), lateness_seconds=1000 * 86400)
        q = (changes.writeStream.trigger(availableNow=True).option("checkpointLocation", scratch + "/ckpt")
             .foreachBatch(lambda df, i: bp.write_changes(df, i, scratch + "/changes")).start())
        q.awaitTermination()

    arrive(0)
    arrive(1)
    run()
    first = spark.read.parquet(scratch + "/changes").filter("change = 'insert'").count()
    arrive(2)
    run()  # restart: the checkpoint holds the offsets and each key's fold state
    inserted = {r.incident_id for r in spark.read.parquet(scratch + "/changes").filter("change = 'insert'").collect()}
    expected = {r.report_id for r in bp.merge_reports(bp.reports(bp.parse_messages(msgs))).collect()}
    assert 0 < first < len(expected)
    assert inserted == expected


REALISTIC = """<EVENT_INSTANCE>
  <EventType>BLOCKED_PROCESS_REPORT</EventType>
  <PostTime>2024-03-05T14:22:31.517</PostTime>
  <SPID>5</SPID>
  <TextData>
    <blocked-process-report monitorLoop="171">
      <blocked-process>
        <process id="process2f0" taskpriority="0" logused="0" waitresource="KEY: 7:72057594045595648 (8194443284a0)"
                 waittime="21093" ownerId="8371" transactionname="SELECT" lasttranstarted="2024-03-05T14:22:10.420"
                 XDES="0x1f" lockMode="S" schedulerid="2" kpid="1" status="suspended" spid="57" sbid="0" ecid="0"
                 priority="0" trancount="0" clientapp="app" hostname="h" isolationlevel="read committed (2)"
                 xactid="8371" currentdb="7">
          <executionStack>
            <frame line="3" stmtstart="54" stmtend="130" sqlhandle="0x0300070051fa"/>
            <frame line="1" sqlhandle="0x01000700aa"/>
          </executionStack>
          <inputbuf>
select * from t where a &lt; 5 and b &amp; 1 = 1   </inputbuf>
        </process>
      </blocked-process>
      <blocking-process>
        <process status="sleeping" spid="54" sbid="0" ecid="0" priority="0" trancount="1" lastbatchstarted="x">
          <executionStack>
            <frame line="2" stmtstart="26" sqlhandle="0x02000000ff"/>
          </executionStack>
          <inputbuf>begin tran update t set a = 1</inputbuf>
        </process>
      </blocking-process>
    </blocked-process-report>
  </TextData>
  <DatabaseID>7</DatabaseID>
  <StartTime>2024-03-05T14:22:31.513</StartTime>
</EVENT_INSTANCE>"""


def test_realistic_report_parses(spark):
    msgs = spark.createDataFrame([("http://schemas.microsoft.com/SQL/Notifications/EventNotification",
                                   dt.datetime(2024, 3, 5, 14, 22, 32), REALISTIC)],
                                 "message_type_name string, event_ts timestamp_ntz, message_body string")
    r = bp.reports(bp.parse_messages(msgs)).first()
    assert (r.blocked_spid, r.blocking_spid, r.wait_time, r.blocked_xact_id) == (57, 54, 21093, 8371)
    assert r.resource == "KEY: 7:72057594045595648 (8194443284a0)"
    assert r.blocked_isolation_level == "read committed (2)"
    assert bytes(r.blocked_sql_handle).hex() == "0300070051fa"  # the first frame
    assert (r.blocked_stmt_start, r.blocked_stmt_end) == (54, 130)
    assert (r.blocking_stmt_start, r.blocking_stmt_end) == (26, -1)
    assert "a < 5 and b & 1 = 1" in r.blocked_input_buf  # entities decoded
    assert str(r.event_date) == "2024-03-05 14:22:31.513000"
    assert r.blocked_process_report.startswith('<blocked-process-report monitorLoop="171">')
    ev = bp.capture_events(bp.parse_messages(msgs)).first()
    assert str(ev.alert_time) == "2024-03-05 14:22:31.517000" and ev.database_id == 7


def test_stream_closes_incident_with_final_wait(spark, scratch):
    """Key 1 goes quiet while key 2 moves the watermark on: key 1's incident closes with its last wait."""
    import glob
    import os
    queue = scratch + "/queue"
    batches = [
        [_msg(1, 1000, "2024-01-01T10:00:00"), _msg(1, 6000, "2024-01-01T10:00:05")],  # key 1: one incident
        [_msg(2, 1000, "2024-01-01T11:00:00")],
        [_msg(2, 1000, "2024-01-01T12:00:00")],  # watermark 10:50 now passes 10:00:05 + 10 min
        [_msg(1, 1000, "2024-01-01T13:00:00")],  # key 1 again: fresh state, a new incident
    ]
    seen = set()
    for i, bodies in enumerate(batches):
        rows = [("EventNotification", dt.datetime(2024, 1, 1, 9) + dt.timedelta(minutes=10 * i + j), b)
                for j, b in enumerate(bodies)]
        spark.createDataFrame(rows, "message_type_name string, event_ts timestamp_ntz, message_body string") \
            .coalesce(1).write.mode("append").parquet(queue)
        for f in set(glob.glob(queue + "/*.parquet")) - seen:  # the file source takes oldest first
            os.utime(f, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
            seen.add(f)
    schema = "message_type_name string, event_ts timestamp_ntz, message_body string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(queue)
    changes = bp.merge_stream(bp.reports(bp.parse_messages(stream)), lateness_seconds=600)
    q = (changes.writeStream.trigger(availableNow=True).option("checkpointLocation", scratch + "/ckpt")
         .foreachBatch(lambda df, i: bp.write_changes(df, i, scratch + "/changes")).start())
    q.awaitTermination()
    log = spark.read.parquet(scratch + "/changes")
    closes = {(str(r.event_date), r.wait_time) for r in log.filter("change = 'close'").collect()}
    assert ("2024-01-01 10:00:00", 6000) in closes
    inserts = sorted(str(r.event_date) for r in log.filter("change = 'insert'").collect())
    assert inserts == ["2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 12:00:00", "2024-01-01 13:00:00"]


def test_close_before_matches_final_waits():
    """Closing incidents early gives the same final waits when the key stays busy past them."""
    rng = random.Random(11)
    fold, whole = KeyFold(), KeyFold()
    t, closed = 0, []
    for i in range(300):
        t += rng.choice([1, 2, 5, 400]) * 1_000_000
        w = rng.choice([500, 1500, 3000, 9000])
        fold.step(t, w, i, SLACK)
        whole.step(t, w, i, SLACK)
        if i % 20 == 19:  # every batch, close what is untouched for 60 s
            closed += fold.close_before(t - 60_000_000)
    assert len(closed) > 5 and len(fold.incidents) < len(whole.incidents)
    assert len(fold.stamp_thr) <= len(whole.stamp_thr)
    assert sorted(closed + list(fold.final_waits())) == sorted(whole.final_waits())


def test_busy_key_closes_old_incidents_in_stream(spark, scratch):
    """One key stays busy: its first incident closes while later reports keep arriving."""
    import glob
    import os
    queue = scratch + "/queue"
    batches = [
        [_msg(1, 1000, "2024-01-01T10:00:00"), _msg(1, 6000, "2024-01-01T10:00:05")],
        [_msg(1, 1000, "2024-01-01T11:00:00")],  # same key, new incident, watermark 10:50 after this batch
        [_msg(1, 1000, "2024-01-01T12:00:00")],  # the 10:00 incident closes here, the key is never idle
    ]
    seen = set()
    for i, bodies in enumerate(batches):
        rows = [("EventNotification", dt.datetime(2024, 1, 1, 9) + dt.timedelta(minutes=10 * i + j), b)
                for j, b in enumerate(bodies)]
        spark.createDataFrame(rows, "message_type_name string, event_ts timestamp_ntz, message_body string") \
            .coalesce(1).write.mode("append").parquet(queue)
        for f in set(glob.glob(queue + "/*.parquet")) - seen:
            os.utime(f, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
            seen.add(f)
    schema = "message_type_name string, event_ts timestamp_ntz, message_body string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(queue)
    changes = bp.merge_stream(bp.reports(bp.parse_messages(stream)), lateness_seconds=600)
    q = (changes.writeStream.trigger(availableNow=True).option("checkpointLocation", scratch + "/ckpt")
         .foreachBatch(lambda df, i: bp.write_changes(df, i, scratch + "/changes")).start())
    q.awaitTermination()
    log = spark.read.parquet(scratch + "/changes")
    closes = {(str(r.event_date), r.wait_time) for r in log.filter("change = 'close'").collect()}
    assert ("2024-01-01 10:00:00", 6000) in closes
    assert sorted(str(r.event_date) for r in log.filter("change = 'insert'").collect()) == [
        "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 12:00:00"]


def test_no_reports_gives_empty_results(spark):
    msgs = spark.createDataFrame([("http://x/EndDialog", dt.datetime(2024, 1, 1), "")],
                                 "message_type_name string, event_ts timestamp_ntz, message_body string")
    assert bp.merge_reports(bp.reports(bp.parse_messages(msgs))).count() == 0
    text = spark.createDataFrame([], "sql_handle long, text string")
    req = spark.createDataFrame([], "session_id long, sql_handle long, statement_start_offset long, "
                                    "statement_end_offset long, plan_handle long")
    qs = spark.createDataFrame([], "sql_handle long, statement_start_offset long, statement_end_offset long, "
                                   "creation_time timestamp_ntz, last_execution_time timestamp_ntz, plan_handle long")
    plans = spark.createDataFrame([], "plan_handle long, query_plan string")
    assert bp.event_log(msgs, req, qs, text, plans).count() == 0


def test_streaming_job_reads_json_queue(spark, scratch):
    msgs = _messages(spark, [_msg(1, 5000, "2024-01-01T10:00:00"), _msg(1, 9000, "2024-01-01T10:00:04"),
                             _msg(3, 100, "2024-01-01T10:30:00")])
    msgs.coalesce(1).write.json(scratch + "/queue")
    q1, q2 = bp.start_blocking_job(spark, scratch + "/queue", scratch + "/out", scratch + "/ckpt", fmt="json",
                                   trigger={"availableNow": True})
    q1.awaitTermination()
    q2.awaitTermination()
    changes = spark.read.parquet(scratch + "/out/changes")
    assert changes.filter("change = 'insert'").count() == 2


def test_event_log_moves_reports_once_and_texts_never(spark, monkeypatch):
    """texts on every incident, one handle with two texts; reports are stored once, texts and plans not at all."""
    from dbtelemetry.sources import sinks

    n, size = 40, 3000
    msgs = _messages(spark, [_msg(i, 5000, "2024-01-01T10:00:00", handle='sqlhandle="0x07" ' if i % 2 else 'sqlhandle="0x08" ') for i in range(n)])
    text = spark.createDataFrame([(7, "x" * size), (7, "y" * size), (8, "z" * size)] + [(h, "unused") for h in range(100, 400)], "sql_handle long, text string")
    requests = spark.createDataFrame([(i, 7, 0, -1, 70 + i % 3) for i in range(n)] + [(1, 300, 0, -1, 70)], "session_id long, sql_handle long, "
                                     "statement_start_offset long, statement_end_offset long, plan_handle long")
    qs = spark.createDataFrame([(8, 0, -1, dt.datetime(2023, 1, 1), dt.datetime(2025, 1, 1), 71), (8, 0, -1, dt.datetime(2023, 1, 1), dt.datetime(2024, 6, 1), 70)],
                               "sql_handle long, statement_start_offset long, statement_end_offset long, "
                               "creation_time timestamp_ntz, last_execution_time timestamp_ntz, plan_handle long")
    plans = spark.createDataFrame([(70, "<a/>"), (71, "<b/>"), (72, None)], "plan_handle long, query_plan string")
    stored, store = [], sinks.materialize

    def watched(df, *args, **kinds):
        out = store(df, *args, **kinds)
        stored.append(out)
        return out

    monkeypatch.setattr(sinks, "materialize", watched)
    out = bp.event_log(msgs, requests, qs, text, plans)
    got = sorted((r.blocked_spid, r.blocked_sql[0], len(r.blocked_sql), r.blocked_query_plan, r.blocking_sql) for r in out.collect())
    odd = [(i, c, size, {0: "<a/>", 1: "<b/>", 2: None}[i % 3], None) for i in range(1, n, 2) for c in "xy"]
    assert got == sorted(odd + [(i, "z", size, "<b/>", None) for i in range(0, n, 2)], key=lambda r: r[:3])
    assert sum("blocked_process_report" in t.columns for t in stored) == 1
    assert not any(c.endswith(("text", "_sql", "query_plan")) for t in stored for c in t.columns)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("ShuffledHashJoin")]
    assert plan.count("ShuffledHashJoin") >= 5 and "Exchange" not in top and "Sort" not in top
    # Merge keys are short whatever they consist of.
    keys = next(t for t in stored if "__null_key" in t.columns).select(F.length("__key").alias("n")).distinct().collect()
    assert [r.n for r in keys] == [16]
