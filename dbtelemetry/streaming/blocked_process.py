"""Blocked-process job: capture, merge and alert.

Messages (type, XML body, arrival time) come from a queue: a file or Kafka
stream in production, a DataFrame in batch. ``from_xml`` parses them with
a fixed schema; malformed XML yields NULL fields and goes to an error
output instead of stopping the job. The merge of repeated reports is the
fold of :mod:`dbtelemetry.streaming.merge_fold`, run per merge key:

* batch: every key's reports are cut into independent episodes by window
  passes over narrow columns; single reports are incidents at once, longer
  episodes stream through the fold (``mapInArrow``) in parallel;
* streaming: incident state with event-time timers per merge key
  (:mod:`dbtelemetry.streaming.incidents`), with a watermark on the report
  time; an incident is closed (its final wait emitted) once the watermark
  passes its last report plus the server's reporting interval, and opened
  again by a later report that reaches back to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dbtelemetry.functions import tsql
from dbtelemetry.operators.asof import latest_covering
from dbtelemetry.operators.common import db_name, of_needed, spread_left_join
from dbtelemetry.operators.ordering import with_found
from dbtelemetry.sources import sinks
from dbtelemetry.sources.readers import message_source, over_all_cores
from dbtelemetry.streaming.merge_fold import fold_sorted_partitions

# Fixed values of the event source and the merge.
NOTIFICATION_TYPE_SUFFIX = "EventNotification"
END_DIALOG_SUFFIX = "EndDialog"
BLOCKED_PROCESS_REPORT = "BLOCKED_PROCESS_REPORT"
MERGE_SLACK_MS = 100
DEFAULT_STMT_START = 0
DEFAULT_STMT_END = -1

_FRAME = "ARRAY<STRUCT<_sqlhandle: STRING, _stmtstart: INT, _stmtend: INT>>"
_PROCESS_FIELDS = (f"_spid: INT, _waittime: BIGINT, _waitresource: STRING, _xactid: BIGINT, _lockMode: STRING, "
                   f"_isolationlevel: STRING, _status: STRING, _trancount: INT, "
                   f"executionStack: STRUCT<frame: {_FRAME}>, inputbuf: STRING")
EVENT_SCHEMA = (
    "EventType STRING, PostTime STRING, DatabaseID INT, StartTime STRING, "
    "TextData STRUCT<`blocked-process-report`: STRUCT<"
    f"`blocked-process`: STRUCT<process: STRUCT<{_PROCESS_FIELDS}>>, "
    f"`blocking-process`: STRUCT<process: STRUCT<{_PROCESS_FIELDS}>>>>")

# Merge key: plain equality except the transaction id (NULL matches NULL).
PLAIN_KEY = ("blocked_spid", "resource", "blocking_spid", "blocked_sql_handle", "blocked_stmt_start",
             "blocked_stmt_end")
MERGE_KEY = ("blocked_spid", "blocked_xact_id_key", "resource", "blocking_spid", "blocked_sql_handle",
             "blocked_stmt_start", "blocked_stmt_end")
# Fleet column carried from the queue when present: it joins the merge key and
# every lookup, so reports of two servers never merge or borrow each other's text.
FLEET_COLUMNS = ("server_name",)


def _fleet(*dfs: DataFrame) -> list[str]:
    return [c for c in FLEET_COLUMNS if all(c in d.columns for d in dfs)]


def _merge_key(df: DataFrame) -> list[str]:
    return _fleet(df) + list(MERGE_KEY)


def _ts(text: Column) -> Column:
    """XML ``datetime`` text (``T`` or blank between date and time) as TIMESTAMP_NTZ."""
    return F.regexp_replace(text, "T", " ").try_cast("timestamp_ntz")


def _handle(hex_text: Column) -> Column:
    """``xs:hexBinary(substring(h, 3))``: the bytes after ``0x``; empty gives NULL."""
    digits = hex_text.substr(F.lit(3), F.length(hex_text))
    return F.when(F.length(digits) > 0, F.unhex(digits))


def _report_id(messages: DataFrame, arrival_col: str, body_col: str) -> Column:
    """The queue's message id; for messages without one, a hash of server, arrival time and body."""
    by_content = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in _fleet(messages)],
                                    F.col(arrival_col).cast("string"), F.col(body_col)), 256)
    return F.coalesce("message_id", by_content) if "message_id" in messages.columns else by_content


def parse_messages(messages: DataFrame, body_col: str = "message_body", type_col: str = "message_type_name",
                   arrival_col: str = "event_ts") -> DataFrame:
    """Route by message type and parse notification bodies.

    End-of-dialog messages are dropped (the conversation just ends). Every
    other message is parsed; ``parse_ok`` is false when the body is not
    well-formed XML with an event type.
    """
    m = over_all_cores(messages).filter(~F.col(type_col).endswith(END_DIALOG_SUFFIX))
    # explode(array(...)) is an evaluation barrier: without it the optimizer
    # pushes the routing filters below this projection and parses each
    # message once per referenced field.
    x = F.explode(F.array(F.from_xml(F.col(body_col), EVENT_SCHEMA)))
    return m.select(*_fleet(messages), F.col(arrival_col).alias("arrival_ts"),
                    F.col(type_col).alias("message_type_name"),
                    F.col(body_col).alias("message_body"), x.alias("x"),
                    _report_id(messages, arrival_col, body_col).alias("report_id")) \
        .withColumn("parse_ok", F.col("x.EventType").isNotNull())


_OPEN, _CLOSE = "<blocked-process-report", "</blocked-process-report>"


def _report_fragment(body: Column) -> Column:
    """From the first ``<blocked-process-report`` to the end of the last
    ``</blocked-process-report>``; NULL when either is missing. Index
    arithmetic only (no backtracking regular expression)."""
    start = F.length(F.substring_index(body, _OPEN, 1)) + 1
    end = F.length(body) - F.length(F.substring_index(body, _CLOSE, -1))
    found = (F.locate(_OPEN, body) > 0) & (F.locate(_CLOSE, body) > 0) & (end >= start)
    return F.when(found, body.substr(start, end - start + 1))


def capture_events(parsed: DataFrame, databases: DataFrame | None = None) -> DataFrame:
    """One event row per parsed notification (any event type).

    Columns: event type, alert time (``PostTime``), event date
    (``StartTime``), database, the blocked-process-report fragment and
    the whole message; the audit time is the message's arrival time.
    """
    ok = parsed.filter("parse_ok")
    out = ok.select(
        F.col("x.EventType").alias("event_type"),
        _ts(F.col("x.PostTime")).alias("alert_time"),
        _ts(F.col("x.StartTime")).alias("event_date"),
        F.col("x.DatabaseID").alias("database_id"),
        _report_fragment(F.col("message_body")).alias("blocked_process_report"),
        F.col("message_body").alias("blocking_event_data"),
        F.col("arrival_ts").alias("audit_date"))
    if databases is not None:
        out = db_name(out, databases, "database_id", out="database_name")
    return out


def parse_errors(parsed: DataFrame) -> DataFrame:
    """Messages whose body could not be parsed (the error output)."""
    return parsed.filter(~F.col("parse_ok")).select("arrival_ts", "message_type_name", "message_body")


def reports(parsed: DataFrame) -> DataFrame:
    """Blocked-process reports as typed rows (the reference's ``repData``).

    Only event notifications are parsed as reports; other message types
    are ignored, as the merge procedure does. The whole message is not
    carried on (its id is already ``report_id``); the report XML is, as
    ``blocked_process_report``.
    """
    r = parsed.filter(F.col("message_type_name").endswith(NOTIFICATION_TYPE_SUFFIX) & F.col("parse_ok")
                      & (F.col("x.EventType") == BLOCKED_PROCESS_REPORT))
    return r.select(*_report_columns(_fleet(parsed)))


def _report_columns(fleet: list[str]) -> list:
    """The typed columns of a parsed report."""
    bp = "x.TextData.`blocked-process-report`.`blocked-process`.process"
    bk = "x.TextData.`blocked-process-report`.`blocking-process`.process"
    bframe = F.get(F.col(f"{bp}.executionStack.frame"), F.lit(0))
    kframe = F.get(F.col(f"{bk}.executionStack.frame"), F.lit(0))
    return [
        *fleet, "report_id", "arrival_ts",
        _ts(F.col("x.StartTime")).alias("event_date"),
        F.col("x.DatabaseID").alias("database_id"),
        F.col(f"{bp}._waitresource").alias("resource"),
        F.col(f"{bp}._waittime").alias("wait_time"),
        F.col(f"{bp}._spid").alias("blocked_spid"),
        F.col(f"{bp}._xactid").alias("blocked_xact_id"),
        F.col(f"{bp}._lockMode").alias("blocked_lock_mode"),
        F.col(f"{bp}._isolationlevel").alias("blocked_isolation_level"),
        _handle(bframe["_sqlhandle"]).alias("blocked_sql_handle"),
        F.coalesce(bframe["_stmtstart"], F.lit(DEFAULT_STMT_START)).alias("blocked_stmt_start"),
        F.coalesce(bframe["_stmtend"], F.lit(DEFAULT_STMT_END)).alias("blocked_stmt_end"),
        F.col(f"{bp}.inputbuf").alias("blocked_input_buf"),
        F.col(f"{bk}._spid").alias("blocking_spid"),
        F.col(f"{bk}._status").alias("blocking_status"),
        F.col(f"{bk}._trancount").alias("blocking_tran_count"),
        F.col(f"{bk}.inputbuf").alias("blocking_input_buf"),
        _handle(kframe["_sqlhandle"]).alias("blocking_sql_handle"),
        F.coalesce(kframe["_stmtstart"], F.lit(DEFAULT_STMT_START)).alias("blocking_stmt_start"),
        F.coalesce(kframe["_stmtend"], F.lit(DEFAULT_STMT_END)).alias("blocking_stmt_end"),
        _report_fragment(F.col("message_body")).alias("blocked_process_report"),
    ]


def _keyed(reps: DataFrame) -> DataFrame:
    null_key = None
    for c in PLAIN_KEY:
        cond = F.col(c).isNull()
        null_key = cond if null_key is None else (null_key | cond)
    return (reps.withColumn("blocked_xact_id_key", F.coalesce(F.col("blocked_xact_id"), F.lit(-1)))
            .withColumn("__null_key", null_key | F.col("event_date").isNull() | F.col("wait_time").isNull()))


def _micros(c: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(c))


def _episodes(narrow: DataFrame, slack: int, num_partitions: int | None) -> DataFrame:
    """Split every key's reports into independent episodes (see ``merge_fold``): ``__ep``, ``__alone`` per report.

    The narrow columns are range-partitioned by (key, queue order), so one
    hot key spans many partitions, and numbered in that order; the number
    (``__pos``) stands for the queue order from then on. Running maxima of the
    report time and minima of the threshold are windows per (partition, key);
    what other partitions hold of the same key comes from one aggregate row per
    (partition, key). An episode is named by the row id of its first
    report; ``__alone`` marks episodes known to hold a single report.
    """
    n = num_partitions or int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["__arr", "__ord", "__rid"]
    srt = narrow.repartitionByRange(n, "__key", *order).sortWithinPartitions("__key", *order)
    # Stored, so that the partition numbers and places stay as they are.
    srt = sinks.materialize(srt.select("__key", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__pos"),
                                       "__rid", "__t", "__w"), columnar=True)
    srt = srt.withColumn("__thr", F.col("__t") - (F.col("__w") * 1000 + slack))
    by_pid = Window.partitionBy("__key").orderBy("__pid")
    summ = srt.groupBy("__pid", "__key").agg(F.max("__t").alias("__mt"), F.min("__thr").alias("__mthr"))
    carries = summ.select(
        "__pid", "__key",
        F.max("__mt").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)).alias("__t_in"),
        F.min("__mthr").over(by_pid.rowsBetween(1, Window.unboundedFollowing)).alias("__thr_in"),
    ).filter(F.col("__t_in").isNotNull() | F.col("__thr_in").isNotNull())
    # Only a partition's first and last key can span partitions: <= 2 rows per partition.
    rows = srt.join(F.broadcast(carries), ["__pid", "__key"], "left")
    run = Window.partitionBy("__pid", "__key").orderBy("__pos")
    back = Window.partitionBy("__pid", "__key").orderBy(F.col("__pos").desc())
    before = F.greatest("__t_in", F.max("__t").over(run.rowsBetween(Window.unboundedPreceding, -1)))
    after = F.least("__thr_in", F.min("__thr").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    # Backward first: all forward windows then share one sort.
    rows = rows.withColumn("__after", after).withColumn("__before", before)
    split = F.col("__before").isNull() | (F.col("__before") < F.col("__after"))
    rows = rows.withColumn("__split", split)
    opener = F.when(F.col("__split"), F.col("__rid"))
    rows = rows.withColumn("__seg", F.last(opener, ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    nxt = F.coalesce(F.lead("__split").over(run), F.col("__thr_in").isNull())
    rows = sinks.materialize(rows.withColumn("__alone", F.col("__split") & nxt)
                             .select("__pid", "__key", "__pos", "__rid", "__t", "__w", "__split", "__seg", "__alone"), columnar=True)
    needed = (rows.filter(F.col("__seg").isNull()).select("__pid", "__key").distinct()
              .withColumn("__ls", F.lit(None).cast("long")).withColumn("__kind", F.lit(0)))
    last_split = (rows.filter("__split").groupBy("__pid", "__key")
                  .agg(F.max_by("__rid", "__pos").alias("__ls")).withColumn("__kind", F.lit(1)))
    prior = Window.partitionBy("__key").orderBy("__pid", "__kind").rowsBetween(Window.unboundedPreceding, -1)
    fills = (last_split.unionByName(needed).withColumn("__fill", F.last("__ls", ignorenulls=True).over(prior))
             .filter(F.col("__kind") == 0).select("__pid", "__key", "__fill"))
    # Rows without an episode of their own are a partition's first key: <= 1 row per partition.
    rows = rows.join(F.broadcast(fills), ["__pid", "__key"], "left")
    return rows.select(F.coalesce("__seg", "__fill").alias("__ep"), "__pos", "__rid", "__t", "__w", "__alone")


def _stored(reps: DataFrame) -> DataFrame:
    """The reports, stored, with a unique row id (``__rid``) and their merge key as 128 bits of its hash (``__key``)."""
    k = _keyed(reps)
    key = F.unhex(F.substring(F.sha2(F.to_json(F.struct(*_merge_key(k))), 256), 1, 32))
    return sinks.materialize(k.select(F.monotonically_increasing_id().alias("__rid"), key.alias("__key"), "__null_key", *reps.columns),
                             columnar=True, codec="zstd")


def _openings(rows: DataFrame, slack_ms: int = MERGE_SLACK_MS, num_partitions: int | None = None) -> DataFrame:
    """Row id, final wait (``__w``) and number (``__n``) of each incident among the stored reports, see :func:`merge_reports`."""
    slack = slack_ms * 1000
    narrow = rows.filter(~F.col("__null_key")).select(
        "__key", F.col("arrival_ts").alias("__arr"), F.col("report_id").alias("__ord"), "__rid",
        _micros("event_date").alias("__t"), F.col("wait_time").alias("__w"))
    episodes = _episodes(narrow, slack, num_partitions)
    parts = [num_partitions] if num_partitions else []
    longer = (episodes.filter(~F.col("__alone")).withColumnRenamed("__ep", "__key")
              .repartition(*parts, "__key").sortWithinPartitions("__key", "__pos")
              .select("__key", "__rid", "__t", "__w"))
    folded = longer.mapInArrow(lambda it: fold_sorted_partitions(it, slack), longer.schema).select("__rid", "__w")
    finals = episodes.filter("__alone").select("__rid", "__w").unionByName(folded).withColumn("__n", F.lit(1))
    nth = F.row_number().over(Window.partitionBy("report_id").orderBy("__rid"))
    alone = rows.filter("__null_key").select("__rid", F.col("wait_time").alias("__w"), nth.alias("__n"))
    return finals.unionByName(alone)


def _incident_id() -> Column:
    return F.when(F.col("__n") == 1, F.col("report_id")).otherwise(F.concat_ws("-", "report_id", F.col("__n").cast("string")))


def merge_reports(reps: DataFrame, slack_ms: int = MERGE_SLACK_MS, num_partitions: int | None = None) -> DataFrame:
    """O50, batch form: one row per incident, first report's fields and the final wait.

    Adds ``incident_id``: the first report's ``report_id``; incidents of
    identical messages that may not merge are numbered after it.

    Every report gets a unique row id when the parsed reports are stored.
    All keys take one path on narrow columns: the reports are cut into
    independent episodes (exactly; see ``merge_fold``), an episode of one
    report is its incident, longer ones stream through the fold, hash
    partitioned by episode and sorted in queue order. The opening reports'
    wide rows are fetched once, by row id. A report whose plain-equality
    key has a NULL never matches a stored row and is an incident itself.
    """
    rows = _stored(reps)
    opened = rows.join(_openings(rows, slack_ms, num_partitions), "__rid")
    return opened.withColumns({"wait_time": F.col("__w"), "incident_id": _incident_id()}).select(*reps.columns, "incident_id")


def _handle_key(handle: Column, key_type: T.DataType) -> Column:
    """Report handles are bytes; a lookup keyed by an integer gets their big-endian value."""
    if isinstance(key_type, (T.LongType, T.IntegerType, T.ShortType, T.DecimalType)):
        return F.conv(F.hex(handle), 16, 10).cast("bigint")
    if isinstance(key_type, T.StringType):
        return F.concat(F.lit("0x"), F.hex(handle))
    return handle


def enrich(incidents: DataFrame, requests: DataFrame, query_stats: DataFrame, sql_text: DataFrame,
           plans: DataFrame) -> DataFrame:
    """Statement text and plans of the blocked and the blocking statement.

    Text: lookup by handle (an empty handle gives NULL). Blocked plan: from
    a running request with the same session, handle and offsets, else the
    latest statistics row whose validity covers the event time. Blocking
    plan: latest statistics row for its handle and offsets.

    The lookups by statement give plan handles, never plan texts: one row
    per statement for the two without a time test, the as-of lookup
    :func:`~dbtelemetry.operators.asof.latest_covering` for the other, so a
    statement with many versions and many incidents costs their sum. Texts
    and plans are attached by handle at the end, where the incidents are.
    """
    looked = _looked_up(incidents, "incident_id", requests, query_stats, sql_text, plans)
    out = _stated(incidents, looked, "incident_id", sql_text, plans)  # incident ids include the server
    return out.select(*incidents.columns, *STATEMENT_COLUMNS)


STATEMENT_COLUMNS = ("blocked_sql", "blocking_sql", "blocked_query_plan", "blocking_query_plan")


def _looked_up(incidents: DataFrame, row_id: str, requests: DataFrame, query_stats: DataFrame, sql_text: DataFrame,
               plans: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per incident, stored: its two statements (handle and offsets), their plan handles and the columns ``carried``."""
    hk = sql_text.schema["sql_handle"].dataType
    rk = requests.schema["sql_handle"].dataType
    qk = query_stats.schema["sql_handle"].dataType
    # All lookups run on a narrow projection, stored as several read it.
    nar = sinks.materialize(incidents.select(
        *_fleet(incidents), row_id, *carried, "event_date", "blocked_spid", "blocked_stmt_start", "blocked_stmt_end",
        "blocking_stmt_start", "blocking_stmt_end",
        _handle_key(F.col("blocked_sql_handle"), hk).alias("__bh_t"),
        _handle_key(F.col("blocking_sql_handle"), hk).alias("__kh_t"),
        _handle_key(F.col("blocked_sql_handle"), rk).alias("__bh_r"),
        _handle_key(F.col("blocked_sql_handle"), qk).alias("__bh_q"),
        _handle_key(F.col("blocking_sql_handle"), qk).alias("__kh_q")), columnar=True)
    fr, fq = _fleet(nar, requests, plans), _fleet(nar, query_stats, plans)
    requests = of_needed(requests, nar.withColumnRenamed("__bh_r", "sql_handle"), "sql_handle", fr)
    query_stats = of_needed(query_stats, nar.withColumn("sql_handle", F.explode(F.array("__bh_q", "__kh_q"))), "sql_handle", fq)
    # Only handles that have a plan count.
    there = plans.filter(F.col("query_plan").isNotNull()).select(*_fleet(plans), "plan_handle")
    running = requests.join(there, _fleet(requests, plans) + ["plan_handle"], "left_semi")
    er_key = fr + ["blocked_spid", "__bh_r", "blocked_stmt_start", "blocked_stmt_end"]
    er = (running.select(*fr, F.col("session_id").alias("blocked_spid"), F.col("sql_handle").alias("__bh_r"),
                         F.col("statement_start_offset").alias("blocked_stmt_start"),
                         F.col("statement_end_offset").alias("blocked_stmt_end"), "plan_handle")
          .groupBy(*er_key).agg(F.min("plan_handle").alias("__er_plan")))
    qs = (query_stats.select(*_fleet(query_stats), "sql_handle", "statement_start_offset", "statement_end_offset",
                             "creation_time", "last_execution_time", "plan_handle")
          .join(there, _fleet(query_stats, plans) + ["plan_handle"], "left_semi"))
    k_plan = (qs.groupBy(*fq, F.col("sql_handle").alias("__kh_q"),
                         F.col("statement_start_offset").alias("blocking_stmt_start"),
                         F.col("statement_end_offset").alias("blocking_stmt_end"))
              .agg(F.max(F.struct("last_execution_time", "plan_handle"))["plan_handle"].alias("__k_plan")))
    statement = ["sql_handle", "statement_start_offset", "statement_end_offset"]
    b_in = nar.select(*fq, row_id, "event_date", F.col("__bh_q").alias("sql_handle"),
                      F.col("blocked_stmt_start").cast(qs.schema["statement_start_offset"].dataType).alias("statement_start_offset"),
                      F.col("blocked_stmt_end").cast(qs.schema["statement_end_offset"].dataType).alias("statement_end_offset"))
    b_qs = latest_covering(b_in, qs, fq + statement, row_id, "event_date", "creation_time", "last_execution_time",
                           ["plan_handle"]).withColumnRenamed("plan_handle", "__qs_plan")
    looked = spread_left_join(nar.join(er, er_key, "left"), k_plan, fq + ["__kh_q", "blocking_stmt_start", "blocking_stmt_end"], "__kh_q")
    looked = looked.join(b_qs, row_id, "left")
    return sinks.materialize(looked.select(
        row_id, *carried, *[F.col(c).alias(f"__{c}") for c in _fleet(nar)],
        "__bh_t", F.col("blocked_stmt_start").alias("__b_start"), F.col("blocked_stmt_end").alias("__b_end"),
        "__kh_t", F.col("blocking_stmt_start").alias("__k_start"), F.col("blocking_stmt_end").alias("__k_end"),
        F.coalesce("__er_plan", "__qs_plan").alias("__b_plan"), "__k_plan"), columnar=True)


def _stated(rows: DataFrame, looked: DataFrame, row_id: str, sql_text: DataFrame, plans: DataFrame) -> DataFrame:
    """``rows`` of the incidents ``looked`` up, with the columns of both and the texts of statements and plans.

    A statement is cut from its text once a block of incidents, and moves there once.
    """
    fleet = _fleet(rows)
    ft, fp = [c for c in fleet if c in sql_text.columns], [c for c in fleet if c in plans.columns]

    def needed(lookup: DataFrame, need: DataFrame, f: list[str], handle: str, name: str) -> DataFrame:
        return of_needed(lookup, need.select(*[F.col(f"__{c}").alias(c) for c in f], F.col(handle).alias(name)), name, f)

    def joined(need: DataFrame, lookup: DataFrame, f: list[str], handle: str) -> DataFrame:
        right = lookup.withColumnsRenamed({c: f"__of_{c}" for c in f})
        return need.join(right, [need[handle] == right["__h"], *[need[f"__{c}"] == right[f"__of_{c}"] for c in f]])

    def statement(handle: str, start: str, end: str, out: str):
        def find(need: DataFrame) -> DataFrame:
            texts = needed(sql_text, need, ft, handle, "sql_handle").select(*ft, F.col("sql_handle").alias("__h"), F.col("text").alias("__text"))
            return joined(need, texts, ft, handle).select(*need.columns, tsql.statement_text("__text", start, end).alias(out))

        return (handle, start, end, *[f"__{c}" for c in ft]), find

    def plan(handle: str, out: str):
        def find(need: DataFrame) -> DataFrame:
            one = (needed(plans, need, fp, handle, "plan_handle").groupBy(*fp, F.col("plan_handle").alias("__h"))
                   .agg(F.min("query_plan").alias(out)))
            return joined(need, one, fp, handle).select(*need.columns, out)

        return (handle, *[f"__{c}" for c in fp]), find

    finds = dict([statement("__bh_t", "__b_start", "__b_end", "blocked_sql"), statement("__kh_t", "__k_start", "__k_end", "blocking_sql"),
                  plan("__b_plan", "blocked_query_plan"), plan("__k_plan", "blocking_query_plan")])
    return with_found(rows, looked, row_id, finds, block_rows=INCIDENT_BLOCK)


#: Incidents of one block, which holds their distinct statements in memory.
INCIDENT_BLOCK = 32_768

EVENT_LOG_COLUMNS = ("incident_id", "event_date", "database_id", "resource", "wait_time", "blocked_process_report",
                     "blocked_spid", "blocked_xact_id", "blocked_lock_mode", "blocked_isolation_level",
                     "blocked_sql_handle", "blocked_stmt_start", "blocked_stmt_end", "blocked_sql",
                     "blocked_input_buf", "blocked_query_plan", "blocking_spid", "blocking_status",
                     "blocking_tran_count", "blocking_sql", "blocking_input_buf", "blocking_query_plan")


def event_log(messages: DataFrame, requests: DataFrame, query_stats: DataFrame, sql_text: DataFrame,
              plans: DataFrame, **parse_args) -> DataFrame:
    """O50 end to end in batch: parse, merge, enrich; the event table of the reference.

    ``incident_id`` comes from the first report's id (deterministic, unlike
    an identity counter, so a re-run gives the same ids).
    """
    rows = _stored(reports(parse_messages(messages, **parse_args)))
    opened = rows.join(_openings(rows), "__rid")
    # The lookups read the incidents' narrow columns; their wide rows move once, when all is known.
    looked = _looked_up(opened, "__rid", requests, query_stats, sql_text, plans, carried=("__w", "__n"))
    out = _stated(rows, looked, "__rid", sql_text, plans)
    out = out.withColumns({"wait_time": F.col("__w"), "incident_id": _incident_id()})
    return out.select(*_fleet(rows), *EVENT_LOG_COLUMNS)


INCIDENT_HEADERS = ("EventID", "Resource", "BlockingSPID", "BlockedProcessReport")


def new_incident_rows(inserted: DataFrame) -> DataFrame:
    """Report rows for newly inserted incidents only (HTML fragments, ordered by event date)."""
    return sinks.html_rows(inserted, ["incident_id", "resource", "blocking_spid", "blocked_process_report"],
                           ["event_date", "incident_id"])


# ---------------------------------------------------------------- streaming

CHANGE_SCHEMA = ("server_name string, incident_id string, change string, event_date timestamp_ntz, wait_time bigint, "
                 "closed_at timestamp_ntz")
STREAM_SCHEMA = CHANGE_SCHEMA + ", arrival_date date"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOCK_KEYS = 64
LATENESS_SECONDS = 600
RETAIN_SECONDS = 7 * 86400
# Fixed value: the option that sets how often a block is reported, in seconds.
INTERVAL_OPTION = "blocked process threshold%"


def report_interval(server_config: DataFrame) -> int:
    """The longest reporting interval in use on any server, in seconds (0: none is set)."""
    row = server_config.filter(F.col("name").like(INTERVAL_OPTION)).agg(F.max("value_in_use")).first()
    return int(row[0] or 0)


def merge_stream(reps: DataFrame, lateness_seconds: int = LATENESS_SECONDS, slack_ms: int = MERGE_SLACK_MS,
                 interval_seconds: int | None = None, retain_seconds: int = RETAIN_SECONDS) -> DataFrame:
    """O50, streaming form: change rows from the incident state (:mod:`dbtelemetry.streaming.incidents`).

    ``insert`` when an incident opens and ``update`` when a later batch
    changes its wait (or opens it again), both with the wait at the end of
    the batch; ``close`` once it has been untouched for the reporting
    interval plus slack (``interval_seconds``; the lateness where none is
    given). ``late`` rows are the side output: reports older than the
    watermark, which is the latest report time less the lateness.

    The state lives in RocksDB, an entry an incident; Spark requires that
    provider for map state and timers, so the session is switched to it.
    """
    from dbtelemetry.streaming.incidents import IncidentProcessor

    spark = reps.sparkSession
    if spark.conf.get(STATE_STORE, "") != ROCKSDB:
        spark.conf.set(STATE_STORE, ROCKSDB)
    k = _keyed(reps)
    server = (F.col("server_name") if "server_name" in k.columns else F.lit(None)).cast("string")
    alone = F.to_json(F.struct(F.col("report_id")))  # a NULL key has no state
    t = _micros("event_date")
    row = k.select(
        F.when(F.col("__null_key"), alone).otherwise(F.to_json(F.struct(*_merge_key(k)))).alias("merge_key"),
        server.alias("server_name"), "report_id", t.alias("t"), F.col("wait_time").alias("w"),
        F.col("arrival_ts").alias("arrived"), F.to_date("arrival_ts").alias("arrival_date"), F.col("__null_key").alias("alone"))
    # Each report and its clock: watermarks need a zone-aware TIMESTAMP, the instant with the
    # same epoch microseconds as the wall-clock report time.
    clock = F.struct(F.concat(F.lit("clock"), F.pmod(F.hash("report_id"), F.lit(CLOCK_KEYS)).cast("string")).alias("k"),
                     F.timestamp_micros("t").alias("wm"), F.lit(None).cast("string").alias("rid"))
    own = F.struct(F.col("merge_key").alias("k"), F.lit(None).cast("timestamp").alias("wm"), F.col("report_id").alias("rid"))
    both = row.withColumn("two", F.explode(F.array(own, clock)))
    fed = both.select(F.col("two.k").alias("merge_key"), F.col("two.wm").alias("clock"), F.col("two.rid").alias("report_id"),
                      "server_name", "t", "w", "arrived", "arrival_date", "alone")
    fed = fed.withWatermark("clock", f"{int(lateness_seconds)} seconds")
    idle = (lateness_seconds if interval_seconds is None else interval_seconds) * 1000 + slack_ms
    proc = IncidentProcessor(slack_ms * 1000, idle, max(idle, retain_seconds * 1000), lateness_seconds * 1000)
    return fed.groupBy("merge_key").transformWithStateInPandas(proc, STREAM_SCHEMA, "Append", "EventTime")


def current_incidents(change_log: DataFrame) -> DataFrame:
    """Current view of the append-only change log: the latest row per incident (by batch, then by kind of change)."""
    rank = F.when(F.col("change") == "insert", 0).when(F.col("change") == "update", 1).otherwise(2)
    batch = F.col("batch_id") if "batch_id" in change_log.columns else F.lit(0)
    order = F.struct(batch, rank, F.col("wait_time"))
    return change_log.filter("change <> 'late'").groupBy("incident_id").agg(
        F.min("event_date").alias("event_date"),
        F.max_by("wait_time", order).alias("wait_time"),
        (F.max_by("change", order) == "close").alias("closed"), F.first("server_name").alias("server_name"))


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    # Its own ``batch_id=`` partition with dynamic overwrite (a write option, not a session
    # setting): a replayed batch replaces its own rows.
    (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def write_changes(batch: DataFrame, batch_id: int, path: str, on_insert=None) -> None:
    """``foreachBatch`` sink: append a micro-batch to the change log, idempotently.

    ``on_insert`` gets the inserted incidents (O51).
    """
    _write_batch(batch, batch_id, path)
    if on_insert is not None:
        on_insert(batch.filter(F.col("change") == "insert"), batch_id)


def late_reports(batch: DataFrame) -> DataFrame:
    """The side output of a batch: reports that came too late, with reason and delay."""
    return batch.filter("change = 'late'").select(
        "server_name", F.col("incident_id").alias("report_id"), "event_date", "wait_time",
        F.lit("older than the high-water mark less the lateness, or than the incidents kept").alias("reason"),
        F.timestamp_diff("MILLISECOND", F.col("event_date"), F.col("closed_at")).alias("delay_ms"))


def captured(messages: DataFrame, **parse_args) -> DataFrame:
    """O49 and the input of O50 in one parse: every message as one row.

    ``kind`` is ``report``, ``event`` (any other notification) or ``error``
    (unparseable); the row holds the whole message, its audit time, the
    event columns and, for reports, the typed report columns.
    """
    parsed = parse_messages(messages, **parse_args)
    report = (F.col("message_type_name").endswith(NOTIFICATION_TYPE_SUFFIX) & F.col("parse_ok")
              & (F.col("x.EventType") == BLOCKED_PROCESS_REPORT))
    kind = F.when(~F.col("parse_ok"), "error").when(report, "report").otherwise("event")
    server = [] if "server_name" in parsed.columns else [F.lit(None).cast("string").alias("server_name")]
    return parsed.select("*", *server).select(
        *[c for c in _report_columns(["server_name"])], "message_type_name",
        F.col("x.EventType").alias("event_type"), _ts(F.col("x.PostTime")).alias("alert_time"),
        F.col("message_body").alias("blocking_event_data"), F.coalesce(kind, F.lit("event")).alias("kind"),
        F.to_date("arrival_ts").alias("arrival_date"))


def captured_events(capture: DataFrame, databases: DataFrame | None = None) -> DataFrame:
    """O49 from the capture table of the streaming job: the columns of :func:`capture_events`."""
    out = capture.filter("kind <> 'error'").select(
        "event_type", "alert_time", "event_date", "database_id", "blocked_process_report", "blocking_event_data",
        F.col("arrival_ts").alias("audit_date"))
    return out if databases is None else db_name(out, databases, "database_id", out="database_name")


def current_event_log(events: DataFrame, change_log: DataFrame) -> DataFrame:
    """The event table as it is now: the rows of inserted incidents with their latest wait."""
    now = current_incidents(change_log).select("incident_id", F.col("wait_time").alias("__wait"))
    out = events.join(now, "incident_id").withColumn("wait_time", F.col("__wait"))
    return out.select("server_name", *EVENT_LOG_COLUMNS)


def _make_folder(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def start_blocking_job(spark, source: str, out_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                       trigger: dict | None = None, lateness_seconds: int = LATENESS_SECONDS,
                       source_options: dict | None = None, interval_seconds: int | None = None,
                       retain_seconds: int = RETAIN_SECONDS, lookups: dict[str, DataFrame] | None = None):
    """Start the blocked-process job: two queries, each message parsed once.

    The first reads the queue and appends every message, parsed, to the
    table ``capture`` (partitioned by kind and day of arrival) with Spark's
    own exactly-once file sink. The second reads the narrow report columns
    of that table as a stream, merges them in the incident state and
    writes, each under its batch id:

    * ``changes``: the change log;
    * ``events``: the event table's rows of new incidents, all columns; text
      and plans are looked up if ``lookups`` names the relations
      ``requests``, ``query_stats``, ``sql_text`` and ``plans``;
    * ``alerts``: HTML rows of new incidents with resource, blocker and
      report (O51);
    * ``errors`` of the first kind stay in ``capture``; reports that came
      too late are in ``late``.

    A batch that is replayed replaces its own rows in all of them.
    ``trigger`` defaults to every 10 seconds (the reference's queue wait);
    with ``{"availableNow": True}`` the second query starts when the first
    has ended. Returns both queries.
    """
    capture = f"{out_dir}/capture"
    rows = captured(message_source(spark, source, fmt, options=source_options))
    trig = trigger or {"processingTime": "10 seconds"}
    _make_folder(spark, capture)
    q1 = (rows.writeStream.trigger(**trig).option("checkpointLocation", f"{checkpoint_dir}/capture")
          .partitionBy("kind", "arrival_date").format("parquet").option("path", capture).start())
    if "availableNow" in trig:
        q1.awaitTermination()
    stream = spark.readStream.schema(rows.schema).parquet(capture).filter("kind = 'report'")
    changes = merge_stream(stream, lateness_seconds, interval_seconds=interval_seconds, retain_seconds=retain_seconds)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # one pass of the incident state feeds all tables
        try:
            write_changes(batch.filter("change <> 'late'").drop("arrival_date"), batch_id, f"{out_dir}/changes")
            _write_batch(late_reports(batch), batch_id, f"{out_dir}/late")
            new = batch.filter("change = 'insert'").select("incident_id", F.col("wait_time").alias("__w"), "arrival_date")
            first, last = new.agg(F.min("arrival_date"), F.max("arrival_date")).first()
            if first is None:
                return
            # Only the days on which the batch's new incidents arrived are read.
            days = (spark.read.schema(rows.schema).parquet(capture)
                    .filter((F.col("kind") == "report") & F.col("arrival_date").between(F.lit(first), F.lit(last))))
            full = days.withColumnRenamed("report_id", "incident_id").join(new.drop("arrival_date"), "incident_id")
            full = full.withColumn("wait_time", F.col("__w")).persist()
            try:
                alerts = sinks.html_rows(full, ["incident_id", "resource", "blocking_spid", "blocked_process_report"],
                                         ["event_date", "incident_id"])
                _write_batch(alerts, batch_id, f"{out_dir}/alerts")
                if lookups is None:
                    seen = full.withColumns({c: F.lit(None).cast("string") for c in
                                             ("blocked_sql", "blocking_sql", "blocked_query_plan", "blocking_query_plan")})
                else:
                    seen = enrich(full, **lookups)
                _write_batch(seen.select("server_name", *EVENT_LOG_COLUMNS), batch_id, f"{out_dir}/events")
            finally:
                full.unpersist()
        finally:
            batch.unpersist()

    q2 = (changes.writeStream.trigger(**trig).option("checkpointLocation", f"{checkpoint_dir}/changes")
          .foreachBatch(sink).start())
    return q2, q1
