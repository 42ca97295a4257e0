"""TempDB contention, space and row versioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators.common import Keys, lookup_plan, lookup_text, on, with_absent
from dbtelemetry.operators.ordering import in_order_with

# Allocation-page rules and labels of the contention report.
PFS_INTERVAL = 8088
GAM_INTERVAL = 511232
PFS_LABEL = "Is PFS Page"
GAM_LABEL = "Is GAM Page"
SGAM_LABEL = "Is SGAM Page"
OTHER_LABEL = "Is Not PFS, GAM, or SGAM page"


def _user_sessions(sessions: DataFrame, keys: Keys) -> DataFrame:
    return sessions.filter(F.col("is_user_process") == 1).select(*keys, "session_id")


def user_waits(waits: DataFrame, sessions: DataFrame, keys: Keys = ()) -> DataFrame:
    """Waiting tasks of user sessions."""
    w = waits.select(*keys, "session_id", "wait_duration_ms", "wait_type", "resource_description")
    return w.join(_user_sessions(sessions, keys), on(["session_id"], keys))


def contention_counts(waits: DataFrame, sessions: DataFrame, resource: str = "2:1:1",
                      keys: Keys = ()) -> DataFrame:
    """Count of user waits on one page resource (no row when there are none)."""
    w = waits.filter(F.col("resource_description") == resource).select(*keys, "session_id",
                                                                       "resource_description")
    j = w.join(_user_sessions(sessions, keys), on(["session_id"], keys))
    return j.groupBy(*keys, "resource_description").agg(F.count(F.lit(1)).alias("rowcount"))


def page_id(resource) -> "F.Column":
    """Page number after the second ``:`` of ``db:file:page`` (search from character 3).

    ``try_cast`` gives NULL for text that is not a number, where the
    server would raise an error.
    """
    r = F.col(resource) if isinstance(resource, str) else resource
    tail = F.right(r, tsql.tsql_len(r) - tsql.charindex(":", r, 3))
    return tail.try_cast("int")


def allocation_page_type(waits: DataFrame) -> DataFrame:
    """Page-latch waits in database 2 classified as PFS, GAM, SGAM or other.

    Tested in that order: PFS is page 1 or a multiple of 8088, GAM page 2
    or a multiple of 511232, SGAM page 3 or one past a multiple of 511232.
    ``_`` in the wait-type pattern is a wildcard, as in the reference.
    """
    extra = [c for c in ("server_name", "captured_at") if c in waits.columns]
    w = waits.filter(tsql.like("wait_type", "PAGE%LATCH_%") & tsql.like("resource_description", "2:%"))
    w = w.select(*extra, "session_id", "wait_type", "wait_duration_ms", "blocking_session_id",
                 "resource_description", page_id("resource_description").alias("__page"))
    p = F.col("__page")
    kind = (F.when((p == 1) | (p % PFS_INTERVAL == 0), F.lit(PFS_LABEL))
            .when((p == 2) | (p % GAM_INTERVAL == 0), F.lit(GAM_LABEL))
            .when((p == 3) | ((p - 1) % GAM_INTERVAL == 0), F.lit(SGAM_LABEL))
            .otherwise(F.lit(OTHER_LABEL)))
    return w.select(*extra, "session_id", "wait_type", "wait_duration_ms", "blocking_session_id",
                    "resource_description", kind.alias("resource_type"))


def _task_totals(task_space: DataFrame, keys: Keys, exclude_session: int | None = None) -> DataFrame:
    t = task_space
    if exclude_session is not None:
        t = t.filter(F.col("session_id") != exclude_session)
    return t.groupBy(*keys, "session_id", "request_id").agg(
        F.sum("alloc_pages").cast("bigint").alias("alloc_pages"),
        F.sum("dealloc_pages").cast("bigint").alias("dealloc_pages"))


HEAD = 32


def tempdb_sessions(task_space: DataFrame, requests: DataFrame, sql_text: DataFrame, plans: DataFrame,
                    exclude_session: int | None = None, keys: Keys = ()) -> DataFrame:
    """O48d: internal-object space per request, with text, current statement and plan.

    Page counts are summed per (session, request) before the join. The
    statement cut starts at ``offset / 2`` (one character earlier than the
    usual +1 form, and T-SQL's position-0 rule shortens it by one more);
    an end offset before the start (such as -1) gives an empty cut, and an
    empty cut falls back to the whole text. Rows with neither text nor plan
    are dropped. ``exclude_session`` is the caller's own session.
    """
    tsu = _task_totals(task_space, keys, exclude_session)
    r = requests.select(*keys, "session_id", "request_id", "sql_handle", "plan_handle",
                        "statement_start_offset", "statement_end_offset")
    so, eo = F.col("statement_start_offset"), F.col("statement_end_offset")
    length = F.when(eo < so, F.lit(0)).otherwise(tsql.int_div(eo - so, 2))
    cut = tsql.utf16_substring("text", tsql.int_div(so, 2), length)
    stmt = F.coalesce(tsql.nullif_blank(cut), F.col("text"))
    narrow = tsu.join(r, on(["session_id", "request_id"], keys)).withColumn(
        "internal_object_dealloc_mb", F.col("dealloc_pages") / F.lit(128.0))
    # Rows of equal size are placed by the head of their statement, so they need not share a partition.
    head = lookup_text(narrow, sql_text, keys=keys).select(*narrow.columns, F.substring(stmt, 1, HEAD).alias("__head"))
    order = [*keys, F.col("internal_object_dealloc_mb").desc(), F.col("__head").desc()]

    def stated(wide: DataFrame) -> DataFrame:
        wide = wide.filter(F.col("text").isNotNull() | F.col("query_plan").isNotNull())
        return wide.withColumn("statement_text", stmt)

    finds = {"sql_handle": lambda need: lookup_text(need, sql_text, how="inner", keys=keys),
             "plan_handle": lambda need: lookup_plan(need, plans, how="inner", keys=keys)}
    out = in_order_with(head, order, finds, keys, then=stated, within=[F.col("statement_text").desc()])
    return out.select(*keys, "session_id", (F.col("alloc_pages") / F.lit(128.0)).alias("internal_object_mb"),
                      "internal_object_dealloc_mb", "text", "statement_text", "query_plan")


def tempdb_requests(task_space: DataFrame, requests: DataFrame, keys: Keys = ()) -> DataFrame:
    """O48e: requests with internal-object allocations (sum > 0), with handles and offsets."""
    t1 = _task_totals(task_space, keys).withColumnRenamed("alloc_pages", "task_alloc") \
        .withColumnRenamed("dealloc_pages", "task_dealloc")
    t1 = t1.filter(F.col("task_alloc") + F.col("task_dealloc") > 0)
    t2 = requests.select(*keys, "session_id", "request_id", "sql_handle", "statement_start_offset",
                         "statement_end_offset", "plan_handle")
    return t1.join(t2, on(["session_id", "request_id"], keys)).select(
        *keys, "session_id", "request_id", "task_alloc", "task_dealloc", "sql_handle", "statement_start_offset",
        "statement_end_offset", "plan_handle").orderBy(*keys, F.col("task_alloc").desc())


def tempdb_space(file_space: DataFrame, keys: Keys = ()) -> DataFrame:
    """O48f: reserved KB by user objects, internal objects and the version store (one row)."""
    return file_space.groupBy(*keys).agg(
        (F.sum("user_object_reserved_page_count") * 8).cast("bigint").alias("user_object_reserved_kb"),
        (F.sum("internal_object_reserved_page_count") * 8).cast("bigint").alias("internal_object_reserved_kb"),
        (F.sum("version_store_reserved_page_count") * 8).cast("bigint").alias("version_store_kb"))


SNAPSHOT_COLUMNS = ("transaction_id", "transaction_sequence_num", "commit_sequence_num", "session_id",
                    "is_snapshot", "first_snapshot_sequence_num", "max_version_chain_traversed",
                    "average_version_chain_traversed", "elapsed_time_seconds")


def long_snapshot_transactions(df: DataFrame) -> DataFrame:
    """O48g: active snapshot transactions, longest running first."""
    extra = [c for c in ("server_name", "captured_at") if c in df.columns]
    df = with_absent(with_absent(df, "double", "average_version_chain_traversed"), "bigint", *SNAPSHOT_COLUMNS)
    return df.select(*extra, *SNAPSHOT_COLUMNS).orderBy(F.col("elapsed_time_seconds").desc())


SNAPSHOT_SETTINGS = ("name", "database_id", "snapshot_isolation_state", "snapshot_isolation_state_desc",
                     "is_read_committed_snapshot_on")


def snapshot_settings(databases: DataFrame) -> DataFrame:
    """O48h: row-versioning settings per database."""
    extra = [c for c in ("server_name", "captured_at") if c in databases.columns]
    databases = with_absent(with_absent(databases, "string", "snapshot_isolation_state_desc"), "int", *SNAPSHOT_SETTINGS)
    return databases.select(*extra, *SNAPSHOT_SETTINGS)


def session_query(sessions: DataFrame, requests: DataFrame, sql_text: DataFrame, plans: DataFrame,
                  session_id: int | None = None, keys: Keys = ()) -> DataFrame:
    """O48i: text and plan of a session's requests; idle sessions are kept (left joins)."""
    s = sessions.select(*keys, "session_id")
    if session_id is not None:
        s = s.filter(F.col("session_id") == session_id)
    r = requests.select(*keys, "session_id", "sql_handle", "plan_handle")
    j = s.join(r, on(["session_id"], keys), "left")
    j = lookup_plan(lookup_text(j, sql_text, keys=keys), plans, keys=keys)
    return j.select(*keys, "session_id", "text", "query_plan")
