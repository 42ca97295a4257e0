"""Resource consumers: top statements by a measure, log-heavy transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.operators.common import Keys, db_name, lookup_text, on, with_absent

# The measures the reference ranks statements by, and its k.
MEASURES = ("execution_count", "total_elapsed_time", "total_worker_time", "total_logical_reads",
            "total_logical_writes", "plan_generation_num")
DEFAULT_K = 10


def top_k_per_group(df: DataFrame, keys: Keys, order: Sequence[Column], k: int,
                    salt_cols: Sequence[str] = (), salt_buckets: int = 64) -> DataFrame:
    """Exact top-k, globally or per fleet key.

    Without keys: ``orderBy().limit()`` becomes TakeOrderedAndProject (a
    bounded heap per partition, then a k-row merge) with no shuffle of the
    input. With keys, a server holding a large share of the rows would put
    all of them in one window task, so the rank runs in two rounds: first
    per (keys, hash bucket of ``salt_cols``), keeping k rows each, then per
    keys over at most ``k * salt_buckets`` rows.
    """
    if not keys:
        return df.orderBy(*order).limit(k)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salt_buckets)) if salt_cols else F.lit(0)
    w1 = Window.partitionBy(*keys, "__salt").orderBy(*order)
    stage1 = (df.withColumn("__salt", salt).withColumn("__r", F.row_number().over(w1))
              .filter(F.col("__r") <= k).drop("__r"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return stage1.withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= k).drop("__r", "__salt")


def top_queries(query_stats: DataFrame, sql_text: DataFrame, databases: DataFrame, measure: str,
                k: int = DEFAULT_K, with_handle: bool | None = None, keys: Keys = ()) -> DataFrame:
    """The k statements with the largest ``measure``, with their text.

    The reference ranks after ``CROSS APPLY`` to the text, so rows without
    text cannot rank. We keep that exactly but join the wide text late:
    semi-join the statistics to the handles that have text (narrow), rank,
    then attach text to the k survivors only. Ties on the measure are broken
    by handle and statement offsets so the result is deterministic.
    ``with_handle`` adds ``sql_handle`` (the reference's CPU variant).
    """
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}")
    if with_handle is None:
        with_handle = measure == "total_worker_time"
    qs = query_stats.select(*keys, "sql_handle", "plan_handle", "statement_start_offset",
                            "statement_end_offset", measure)
    has_text = sql_text.select(*keys, "sql_handle")
    qs = qs.join(has_text, on(["sql_handle"], keys), "left_semi")
    order = [F.col(measure).desc(), F.col("sql_handle"), F.col("plan_handle"),
             F.col("statement_start_offset"), F.col("statement_end_offset")]
    top = top_k_per_group(qs, keys, order, k, salt_cols=["sql_handle", "plan_handle"])
    out = lookup_text(top, sql_text, how="inner", keys=keys, cols=("dbid", "text"))
    out = db_name(out, databases, "dbid", out="db_name", keys=keys)
    cols = (["sql_handle"] if with_handle else []) + [measure, "dbid", "db_name", "text"]
    return out.select(*keys, *cols)


def log_consumers(database_transactions: DataFrame, session_transactions: DataFrame, requests: DataFrame,
                  sql_text: DataFrame, databases: DataFrame, k: int = DEFAULT_K, state: int | None = None,
                  keys: Keys = ()) -> DataFrame:
    """Transactions with the most log records, with the text of the session's requests.

    Transactions join their session, the session's requests and (CROSS
    APPLY) the request text, so a session with several requests repeats the
    transaction. Ranking happens on the transactions first (only those with
    at least one request with text), then on the k transactions' fan-out,
    and the wide text is attached to the k survivors. ``state`` is the
    optional filter the reference leaves commented out.
    """
    t1 = with_absent(database_transactions, "bigint", "state", "log_bytes_used_system", "log_bytes_reserved_system")
    t1 = t1.select(*keys, "transaction_id", "database_id", "begin_time",
                                      "state", "log_bytes_used_system", "log_bytes_reserved",
                                      "log_bytes_reserved_system", "log_record_count")
    if state is not None:
        t1 = t1.filter(F.col("state") == state)
    t2 = session_transactions.select(*keys, "transaction_id", "session_id")
    t3 = requests.select(*keys, "session_id", "request_id", "sql_handle")
    t3 = t3.join(sql_text.select(*keys, "sql_handle"), on(["sql_handle"], keys), "left_semi")
    # The order starts with the transaction row's own columns and every
    # surviving transaction row yields at least one output row, so the k
    # output rows come from the k first transaction rows: rank those, then
    # fan out to the session's requests (instead of fanning out all rows).
    with_req = t2.join(t3.select(*keys, "session_id"), on(["session_id"], keys), "left_semi")
    live = t1.join(with_req.select(*keys, "transaction_id"), on(["transaction_id"], keys), "left_semi")
    tx_order = [F.col("log_record_count").desc(), F.col("transaction_id"), F.col("database_id"),
                F.col("begin_time"), F.col("log_bytes_reserved"), F.col("state"), F.col("log_bytes_used_system"),
                F.col("log_bytes_reserved_system")]
    top_tx = top_k_per_group(live, keys, tx_order, k, salt_cols=["transaction_id"])
    j = top_tx.join(t2, on(["transaction_id"], keys)).join(t3, on(["session_id"], keys))
    order = tx_order + [F.col("session_id"), F.col("request_id")]
    top = top_k_per_group(j, keys, order, k, salt_cols=["transaction_id", "request_id"])
    out = lookup_text(top, sql_text, how="inner", keys=keys, cols=("text",))
    out = db_name(out, databases, "database_id", out="db_name", keys=keys)
    return out.select(*keys, "database_id", "db_name", "text", "begin_time", "state", "log_bytes_used_system",
                      "log_bytes_reserved", "log_bytes_reserved_system", "log_record_count", "session_id", "request_id")
