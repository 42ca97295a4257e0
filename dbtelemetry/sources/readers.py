"""Sources: snapshot scans, trace exports, command output and database fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.sources.queue import stream_queue
from dbtelemetry.sources.sinks import CAPTURE_INDEX


def scan(spark: SparkSession, path: str, as_of: str | None = None, columns: Sequence[str] | None = None,
         servers: Sequence[str] | None = None) -> DataFrame:
    """Read a snapshot relation as it was at ``as_of``: each server's latest capture at or before it.

    Tables are Parquet partitioned by ``captured_date``. Where the table has
    a capture index (:func:`~dbtelemetry.sources.sinks.append_captures`),
    the days that hold each server's latest capture come from it and are
    the scan's partition filter: a moment's scan lists one or two days of
    any history. Without an index, the server and capture columns of all
    partitions up to that day are read. The column list reaches the scan as
    its read schema.
    """
    df = spark.read.parquet(path)
    if as_of is not None and "captured_at" in df.columns:
        ts = tsql.as_ts(as_of)
        by = [c for c in ("server_name",) if c in df.columns]
        days = captured_days(spark, path, ts, servers)
        if days is not None:  # none is after the moment
            df = df.filter(F.col("captured_date").isin(days))
        elif "captured_date" in df.columns:
            df = df.filter(F.col("captured_date") <= F.to_date(ts))
        df = df.filter(F.col("captured_at") <= ts)
        day = [c for c in ("captured_date",) if c in df.columns]
        last = df.groupBy(*by).agg(F.max(F.struct("captured_at", *day)).alias("last"))
        last = last.select(*[F.col(c).alias(f"__{c}") for c in by],
                           *[F.col(f"last.{c}").alias(f"__{c}") for c in ("captured_at", *day)])
        cond = [df[c].eqNullSafe(last[f"__{c}"]) if c in by else df[c] == last[f"__{c}"]
                for c in (*by, *day, "captured_at")]
        df = df.join(last, cond, "left_semi")
    if servers is not None and "server_name" in df.columns:
        df = df.filter(F.col("server_name").isin(*servers))
    if columns is not None:
        df = df.select(*columns)
    return df


def captured_days(spark: SparkSession, path: str, moment, servers: Sequence[str] | None = None) -> list | None:
    """The days that hold the servers' latest captures before a moment, from the capture index; None without an index."""
    try:
        index = spark.read.parquet(f"{path.rstrip('/')}/{CAPTURE_INDEX}")
    except AnalysisException:
        return None
    index = index.filter((F.col("captured_date") <= F.to_date(moment)) & (F.col("first_capture") <= moment))
    by = [c for c in ("server_name",) if c in index.columns]
    if servers is not None and by:
        index = index.filter(F.col("server_name").isin(*servers))
    last = index.groupBy(*by).agg(F.max("captured_date").alias("day")).filter(F.col("day").isNotNull())
    # At most one row for each day of the table.
    return sorted(r["day"] for r in last.select("day").distinct().collect())


def trace_rollover_glob(current_trace_path: str, exported_suffix: str = "") -> str:
    """All rollover files of the default trace, from the path of its current file.

    The folder of the current file, then ``log*.trc`` (the rollover files
    are ``log_<n>.trc``), plus the suffix of the exported copies. Folder
    separators may be ``\\`` (the server's) or ``/``.
    """
    cut = max(current_trace_path.rfind("\\"), current_trace_path.rfind("/"))
    folder = current_trace_path[:cut] if cut >= 0 else "."
    return folder.replace("\\", "/") + "/log*.trc" + exported_suffix


def trace_source(spark: SparkSession, path_glob: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """S3: all rollover files of an exported trace (a glob, see :func:`trace_rollover_glob`), as one relation."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(path_glob)


def text_source(spark: SparkSession, path: str, server_from_path: bool = True, server_in_line: bool = False) -> DataFrame:
    """Captured command output as rows of text (``INSERT ... EXEC`` of a shell command).

    One row per line in column ``output``; the server name is taken from
    the parent folder when the captures are laid out one folder per server.
    With ``server_in_line`` the files hold many servers, as
    :func:`~dbtelemetry.sources.sinks.write_output` writes them: the name,
    URL-encoded, and a tab begin each line (NULL for a line without a tab).
    """
    df = spark.read.text(path).withColumnRenamed("value", "output")
    if server_in_line:
        tab, line = F.instr("output", "\t"), F.col("output")
        return df.select(F.when(tab == 0, line).otherwise(line.substr(tab + 1, F.length(line))).alias("output"),
                         F.when(tab > 0, F.url_decode(line.substr(F.lit(1), tab - 1))).alias("server_name"))
    if server_from_path:
        df = df.withColumn("server_name", F.element_at(F.split(F.input_file_name(), "/"), -2))
    return df


def across_databases(df: DataFrame, exclude: Sequence[str] = (), include: Sequence[str] | None = None,
                     like: str | None = None, column: str = "database_name") -> DataFrame:
    """The per-database loop of the reference as one filter on a database column.

    ``NOT IN`` semantics: a NULL database name is excluded when ``exclude``
    is given.
    """
    c = F.col(column)
    if exclude:
        df = df.filter(~tsql.one_of(c, exclude))
    if include is not None:
        df = df.filter(tsql.one_of(c, include))
    if like is not None:
        df = df.filter(tsql.like(c, like))
    return df


def across_tables(df: DataFrame, table_col: str = "table_name", measures: Sequence[str] = ()) -> DataFrame:
    """The per-table loop as one aggregation per table."""
    return df.groupBy(table_col).agg(*[F.sum(m).alias(m) for m in measures])


def over_all_cores(df: DataFrame) -> DataFrame:
    """``df`` with at least one partition a core, for costly work on each row.

    A small file is one partition, and its rows would be parsed by one core.
    Inputs of enough partitions stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def message_source(spark: SparkSession, path_or_topic: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """The blocked-process queue as a streaming DataFrame, with a unique ``message_id`` that follows the queue's order.

    Files (parquet or json) exported by the queue reader
    (:mod:`dbtelemetry.sources.queue`), or a Kafka topic when the Kafka
    connector is on the classpath (value = message body, timestamp =
    arrival; the headers ``message_type_name`` and ``server_name`` give the
    rest, a message without a type header is a notification). Files without
    ``server_name`` give NULL there.
    """
    if fmt != "kafka":
        return stream_queue(spark, path_or_topic, fmt)
    reader = spark.readStream.format("kafka").option("includeHeaders", "true").option("subscribe", path_or_topic)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return kafka_messages(reader.load())


def kafka_messages(records: DataFrame) -> DataFrame:
    """The messages in Kafka records; their id is topic, partition and offset."""

    def header(name):
        return F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string")

    place = F.concat_ws("#", F.col("topic"), F.lpad(F.col("partition").cast("string"), 6, "0"),
                        F.lpad(F.col("offset").cast("string"), 20, "0"))
    return records.select(place.alias("message_id"), header("server_name").alias("server_name"),
                          F.coalesce(header("message_type_name"), F.lit("EventNotification")).alias("message_type_name"),
                          F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),
                          F.col("value").cast("string").alias("message_body"))
