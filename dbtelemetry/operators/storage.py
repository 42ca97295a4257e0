"""Files, volumes, CPU and host reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators.common import Keys, db_name, on, with_absent

# Text pieces of the free-space report's autogrowth column.
AUTOGROW_PREFIX = "By "
AUTOGROW_MB = " MB -"
AUTOGROW_PCT = "% -"
AUTOGROW_DISABLED = "DISABLED"
AUTOGROW_UNRESTRICTED = " Unrestricted"
AUTOGROW_RESTRICTED = " Restricted to "
AUTOGROW_GB = " GB"
AUTOGROW_PCT_WARNING = " [autogrowth by percent, BAD setting!]"
SYSTEM_DATABASES = ("master", "msdb", "model")
DEFAULT_LOW_SPACE_MB = 1024


def _ratio_2dp(num: Column, den: Column) -> Column:
    """``CONVERT(DECIMAL(10,2), num / den)`` computed exactly: the ratio of two
    integers rounded half away from zero to hundredths, without a floating
    point step."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    hundredths = F.signum(n) * F.signum(d) * tsql.int_div(F.abs(n) * 200 + F.abs(d), F.abs(d) * 2)
    return (hundredths.cast("decimal(20,0)") / F.lit(100)).cast("decimal(10,2)")


def pages_to_mb(pages) -> Column:
    """8 KB pages to MB as ``DECIMAL(10,2)`` (``pages / 128.0``)."""
    return _ratio_2dp(F.col(pages) if isinstance(pages, str) else pages, F.lit(128))


def file_free_space(files: DataFrame, filegroups: DataFrame, keys: Keys = ()) -> DataFrame:
    """Size, used and free space per database file, with the autogrowth setting as text.

    Log files have no filegroup, hence the left join. ``growth / 128`` is an
    integer division; the MB figures are decimals.
    """
    fg = filegroups.select(*keys, "data_space_id", F.col("name").alias("filegroup_name"))
    j = files.join(fg, on(["data_space_id"], keys), "left")
    size, used = F.col("size"), F.col("used_pages")
    growth_txt = (F.when(F.col("is_percent_growth") == 0,
                         F.concat(tsql.int_div("growth", 128).cast("string"), F.lit(AUTOGROW_MB)))
                  .when(F.col("is_percent_growth") == 1, F.concat(F.col("growth").cast("string"), F.lit(AUTOGROW_PCT)))
                  .otherwise(F.lit("")))
    max_txt = (F.when(F.col("max_size") == 0, F.lit(AUTOGROW_DISABLED))
               .when(F.col("max_size") == -1, F.lit(AUTOGROW_UNRESTRICTED))
               .otherwise(F.concat(F.lit(AUTOGROW_RESTRICTED),
                                   tsql.int_div("max_size", 128 * 1024).cast("string"), F.lit(AUTOGROW_GB))))
    warn = F.when(F.col("is_percent_growth") == 1, F.lit(AUTOGROW_PCT_WARNING)).otherwise(F.lit(""))
    return j.select(
        *keys,
        F.col("type_desc").alias("type"),
        F.col("name").alias("file_name"),
        "filegroup_name",
        F.col("physical_name").alias("file_location"),
        pages_to_mb(size).alias("filesize_mb"),
        pages_to_mb(size - (size - used)).alias("usedspace_mb"),
        pages_to_mb(size - used).alias("freespace_mb"),
        _ratio_2dp((size - used) * 100, size).alias("freespace_pct"),
        F.concat(F.lit(AUTOGROW_PREFIX), growth_txt, max_txt, warn).alias("autogrow"),
    )


def file_sizes(files: DataFrame, databases: DataFrame, exclude: Sequence[str] = SYSTEM_DATABASES,
               keys: Keys = ()) -> DataFrame:
    """File sizes in MB (``size * 8 / 1024``, integer division) for every database not excluded.

    The reference loops over databases; here it is one scan with a filter
    on the database name (a NULL name is excluded, as ``NOT IN`` is unknown).
    """
    j = db_name(files, databases, "database_id", keys=keys)
    j = j.filter(~F.col("database_name").isin(*exclude))
    return j.select(*keys, "database_name", "name", tsql.int_div(F.col("size") * 8, 1024).alias("size_mb"))


def _volumes(files: DataFrame, volumes: DataFrame, keys: Keys) -> DataFrame:
    v = volumes.select(*keys, "database_id", "file_id", "logical_volume_name", "volume_mount_point",
                       "available_bytes")
    return files.join(v, on(["database_id", "file_id"], keys))


def file_locations(files: DataFrame, volumes: DataFrame, databases: DataFrame, keys: Keys = ()) -> DataFrame:
    """Distinct (database, file location, volume, free MB); MB truncated to an integer."""
    j = db_name(_volumes(files, volumes, keys), databases, "database_id", out="db_name", keys=keys)
    return j.select(*keys, "db_name", F.col("physical_name").alias("physical_file_location"),
                    F.col("logical_volume_name").alias("logical_name"), F.col("volume_mount_point").alias("drive"),
                    tsql.int_div("available_bytes", 1048576).cast("int").alias("free_space_mb")).distinct().orderBy(*keys, "free_space_mb")


def low_disk_space(files: DataFrame, volumes: DataFrame, threshold_mb: int = DEFAULT_LOW_SPACE_MB,
                   keys: Keys = ()) -> DataFrame:
    """Volumes holding database files with at most ``threshold_mb`` free (distinct volumes)."""
    j = _volumes(files, volumes, keys).select(
        *keys, F.col("logical_volume_name").alias("logical_name"), F.col("volume_mount_point").alias("drive"),
        tsql.int_div("available_bytes", 1048576).cast("int").alias("free_space_mb")).distinct()
    return j.filter(F.col("free_space_mb") <= threshold_mb)


def low_disk_space_alert(files: DataFrame, volumes: DataFrame, threshold_mb: int = DEFAULT_LOW_SPACE_MB,
                         keys: Keys = ()) -> DataFrame:
    """O35 gate: whether the low-space mail goes out (at least one volume at or under the threshold).

    One row (per fleet key when given): the number of low volumes and the
    send flag. The reference tests existence in one form and a count in
    the other; both only mean "not empty".
    """
    low = low_disk_space(files, volumes, threshold_mb, keys)
    return low.groupBy(*keys).agg(F.count(F.lit(1)).alias("low_volumes")).select(
        *keys, "low_volumes", (F.col("low_volumes") > 0).alias("send_alert"))


def locked_page_memory(process_memory: DataFrame, keys: Keys = ()) -> DataFrame:
    """Locked-page allocations per server; zero means locked pages are not in use."""
    extra = ["server_name"] if "server_name" in process_memory.columns and "server_name" not in keys else []
    return process_memory.select(*keys, *extra, "locked_page_allocations_kb",
                                 (F.col("locked_page_allocations_kb") != 0).alias("locked_pages_enabled"))


def scheduler_load(schedulers: DataFrame) -> DataFrame:
    """Visible schedulers only (``scheduler_id < 255``); hidden ones serve the server itself."""
    wanted = ["scheduler_id", "cpu_id", "current_tasks_count", "runnable_tasks_count", "current_workers_count",
              "active_workers_count", "work_queue_count", "pending_disk_io_count"]
    extra = [c for c in ("server_name", "captured_at") if c in schedulers.columns]
    schedulers = with_absent(schedulers, "bigint", *wanted)
    return schedulers.filter(F.col("scheduler_id") < 255).select(
        *extra, *wanted)


def cpu_from_text(lines: DataFrame, text_col: str = "output") -> DataFrame:
    """CPU load parsed from captured command output, one row per ``Load...`` line.

    Lines not starting with "Load" (any case) and NULL lines are dropped;
    the value is the text after ``" :"`` plus ``" %"``.
    """
    out = F.col(text_col)
    start = tsql.charindex(" :", out) + 2
    value = F.concat(out.substr(start, tsql.tsql_len(out)), F.lit(" %"))
    extra = [c for c in ("server_name", "captured_at") if c in lines.columns]
    return lines.filter(out.isNotNull() & tsql.like(out, "Load%")).select(
        *extra, F.lit("CPU Utilization").alias("label"), value.alias("utilization"))


def os_info(info: DataFrame) -> DataFrame:
    """Logical CPUs, hyperthread ratio and physical CPUs (integer division)."""
    extra = [c for c in ("server_name", "captured_at") if c in info.columns]
    info = with_absent(info, "timestamp_ntz", "sqlserver_start_time")
    return info.select(*extra, F.col("cpu_count").alias("logical_cpu_count"), "hyperthread_ratio",
                       tsql.int_div("cpu_count", "hyperthread_ratio").alias("physical_cpu_count"), "sqlserver_start_time")


def average_cpu(cpu_load: DataFrame, keys: Keys = ("server_name",)) -> DataFrame:
    """Average load percentage per server (partial aggregation, so a busy server stays cheap)."""
    return cpu_load.groupBy(*keys).agg(F.avg("load_percentage").alias("average"))


def cpu_by_processor(cpu_load: DataFrame) -> DataFrame:
    """Load per processor sample, as captured."""
    cols = [c for c in ("server_name", "ts", "cpu_id", "load_percentage") if c in cpu_load.columns]
    return cpu_load.select(*cols)


def event_log_search(event_log: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    """Event-log entries whose message matches a ``LIKE`` pattern as given."""
    return event_log.filter(tsql.like("message", pattern, case_sensitive))


def stale_output_files(files: DataFrame, prefix: str, suffix: str, as_of, days: int = 8,
                       path_col: str = "path", time_col: str = "modification_time") -> DataFrame:
    """Files named ``prefix*suffix`` last written at least ``days`` days before ``as_of``.

    Lists only; deleting is left to the caller.
    """
    cutoff = tsql.as_ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    p = F.col(path_col)
    return files.filter(p.startswith(prefix) & p.endswith(suffix) & (F.col(time_col) <= cutoff)).select(
        path_col, time_col)


def list_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """A file listing as a relation (path, modification time, length), read by
    Spark's ``binaryFile`` source without reading contents."""
    return (spark.read.format("binaryFile").load(path_glob)
            .select("path", F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"), "length"))
