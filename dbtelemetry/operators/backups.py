"""Backups and restores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators.common import Keys, on, with_absent
from dbtelemetry.operators.ordering import in_order

# Labels of the backup-history report. "reference" keeps them
# verbatim (a trailing blank after 2005, level 110 shown as 2011, device 105
# shown as temporary); "corrected" fixes those three.
COMPATIBILITY_LABELS = {
    "reference": [(80, "SQL Server 2000"), (90, "SQL Server 2005 "), (100, "SQL Server 2008"),
                  (110, "SQL Server 2011")],
    "corrected": [(80, "SQL Server 2000"), (90, "SQL Server 2005"), (100, "SQL Server 2008"),
                  (110, "SQL Server 2012")],
}
BACKUP_TYPE_LABELS = [("D", "Full"), ("I", "Differential"), ("L", "Log"), ("F", "File or filegroup"),
                      ("G", "Differential file"), ("P", "P"), ("Q", "Differential partial")]
DEVICE_LABELS = {
    "reference": [(2, "Disk - Temporary"), (102, "Disk - Permanent"), (5, "Tape - Temporary"),
                  (105, "Tape - Temporary")],
    "corrected": [(2, "Disk - Temporary"), (102, "Disk - Permanent"), (5, "Tape - Temporary"),
                  (105, "Tape - Permanent")],
}
OTHER_DEVICE = "Other Device"


def _case(col: str, pairs, default=None):
    expr = None
    for k, v in pairs:
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr.otherwise(default) if default is not None else expr


def backup_history(backupset: DataFrame, media: DataFrame, labels: str = "reference",
                   keys: Keys = ()) -> DataFrame:
    """Backups with decoded level, type and device, one row per media file.

    Striped backups (several media files) repeat. Unknown levels and types
    are NULL (no ELSE); unknown devices are "Other Device".
    """
    m = media.select(*keys, "media_set_id", "physical_device_name", "device_type")
    sets = with_absent(backupset, "bigint", "compressed_backup_size").select(
        *keys, F.col("server_name").alias("server"), "database_name", "compatibility_level", "recovery_model", "type",
        "backup_start_date", "backup_finish_date", "backup_size", "compressed_backup_size", "media_set_id")
    j = in_order(sets, [*keys, F.col("backup_start_date").desc()], lambda rows: rows.join(m, on(["media_set_id"], keys)))
    return j.select(
        *keys, "server", "database_name",
        _case("compatibility_level", COMPATIBILITY_LABELS[labels]).alias("compatibility_level"),
        "recovery_model",
        _case("type", BACKUP_TYPE_LABELS).alias("backup_type"),
        "backup_start_date", "backup_finish_date",
        F.col("physical_device_name").alias("physical_device"),
        _case("device_type", DEVICE_LABELS[labels], OTHER_DEVICE).alias("device_type"),
        "backup_size", "compressed_backup_size")


def weekly_backup_report(backupset: DataFrame, media: DataFrame, as_of, days: int = 6,
                         keys: Keys = ()) -> DataFrame:
    """Backups started in the ``days`` days up to ``as_of`` (strict ``>``), with run time in minutes.

    Start time is formatted as style 113; minutes count boundaries
    (T-SQL ``DATEDIFF``). One row per media file, as in the reference.
    """
    lower = tsql.as_ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    b = backupset.filter((F.col("backup_start_date") > lower) & (F.col("backup_start_date") <= tsql.as_ts(as_of)))
    j = b.join(media.select(*keys, "media_set_id"), on(["media_set_id"], keys))
    return j.select(*keys, F.col("server_name").alias("server"), "database_name",
                    tsql.format_113("backup_start_date").alias("backup_start"),
                    tsql.datediff_boundaries("minute", "backup_start_date", "backup_finish_date")
                    .alias("run_time_minutes"),
                    "backup_start_date").orderBy(*keys, "backup_start_date")


def last_restore(restore_history: DataFrame, database: str | None = None, keys: Keys = ()) -> DataFrame:
    """The latest restore per database, all columns (``TOP 1 * ... ORDER BY restore_date DESC``).

    One aggregation: the whole row travels in the maximum of (date, id), so
    a database with many restores is reduced in the map tasks. Ties on the
    date go to the highest restore id.
    """
    r = restore_history
    if database is not None:
        r = r.filter(F.col("destination_database_name") == database)
    rest = [c for c in r.columns if c not in (*keys, "destination_database_name", "restore_date", "restore_id")]
    newest = F.max(F.struct("restore_date", "restore_id", *rest)).alias("newest")
    per = r.groupBy(*keys, "destination_database_name").agg(newest)
    return per.select(*[c if c in (*keys, "destination_database_name") else F.col("newest").getField(c).alias(c) for c in r.columns])


def backup_file_name(prefix, as_of, suffix: str = ".bak"):
    """``prefix + '_' + yyyymmdd(as_of - 1 day) + suffix``, a Column expression."""
    day = F.date_sub(F.to_date(tsql.as_ts(as_of)), 1)
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit(suffix))
