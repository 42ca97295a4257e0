"""Sinks: append to a log table, HTML report rows and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql

# The table markup of the mailed reports.
TABLE_OPEN = ('<table style = "font-family: Arial; font-size: 8pt" border = "1" cellspacing = "0" '
              'cellpadding = "2" width={width}>')
HEADER_ROW_OPEN = '<tr style = "background-color: {color}; font-size: 10pt;">'
TABLE_CLOSE = "</table>"


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append rows to a log table, partitioned (e.g. by capture date)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


#: Folder of a capture table's index; readers of the table do not see it.
CAPTURE_INDEX = "_captures"


def append_captures(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S10 for snapshot relations: append captures by day, and to the capture index one row per server and day.

    ``df`` has ``captured_at``; the day is added. The index holds the first
    and the last capture of a server's day, so a scan as of some moment
    finds the days that it needs without listing the table's history. It is
    written after the rows: a capture without an index row is one whose
    append did not end.
    """
    df = df.withColumn("captured_date", F.to_date("captured_at"))
    append(df, path, ["captured_date"], fmt)
    by = [c for c in ("server_name",) if c in df.columns]
    days = df.groupBy(*by, "captured_date").agg(F.min("captured_at").alias("first_capture"), F.max("captured_at").alias("last_capture"))
    append(days.coalesce(1), f"{path.rstrip('/')}/{CAPTURE_INDEX}")


def write_output(df: DataFrame, path: str) -> None:
    """Captured command output (``server_name``, ``output``) as text files that hold many servers.

    A line is the server's name, URL-encoded, a tab and a line of output; NULL
    output is an empty line. The number of files follows the table's
    partitions, not its servers: a folder a server costs some tens of
    milliseconds each. :func:`~dbtelemetry.sources.readers.text_source` reads it back.
    """
    # Folders named by server showed this name for servers without one.
    server = F.coalesce(F.when(F.col("server_name") != "", F.col("server_name").cast("string")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    line = F.explode(F.split(F.coalesce("output", F.lit("")), "\r\n|\r|\n"))
    rows = df.select(F.url_encode(server).alias("server"), line.alias("line"))
    rows.select(F.concat("server", F.lit("\t"), "line")).write.text(path)


def new_folder(spark) -> str:
    """A folder for one table in the shared folder, grouped by application, so a retention job
    can drop a finished application's tables in one folder."""
    import uuid

    from dbtelemetry.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, columnar: bool = False, codec: str | None = None) -> DataFrame:
    """Materialize an intermediate read more than once.

    Written into the folder named by ``spark.checkpoint.dir`` (shared
    storage on a cluster), so the copy survives a lost executor and the
    lineage before it is cut. ``columnar=True`` writes a Parquet table
    there (later passes read only the columns they need), compressed with
    ``codec`` if one is given; otherwise a reliable ``checkpoint()``, which keeps partitions and their order.
    """
    from dbtelemetry.session import ensure_checkpoint_dir

    spark = df.sparkSession
    if not columnar:
        ensure_checkpoint_dir(spark)
        # Persist first: an eager checkpoint runs one job to compute and
        # another to write, which would otherwise compute the input twice.
        from pyspark import StorageLevel

        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return df.checkpoint(eager=True)
        finally:
            df.unpersist()
    path = new_folder(spark)
    df.write.parquet(path, compression=codec)
    return spark.read.parquet(path)


def _cell(c: Column) -> Column:
    # FOR XML PATH leaves out the element of a NULL value entirely.
    return F.when(c.isNotNull(), F.concat(F.lit("<td>"), tsql.html_escape(c), F.lit("</td>")))


def html_row(columns: Sequence[str]) -> Column:
    """One ``<tr>`` per row: ``<td>`` per non-NULL value, ``& < >`` escaped."""
    return F.concat(F.lit("<tr>"), F.concat_ws("", *[_cell(F.col(c)) for c in columns]), F.lit("</tr>"))


def html_header(headers: Sequence[str], width: str = "100%", color: str = "blue") -> str:
    cells = "".join(f'<th ALIGN="left">{h}</th>' for h in headers)
    return TABLE_OPEN.format(width=width) + HEADER_ROW_OPEN.format(color=color) + cells


def html_rows(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """S12, row form: one HTML fragment per record, with the report key and ordering columns.

    Nothing is gathered: the fragments stay distributed and a file sink
    writes them in order (:func:`write_html`).
    """
    carried = list(dict.fromkeys([*keys, *order_by]))
    return df.select(*[F.col(c) for c in carried], html_row(columns).alias("html"))


def html_document(rows: DataFrame, headers: Sequence[str], order_by: Sequence[str], keys: Sequence[str] = (),
                  width: str = "100%", color: str = "blue", title: str = "") -> DataFrame:
    """S12, text form: header, the rows in order, then ``</table>``, one text per report key.

    This is the body a mail service needs, so each report key's text is
    built in one aggregation group; use it for alert reports (the filtered
    rows), and :func:`html_rows` plus :func:`write_html` for anything
    large. With no rows the text is the header and footer only (the
    reference's text would be NULL).
    """
    order = ", ".join(order_by)
    agg = rows.groupBy(*keys).agg(F.expr(f"listagg(html, '') WITHIN GROUP (ORDER BY {order})").alias("__body"))
    head = title + html_header(headers, width, color)
    return agg.select(*keys, F.concat(F.lit(head), F.coalesce("__body", F.lit("")), F.lit(TABLE_CLOSE))
                      .alias("html"))


def write_html(rows: DataFrame, path: str, order_by: Sequence[str], num_files: int = 16) -> None:
    """Write report fragments as text files whose name order is the report order."""
    (rows.repartitionByRange(num_files, *order_by).sortWithinPartitions(*order_by)
     .select("html").write.mode("overwrite").text(path))
