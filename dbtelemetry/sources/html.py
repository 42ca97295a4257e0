"""HTML documents in ordered parts.

A report of any size is a sequence of parts: the header, tables rows in
blocks of ``PART_ROWS``, the footer. No aggregation group holds more than
one block. The writer stores every part as a file and, when all tasks have
ended, commits a manifest that names the files in order; readers follow
the manifest, so files of failed attempts are never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from dbtelemetry.operators.ordering import positions
from dbtelemetry.sources import sinks

PART_ROWS = 1000
FORMAT = "html_document"
MANIFEST = "manifest.json"


def document_parts(rows: DataFrame, headers: Sequence[str], order_by: Sequence[str], keys: Sequence[str] = (), width: str = "100%",
                   color: str = "blue", title: str = "", part_rows: int = PART_ROWS) -> DataFrame:
    """``keys, part, html``: each report's header (part 0), its rows in blocks, its footer (the last part).

    ``rows`` come from :func:`~dbtelemetry.sources.sinks.html_rows`. Without
    keys a report of no rows is header and footer; with keys, a key without
    rows has no report.
    """
    keys = list(keys)
    placed = positions(rows, [*order_by, "html"], keys, "__at")
    part = (F.floor(F.col("__at") / part_rows) + 1).cast("bigint")
    body = (placed.withColumn("part", part).groupBy(*keys, "part")
            .agg(F.expr("listagg(html, '') WITHIN GROUP (ORDER BY __at)").alias("html")))
    last = placed.groupBy(*keys).agg((F.floor(F.coalesce(F.max("__at"), F.lit(-part_rows)) / part_rows) + 2).cast("bigint").alias("last"))
    head, foot = F.struct(F.lit(0).cast("bigint").alias("part"), F.lit(title + sinks.html_header(headers, width, color)).alias("html")), \
        F.struct(F.col("last").alias("part"), F.lit(sinks.TABLE_CLOSE).alias("html"))
    ends = last.select(*keys, F.explode(F.array(head, foot)).alias("e")).select(*keys, "e.part", "e.html")
    return body.unionByName(ends)


@dataclass
class PartFiles(WriterCommitMessage):
    files: list[tuple[str, int, str]]


class HtmlWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.run = uuid.uuid4().hex

    def _folder(self):
        from pyarrow import fs

        there, path = (fs.FileSystem.from_uri(self.path) if "://" in self.path
                       else (fs.LocalFileSystem(), self.path.removeprefix("file:")))
        there.create_dir(path, recursive=True)
        return there, path.rstrip("/")

    def write(self, iterator: Iterator) -> PartFiles:
        there, folder = self._folder()
        files = []
        for row in iterator:
            name = f"{self.run}-{uuid.uuid4().hex}.html"
            with there.open_output_stream(f"{folder}/{name}") as f:
                f.write(row["html"].encode())
            files.append((row["report"] or "", row["part"], name))
        return PartFiles(files)

    def commit(self, messages: list[PartFiles | None]) -> None:
        there, folder = self._folder()
        files = sorted(f for m in messages if m is not None for f in m.files)
        earlier = [] if self.overwrite else self._listed(there, folder)
        with there.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps(earlier + [{"report": r, "part": p, "file": n} for r, p, n in files]).encode())

    @staticmethod
    def _listed(there, folder: str) -> list:
        from pyarrow import fs

        if there.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.NotFound:
            return []
        with there.open_input_file(f"{folder}/{MANIFEST}") as f:
            return json.loads(f.read())

    def abort(self, messages: list[PartFiles | None]) -> None:
        """Files of an aborted write stay unnamed by any manifest."""


class HtmlSource(DataSource):
    """``df.write.format("html_document")``: rows ``report, part, html``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "report string, part bigint, html string"

    def writer(self, schema, overwrite: bool) -> HtmlWriter:
        return HtmlWriter(self.options, overwrite)


def write_document(parts: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Write the parts of one or many documents as files and commit their manifest."""
    parts.sparkSession.dataSource.register(HtmlSource)
    report = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    parts.select(report.alias("report"), "part", "html").write.format(FORMAT).mode("overwrite").save(path)
