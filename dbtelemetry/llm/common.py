"""Helpers shared by the operators: input columns, shared tables, word rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed by the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` (null as empty), plus ``more``; any other column of the input is left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def remainder(id_col: str | Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; a null id counts as remainder -1."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % mod, F.lit(-1))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Executors and driver share it. Only a local session without the
    setting (tests) gets a temporary folder; a cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage there: a lost executor costs a re-read, not a
    recomputation, and every later pass reads the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return len(df.take(1)) == 0


BATCH_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, unless the session has a smaller limit: whole texts make large rows."""
    n = int(spark.conf.get(BATCH_SETTING, "10000"))
    if n <= 0 or n > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows, in batches that hold about ``size`` bytes of ``column`` or the last of them."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.column(column).nbytes
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def with_columns(docs: DataFrame, start: Callable[[], Callable[[list[str]], dict]], fields: list[tuple[str, T.DataType]],
                 text_col: str = "text", size: int = 6_000_000) -> DataFrame:
    """``docs`` with columns computed from the whole text (null: empty), in place: no shuffle.

    As with ``withColumn``, a column of the same name is replaced.

    ``start`` runs once a task and gives the function from a chunk's texts
    to a list of values for each of ``fields``.
    """
    small_batches(docs.sparkSession)
    names = {n for n, _ in fields}
    stay = [c for c in docs.columns if c not in names]
    read = docs.select(*stay) if text_col in stay else docs.select(*stay, text_col)
    schema = T.StructType([*[docs.schema[c] for c in stay], *[T.StructField(n, t) for n, t in fields]])

    def run(batches):
        compute = start()
        for batch in chunks(batches, text_col, size):
            texts_ = [t or "" for t in batch.column(text_col).to_pylist()]
            made = compute(texts_)
            arrays = [*[batch.column(c) for c in stay], *[pa.array(made[n], to_arrow(t)) for n, t in fields]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*stay, *[n for n, _ in fields]])

    return read.mapInArrow(run, schema)


def to_arrow(t: T.DataType) -> pa.DataType:
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(),
            T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}[t]
