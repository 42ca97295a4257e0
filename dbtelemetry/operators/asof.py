"""As-of lookups: the version of a key that covers a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.sources import sinks


def latest_covering(rows: DataFrame, versions: DataFrame, keys: Sequence[str], row_id: str, at: str, begin: str, end: str,
                    take: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """``row_id, *take`` of each row for which some version covers it: ``begin <= at <= end`` with equal ``keys``.

    Of several such versions the one with the largest (``end``, ``take``)
    is taken. A NULL in a key, a bound or the moment never matches.

    Rows and versions are one sequence in time, and each row looks back at
    the running maximum of ``end`` over the versions begun so far: if that
    one still covers the row it is the answer, else none does. So a key
    with many rows and many versions costs their sum, not their product.
    The sequence is range-partitioned by key and time, a hot key spans many
    partitions, and one carried maximum per partition joins them.
    """
    n = num_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    known = [F.col(c).isNotNull() for c in keys]
    asked = rows.select(*keys, F.col(at).alias("__t"), F.col(row_id).alias("__id"))
    held = versions.select(*keys, F.col(begin).alias("__t"), F.struct(F.col(end).alias("end"), *take).alias("__v"))
    held = held.filter(F.col("__v.end") >= F.col("__t"))
    for c in known:
        asked, held = asked.filter(c), held.filter(c)
    # Versions of keys that nothing asks for are not sorted.
    held = held.join(asked.select(*keys).distinct(), keys, "left_semi")
    none = F.lit(None).cast(held.schema["__v"].dataType)
    both = (held.withColumn("__id", F.lit(None).cast(asked.schema["__id"].dataType)).withColumn("__kind", F.lit(0))
            .unionByName(asked.withColumn("__v", none).withColumn("__kind", F.lit(1))))
    order = ["__t", "__kind"]
    line = both.repartitionByRange(n, *keys, *order).withColumn("__pid", F.spark_partition_id())
    line = sinks.materialize(line, columnar=True)  # so that the partition numbers stay as they are
    spans = line.groupBy("__pid", *keys).agg(F.max("__v").alias("__m"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("__pid", *keys, F.max("__m").over(before).alias("__carry")).filter(F.col("__carry").isNotNull())
    # Only a partition's first key can begin in an earlier partition: at most one row a partition.
    line = line.join(F.broadcast(carried), ["__pid", *keys], "left")
    run = Window.partitionBy("__pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    best = F.greatest(F.max("__v").over(run), F.col("__carry"))
    found = line.select("__id", "__t", "__kind", best.alias("__best")).filter((F.col("__kind") == 1) & (F.col("__best.end") >= F.col("__t")))
    return found.select(F.col("__id").alias(row_id), *[F.col(f"__best.{c}").alias(c) for c in take])
