"""Exact dedup by skew-safe combining.

Rows are deduplicated inside each map task, the survivors are merged per
(digest, salt), and the salt winners are combined per digest. The grouping
key holds the whole text next to its digest at every stage, so two texts
are one group only if they are identical; the digest merely spreads and
pre-sorts them. The salt comes from the row's id, so a group that holds a
third of all rows is merged by ``salts`` tasks, each of which receives one
row per map task.

Null texts count as empty. Of equal texts the row with the largest id
stays (null ids rank lowest); of rows that repeat both id and text exactly
one stays. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.llm import common

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _salt(id_col: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct text: ``digest, text, keep_id, group_size``."""
    rows = common.texts(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", digest(F.col("text")).alias("digest"),
                       _salt("doc_id", salts).alias("salt"))
    # The partial aggregation of this step runs in the map tasks: the local dedup.
    merged = (rows.groupBy("digest", "salt", "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return (merged.groupBy("digest", "text")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows that stay, with exactly the input's columns (one row per distinct text).

    A row whose id ties with another's is preferred if its text is not null.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        text.alias("text"), digest(text).alias("digest"), _salt(id_col, salts).alias("salt"),
        F.struct(F.col(id_col).alias("id"), F.col(text_col).isNotNull().alias("present")).alias("order"),
        F.struct(F.lit(0).alias("_"), *[F.col(c) for c in rest]).alias("rest"))

    def best(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.max("order").alias("_o"), F.max_by("rest", "order").alias("_r")) \
            .select(*keys, F.col("_o").alias("order"), F.col("_r").alias("rest"))

    out = best(best(rows, "digest", "salt", "text"), "digest", "text")
    column = {id_col: F.col("order.id"), text_col: F.when(F.col("order.present"), F.col("text"))}
    return out.select(*[column.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows find their group by digest alone, which moves no text, as long as
    no two different texts share a digest; the group table tells. If some
    do, rows and groups are matched by digest and text.
    """
    rows = common.texts(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", digest(F.col("text")).alias("digest"),
                       sha256(F.col("text")).alias("text_sha256"))
    ids = common.stored(rows.drop("text"))
    found = classes(docs, id_col, text_col, salts, digest)
    narrow = common.stored(found.drop("text"))
    shared = narrow.groupBy("digest").count().filter("count > 1")
    if common.is_empty(shared):
        out = ids.join(narrow, "digest")
    else:
        out = rows.join(found, ["digest", "text"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = ids.groupBy("doc_id", "text_sha256").count().filter("count > 1")
    if not common.is_empty(repeated):
        w = Window.partitionBy("doc_id", "digest", "text_sha256").orderBy("group_size")
        out = out.withColumn("_n", F.row_number().over(w))
        kept = kept & (F.col("_n") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    return groups(common.table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
