"""Sharding by extendible hashing.

A document's hash is the first 60 bits of the md5 of its id. A bucket is a
prefix of hash bits; a bucket over the byte limit splits on its next bit,
all others keep their depth, until every bucket fits. The directory that
maps prefixes to buckets is a table, not a driver structure.

One pass sums bytes per prefix of ``bits`` bits, enough for about 64 cells
a shard; sums of all shorter prefixes follow from these sums. Cells that are
still too large are refined by further passes over their rows alone. A
single hash value over the limit (one larger document, or rows that repeat
an id) cannot split; its shard is flagged ``over_limit``.

Null texts have no bytes; null ids hash as the empty text. Empty input
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common

HASH_BITS = 60
STEP_BITS = 8
LIMIT = 1 << 20


def hash60(id_col: Column) -> Column:
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    # A shift by the column's own depth: shiftright takes literals only.
    return F.floor(h / F.pow(F.lit(2.0), F.lit(HASH_BITS) - depth)).cast("long")


def directory(rows: DataFrame, limit: int, bits: int | None = None) -> DataFrame:
    """Buckets of ``rows`` (``h, bytes``): ``depth, prefix, shard_bytes, over_limit``.

    Every row lies in exactly one bucket.
    """
    if bits is None:
        total = rows.agg(F.sum("bytes")).first()[0] or 0
        bits = min(HASH_BITS, max(1, math.ceil(math.log2(max(1.0, total / limit))) + 6))
    found: list[DataFrame] = []
    low, todo = 0, rows.select("h", "bytes")
    while True:
        cells = (todo.groupBy(F.shiftright("h", HASH_BITS - bits).alias("cell"))
                 .agg(F.sum("bytes").alias("bytes")))
        nodes = (cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(bits))))
                 .select("depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("prefix"), "bytes")
                 .groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")))
        nodes = common.stored(nodes)
        over = nodes.filter(F.col("shard_bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"))
        # A bucket: a node that fits (or can split no more) below a node that doesn't.
        fits = nodes.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS))
        below = fits.filter(F.col("depth") > low).withColumn("_parent", F.shiftright("prefix", 1))
        leaf = below.join(over, ["depth", "_parent"], "left_semi").drop("_parent")
        top = fits.filter(F.col("depth") == low) if low == 0 else None
        found.append(leaf if top is None else leaf.unionByName(top))
        if bits == HASH_BITS or common.is_empty(nodes.filter((F.col("depth") == bits) & (F.col("shard_bytes") > limit))):
            break
        large = nodes.filter((F.col("depth") == bits) & (F.col("shard_bytes") > limit)).select(
            F.col("prefix").alias("_cell"))
        todo = todo.withColumn("_cell", F.shiftright("h", HASH_BITS - bits)).join(large, "_cell", "left_semi").drop("_cell")
        low, bits = bits, min(HASH_BITS, bits + STEP_BITS)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.withColumn("over_limit", F.col("shard_bytes") > limit)


def shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, bytes, depth, shard, shard_bytes, over_limit``.

    ``shard`` is the bucket's bits as text (empty for the only bucket of a
    table that fits whole).
    """
    rows = common.stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)).cast("long"), F.lit(0).cast("long")).alias("bytes"),
        hash60(F.col(id_col)).alias("h")))
    book = common.stored(directory(rows, limit))
    depths = sorted(r[0] for r in book.select("depth").distinct().collect())  # at most 61 values
    # A row's bucket is found by its prefix at each depth that occurs: the least deep cell key
    # common to all buckets deals rows and buckets out, the exact prefix decides.
    low = depths[0] if depths else 0
    probe = rows.withColumn("_low", F.shiftright("h", HASH_BITS - low))
    book = book.withColumn("_low", F.expr(f"shiftright(prefix, depth - {low})"))
    hit = F.expr(f"shiftright(h, {HASH_BITS} - depth) = prefix")
    out = probe.join(book, "_low").filter(hit)
    bits = F.expr("case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end")
    return out.select("doc_id", "bytes", F.col("depth").cast("long").alias("depth"), bits.alias("shard"),
                      F.col("shard_bytes"), "over_limit")


def write(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the input's rows as one folder per shard (``shard=<bits>``) under ``path``.

    Rows with a repeated id go to the same shard. The shuffle is by shard;
    no shard but a flagged one is larger than ``limit``.
    """
    plan = shards(docs, limit, id_col, text_col).select(F.col("doc_id").alias("_id"), F.concat(F.lit("b"), "shard").alias("shard")).distinct()
    out = docs.drop("shard").join(plan, F.col(id_col).cast("long").eqNullSafe(F.col("_id"))).drop("_id")
    out.repartition("shard").write.partitionBy("shard").parquet(path)


def op8_extendible_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents with their shard, at most 1 MiB of text a shard."""
    return shards(common.table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
n AS (
  SELECT k AS depth, h >> (60 - k) AS prefix, sum(bytes)::BIGINT AS shard_bytes
  FROM d, (SELECT unnest(range(0, 41))::INT AS k) GROUP BY ALL),
j AS (
  SELECT d.doc_id, d.bytes, n.depth, n.prefix, n.shard_bytes,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY n.depth) AS r
  FROM d JOIN n ON d.h >> (60 - n.depth) = n.prefix WHERE n.shard_bytes <= 1048576)
SELECT doc_id, bytes, depth::BIGINT AS depth,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, shard_bytes, false AS over_limit
FROM j WHERE r = 1
"""
