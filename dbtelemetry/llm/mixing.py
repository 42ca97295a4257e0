"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight that runs linearly from a start to an end value
over training time 0..1. The integral of that schedule is the source's
weight in the whole mix; the words of all sources are shared out by it,
no source more than ``max_epochs`` times its own words, what is over going
to the others by weight. A source's documents lie end to end in a fixed
pseudo-random order (md5 of the id), once per epoch; a copy is taken if the
middle of it lies before the source's target, and its training position is
the time by which the source's cumulative demand reaches that middle, found
by inverting the integrated schedule in closed form. The result is
range-partitioned and sorted by position.

The running sums never put a source into one task: rows are dealt into
hash ranges, ranges are summed and accumulated per source (one row a
range), and only the rows of one range are accumulated together.

Null texts have size 0; a null source is a source of its own, ranked last.
Size-0 documents and sources take nothing. Rows that repeat an id are
documents of their own; equal rows are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.llm import common

RANGE_ROWS = 4096
# Fixed by the contract: weights of the ranked sources, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Relative slope of the ranked sources' schedules, repeating: early, even, late.
SLOPES = (-0.5, 0.0, 0.5)


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def _hash32(id_col: Column) -> Column:
    """First 32 bits of the md5 of the id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def sources(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, rows, start_weight, end_weight, target``.

    ``sizes`` holds ``source, size``. Windows run over one row per source.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("_rank", rank)
    mean, slope = _cycle(weights, F.col("_rank")), _cycle(slopes, F.col("_rank"))
    s = s.select("source", "source_size", "rows", mean.alias("_w"),
                 (mean * (1 - slope)).alias("start_weight"), (mean * (1 + slope)).alias("end_weight"))
    # Sources fill up in the order of cap per weight: source k is capped if, with all before it
    # capped, its share of the rest still exceeds its cap.
    by_cap = Window.orderBy((F.col("source_size") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    cap = F.col("source_size") * max_epochs
    s = (s.withColumn("_cap", cap)
         .withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_wleft", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
         .withColumn("_capped", F.col("_cap") * F.col("_wleft") <= F.col("_left") * F.col("_w")))
    # The first source that is not capped sets the level for it and all after it.
    s = s.withColumn("_k", F.row_number().over(by_cap))
    s = s.withColumn("_k0", F.min(F.when(~F.col("_capped"), F.col("_k"))).over(every))
    s = (s.withColumn("_capped", F.col("_k0").isNull() | (F.col("_k") < F.col("_k0")))
         .withColumn("_level", F.max(F.when(F.col("_k") == F.col("_k0"),
                                            F.col("_left").cast("double") / F.col("_wleft"))).over(every)))
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("_w") * F.col("_level"))
    return s.select("source", "source_size", "rows", "start_weight", "end_weight", target.alias("target"))


def position(done: Column, start: Column, end: Column) -> Column:
    """Time at which a schedule running from ``start`` to ``end`` has spent the share ``done`` of its integral."""
    spent = done * (start + end) / 2.0
    return 2.0 * spent / (start + F.sqrt(start * start + 2.0 * (end - start) * spent))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_epochs: int = MAX_EPOCHS,
        range_rows: int = RANGE_ROWS, payload: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row, sorted by first position (rows not taken last).

    Columns: ``doc_id, size, source_size, target, taken, positions`` and the
    ``payload`` columns as ``struct payload``.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(common.WORD)).cast("long"), F.lit(0).cast("long"))
    # Only ids and sizes are kept; payloads are read again and carried once.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size"), _hash32(F.col(id_col)).alias("h"),
                       *([F.struct(*[F.col(c) for c in payload]).alias("payload")] if payload else []))
    sizes = common.stored(rows.select("doc_id", "source", "size", "h"))
    src = common.stored(sources(sizes, weights, slopes, max_epochs))
    same = lambda a, b: a.eqNullSafe(b)

    def with_range(df: DataFrame) -> DataFrame:
        # The source table joins by a key that keeps null apart; ranges follow the source's row count.
        j = df.join(src.withColumnRenamed("source", "_s"), same(df["source"], F.col("_s"))).drop("_s")
        ranges = F.ceil(F.col("rows") / F.lit(range_rows))
        return j.withColumn("range", F.floor(F.col("h") * ranges / F.lit(float(1 << 32))).cast("long"))

    sums = with_range(sizes).groupBy("source", "range").agg(F.sum("size").alias("_sum"))
    until = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_s"), F.col("range").alias("_r"),
                         F.coalesce(F.sum("_sum").over(until), F.lit(0)).alias("_start"))
    base = with_range(rows if payload else sizes)
    order = [F.col("h"), F.col("doc_id").asc_nulls_last(), F.col("size")]
    inside = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    j = base.withColumn("_upto", F.sum("size").over(inside))
    j = j.join(starts, same(j["source"], F.col("_s")) & (j["range"] == F.col("_r")))
    middle = (F.col("_start") + F.col("_upto") - F.col("size")).cast("double") + F.col("size").cast("double") / 2.0

    def copy(k: int) -> Column:
        at = middle + F.col("source_size").cast("double") * float(k)
        return F.when((F.col("size") > 0) & (at < F.col("target")),
                      position(at / F.col("target"), F.col("start_weight"), F.col("end_weight")))

    j = j.withColumn("positions", F.filter(F.array(*[copy(k) for k in range(max_epochs)]), lambda p: p.isNotNull()))
    out = j.select("doc_id", "size", "source_size", "target",
                   (F.col("size") * F.size("positions")).cast("long").alias("taken"), "positions",
                   *(["payload"] if payload else []))
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))  # after every position, which are below 1
    return (out.withColumn("_first", first).repartitionByRange(F.col("_first"), F.col("doc_id"))
            .sortWithinPartitions("_first", "doc_id").drop("_first"))


def sequence(docs: DataFrame, payload: tuple[str, ...], **kw) -> DataFrame:
    """The training sequence: one row per taken copy (``position`` and the payload columns), range-sorted by position."""
    m = mix(docs, payload=payload, **kw)
    m = m.select(F.explode("positions").alias("position"), "payload")
    return (m.repartitionByRange(F.col("position")).sortWithinPartitions("position")
            .select("position", *[F.col("payload").getField(c).alias(c) for c in payload]))


def op10_curriculum_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of them and their first training position."""
    m = mix(common.table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken",
                    F.round(F.get("positions", F.lit(0)), 9).alias("first_position"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents),
r AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (
  SELECT source, source_size, [5, 2, 1][k % 3 + 1] AS w, [-0.5, 0.0, 0.5][k % 3 + 1]::DOUBLE AS slope,
         3 * source_size AS cap FROM r),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT AS rest,
         (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS wrest
  FROM w WINDOW b AS (ORDER BY source_size / w::DOUBLE, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST) AS i,
         cap * wrest <= rest * w AS full_up FROM f),
l AS (
  SELECT *, min(CASE WHEN NOT full_up THEN i END) OVER () AS i0 FROM g),
t AS (
  SELECT source, source_size, w * (1 - slope) AS s, w * (1 + slope) AS e,
         CASE WHEN i0 IS NULL OR i < i0 THEN cap::DOUBLE
              ELSE w * (SELECT rest::DOUBLE / wrest FROM l WHERE i = i0) END AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.s, t.e,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size
                            ROWS UNBOUNDED PRECEDING) - d.size)::DOUBLE + d.size::DOUBLE / 2 AS mid
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * ((mid < target)::INT + (mid + source_size < target)::INT
                + (mid + 2.0::DOUBLE * source_size < target)::INT))::BIGINT AS taken,
       CASE WHEN size > 0 AND mid < target THEN
         round(2.0 * (mid / target * (s + e) / 2.0)
               / (s + sqrt(s * s + 2.0 * (e - s) * (mid / target * (s + e) / 2.0))), 9) END AS first_position
FROM p
"""
