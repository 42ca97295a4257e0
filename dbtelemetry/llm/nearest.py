"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, so that the nearest by distance are the
nearest by cosine. Each of ``tables`` hash tables has ``hashes`` functions
floor((a.x + b) / width) with normal a: near vectors fall into the same or
neighbouring cells. A query visits, in each table, the ``probes`` buckets
likeliest to hold near vectors: all moves of its cell by -1, 0 or 1 in each
function are ordered by the summed squared distances to the cell walls that
they cross. Candidates of all tables are merged and reranked by the exact
cosine of the original vectors in double precision.

Rows and probes meet in groups of bounded size: buckets are dealt to cells
of about ``block`` rows a table, a larger bucket is split into blocks, and
where over ``query_block`` queries visit a group they are split as well. Only
the rows of such groups are copied, once for each part of their queries, so
what moves grows with the rows and with the work. A group answers with the k
best per query, so hot buckets cost work, not rows. No row, bucket or candidate
is capped. All parameters are independent of the data.

A query whose probes reach fewer than k rows (or than there are, if fewer) is
compared with all rows, exactly, in blocks of queries that are sent to all tasks.

Vectors that are null, zero, or hold null or non-finite components take no
part; vectors of different length never meet. Ties go to the smaller id. A
query's own id is no candidate. Rows that repeat an id count as candidates
each; the id is listed once with its best score. A null id takes no part.
Empty input gives an empty result.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.llm import common

TABLES = 8
HASHES = 4
WIDTH = 1.2
PROBES = 30
BLOCK = 8192
QUERY_BLOCK = 4096
QUERY_EVERY = 50
K = 5


@functools.lru_cache(maxsize=16)
def _functions(dim: int, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([dim, tables, hashes])
    return rng.standard_normal((dim, tables * hashes)), rng.random(tables * hashes) * width


@functools.lru_cache(maxsize=4)
def _moves(hashes: int) -> np.ndarray:
    return np.array(list(itertools.product((-1, 0, 1), repeat=hashes)), np.int64)


def _bucket(cells: np.ndarray, dim: int) -> np.ndarray:
    """64-bit key of the cell coordinates in the last axis."""
    h = np.full(cells.shape[:-1], np.uint64(dim))
    with np.errstate(over="ignore"):
        for k in range(cells.shape[-1]):
            h = (h ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def usable(values: list) -> np.ndarray | None:
    """The vector in double precision, or None if it takes no part."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def cells(x: np.ndarray, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Cell coordinates of unit vectors (rows x tables x hashes) and the place within the cell, 0 to 1."""
    a, b = _functions(x.shape[1], tables, hashes, width)
    f = (x @ a + b) / width
    cell = np.floor(f)
    return cell.astype(np.int64).reshape(len(x), tables, hashes), (f - cell).reshape(len(x), tables, hashes)


def probes_of(cell: np.ndarray, place: np.ndarray, probes: int) -> np.ndarray:
    """Cells to visit (rows x tables x probes x hashes), likeliest first."""
    moves = _moves(cell.shape[-1])
    down, up = place**2, (1.0 - place) ** 2
    cost = down @ (moves == -1).T.astype(float) + up @ (moves == 1).T.astype(float)
    order = np.argsort(cost, axis=-1, kind="stable")[..., :probes]
    return cell[..., None, :] + moves[order]


def _hashed(vectors: DataFrame, id_col: str, vec_col: str, tables: int, hashes: int, width: float, probes: int | None) -> DataFrame:
    """``id, dim, vec, keys``: the row's bucket in each table, or its probes, table after table."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull())

    def run(batches):
        for batch in batches:
            by_dim: dict[int, list] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if (x := usable(v)) is not None:
                    by_dim.setdefault(len(x), []).append((i, x))
            for dim, own in by_dim.items():
                x = np.stack([v for _, v in own])
                largest = np.abs(x).max(axis=1, keepdims=True)  # no overflow in the length
                unit = x / largest
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                cell, place = cells(unit, tables, hashes, width)
                keys = _bucket(cell if probes is None else probes_of(cell, place, probes), dim).reshape(len(x), -1)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([i for i, _ in own], pa.int64()), "dim": pa.array([dim] * len(own), pa.int32()),
                    "vec": pa.array([r.astype("<f8").tobytes() for r in x], pa.binary()),
                    "keys": pa.array(keys.tolist(), pa.list_(pa.int64()))})

    return rows.mapInArrow(run, "id long, dim int, vec binary, keys array<long>")


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, the same for a pair wherever it is computed."""
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def _best(rows: pd.DataFrame, asks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each query among the rows whose bucket it visits."""
    found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(asks):
        ids, key = rows["id"].to_numpy(), rows["key"].to_numpy()
        x = np.frombuffer(b"".join(rows["vec"]), "<f8").reshape(len(rows), -1)
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        for query, vec, keys in zip(asks["id"], asks["vec"], asks["keys"], strict=True):
            q = np.frombuffer(vec, "<f8")
            lo, hi = np.searchsorted(sorted_key, keys, "left"), np.searchsorted(sorted_key, keys, "right")
            at = np.concatenate([order[a:b] for a, b in zip(lo, hi, strict=True)])
            at = at[ids[at] != query]
            if not len(at):
                continue
            near = unit[at] @ (q / np.sqrt((q * q).sum()))
            if len(at) > k:
                # Everything that could be among the k best, rounding of this first pass allowed for.
                at = at[near >= np.partition(near, -k)[-k] - 1e-9]
            score = _cosines(q, x[at])
            top = np.lexsort((ids[at], -score))[:k]
            found["query_id"] += [query] * len(top)
            found["vec_id"] += ids[at][top].tolist()
            found["score"] += score[top].tolist()
    return pd.DataFrame(found).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES,
           block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, nearest first."""
    common.small_batches(vectors.sparkSession)
    index = _hashed(vectors, id_col, vec_col, tables, hashes, width, None)
    index = common.stored(index.withColumn("row", F.monotonically_increasing_id()))
    asks = common.stored(_hashed(queries, id_col, vec_col, tables, hashes, width, probes))
    cells_n = max(1, -(-index.count() // block))
    entries = index.select("id", "dim", F.posexplode("keys").alias("table", "key"))
    blocks = entries.groupBy("dim", "table", "key").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    blocks = _sent(blocks.filter("blocks > 1"))  # buckets that are split: at most one per ``block`` rows
    cell = F.pmod(F.xxhash64("key"), F.lit(cells_n)).cast("int").alias("cell")
    place = ["dim", "table", "cell", "block"]

    visits = asks.select("id", "dim", F.posexplode("keys").alias("n", "key"))
    visits = visits.withColumn("table", F.floor(F.col("n") / F.lit(probes)).cast("int"))
    visits = visits.join(blocks, ["dim", "table", "key"], "left")
    visits = visits.select("id", "dim", "table", "key", cell,
                           F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"))
    visits = common.stored(visits.groupBy("id", *place).agg(F.collect_set("key").alias("keys")))
    crowded = visits.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / F.lit(query_block)).cast("int").alias("parts"))
    crowded = _sent(crowded.filter("parts > 1"))  # at most one per ``query_block`` visits
    visits = visits.join(crowded, place, "left").withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(11)), F.coalesce("parts", F.lit(1))).cast("int"))
    whole = asks.select("id", "dim", "vec").dropDuplicates(["id", "dim", "vec"])
    visits = visits.select("id", *place, "keys", "part").join(whole, ["id", "dim"])

    full = index.select("id", "row", "dim", "vec", F.posexplode("keys").alias("table", "key"))
    full = full.join(blocks, ["dim", "table", "key"], "left")
    full = full.select("id", "dim", "table", "key", "vec", cell,
                       F.pmod(F.xxhash64("row", F.lit(7)), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    full = full.join(crowded, place, "left")
    full = full.select("id", "key", "vec", *place, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))

    def best(rows, asked):
        return _best(rows, asked, k)

    group = [*place, "part"]
    some = full.groupBy(*group).cogroup(visits.groupBy(*group)).applyInPandas(best, _FOUND)
    some = common.stored(some.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    some = some.union(_few(index, whole, some, k, query_block))
    merged = some.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (merged.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SENT_ROWS = 100_000


def _sent(table: DataFrame) -> DataFrame:
    """A stored table for joins, broadcast if it has few rows: the rows that it meets carry vectors and need not move."""
    table = common.stored(table)
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


_FOUND = "query_id long, vec_id long, score double"


def _few(index: DataFrame, asks: DataFrame, found: DataFrame, k: int, query_block: int) -> DataFrame:
    """The k best of all rows for the queries that have found fewer than k, although there are more."""
    there = index.select("dim", "id").distinct().groupBy("dim").agg(F.count(F.lit(1)).alias("there"))  # one row a length
    got = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("got")).withColumnRenamed("query_id", "id")
    short = asks.join(there, "dim", "left").join(got, "id", "left")
    # A query may or may not be among the rows itself; one candidate too many only costs a comparison.
    short = short.filter(F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.coalesce("there", F.lit(0))))
    short = common.stored(short.select("id", "dim", "vec"))
    out = index.sparkSession.createDataFrame([], _FOUND)
    blocks_n = -(-short.count() // query_block)
    for b in range(blocks_n):
        part = short.filter(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(blocks_n)) == b).toPandas()
        sent = index.sparkSession.sparkContext.broadcast(part.assign(keys=[[0]] * len(part)))  # about ``query_block`` queries

        def run(batches, sent=sent):
            for batch in common.chunks(batches, "vec", 8_000_000):
                rows = batch.to_pandas().assign(key=0)
                for dim, asked in sent.value.groupby("dim"):
                    hits = _best(rows[rows["dim"] == dim], asked, k)
                    yield pa.RecordBatch.from_pandas(hits, preserve_index=False)

        out = out.union(index.select("id", "dim", "vec").mapInArrow(run, _FOUND))
    return out


def op1_multiprobe_lsh(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50, among all vectors."""
    vectors = common.table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % QUERY_EVERY == 0))
