"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, the alternating products u = Xv and w = X'u, both
orthogonalised against all their predecessors, give an upper bidiagonal
matrix B with XV = UB. The singular vectors and values of the small B give
the components VQ and their deviations.

A step is one pass over the rows: a task forms its part of Xv, minus the
previous u, and the sums X'u, U'u and u'u over it. As the earlier u are X
times short vectors, their parts are formed again from the rows instead of
being stored; a pass thus returns sums of (dimensions + steps) numbers a
partition, added in partition order within groups of ``FAN`` partitions and
then over the groups, so a rerun on the same partitions adds alike. A lost
executor costs the tasks that it ran.

Steps end when the leading components have converged to ``TOLERANCE`` of
the largest singular value and what the steps left out of the total
variance cannot hold a larger component, at the latest after as many steps
as there are dimensions. When a product vanishes (repeated eigenvalues,
fewer directions than dimensions), a new start vector orthogonal to the
earlier ones goes on.

Entries are whole numbers floor(1024 c) + 100000. A row is left out if its
vector is null, empty, holds null or non-finite entries or entries of
``LARGEST`` or more, or has another length than most vectors (ties: the
longer). Rows that repeat count each. Directions without variance are no
components: a table whose vectors are all equal gives no rows. A null id
is kept. The exact deviation is null if it does not fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
LARGEST = 2.0**32
TOLERANCE = 1e-15
NOTHING = 1e-13
FAN = 64


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, x`` (array of longs) of the usable rows of the usual length."""
    c = F.col(vec_col).cast("array<double>")
    fine = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), c.alias("c"))
    rows = rows.filter(F.col("c").isNotNull() & (F.size("c") > 0) & F.coalesce(fine, F.lit(False)))
    rows = common.stored(rows.select("id", F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT).alias("x")))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return rows.filter(F.size("x") == usual["d"]) if usual else rows.limit(0)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(rows: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all rows of ``part(x)``, ``size`` doubles, in an order that the partitions fix."""

    def run(batches):
        total, pid = np.zeros(size), None
        for batch in batches:
            if len(batch):
                pid = batch.column("pid")[0].as_py()
                total += part(batch)
        if pid is not None:
            yield pa.RecordBatch.from_pydict({"pid": pa.array([pid], pa.int32()), "s": pa.array([total.tolist()], pa.list_(pa.float64()))})

    def add(pdf):
        import pandas as pd

        pdf = pdf.sort_values("pid")
        return pd.DataFrame({"g": [int(pdf["pid"].iloc[0]) // FAN], "s": [np.sum(np.stack(pdf["s"].to_list()), axis=0)]})

    parts = rows.withColumn("pid", F.spark_partition_id()).mapInArrow(run, "pid int, s array<double>")
    groups = parts.groupBy(F.floor(F.col("pid") / FAN)).applyInPandas(add, "g int, s array<double>")
    # One row of ``size`` numbers for FAN partitions.
    got = sorted(groups.collect(), key=lambda r: r.g)
    return np.sum([np.array(r.s) for r in got], axis=0) if got else np.zeros(size)


@dataclass
class Fit:
    """``mean`` is total / n; ``components`` has a unit column each, ``values`` their variances."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, each entry rounded once: n x - S is whole."""
        return _centred(x, self.n, self.total)


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    limit = n * (int(np.abs(x).max()) if x.size else 0) + max(map(abs, total))
    if limit < 2**62:
        return (n * x - np.array(total, np.int64)) / n
    exact = n * x.astype(object) - np.array(total, object)
    return (exact / n).astype(float)


def _exact_totals(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of their entries: high and low halves are summed as longs."""

    def run(batches):
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            x = _matrix(batch, dims)
            high += (x >> 24).sum(axis=0)
            low += (x & 0xFFFFFF).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(dims + 1), pa.int32()), "high": pa.array([*high, n], pa.int64()),
                                          "low": pa.array([*low, 0], pa.int64())})

    got = rows.mapInArrow(run, "k int, high long, low long").groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    by = {r.k: (r.high, r.low) for r in got.collect()}
    return by[dims][0], [(by[k][0] << 24) + by[k][1] for k in range(dims)]


def bidiagonalise(rows: DataFrame, n: int, total: list[int], wanted: int, trace: float,
                  tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Right vectors V (dimensions x steps), and diagonal and upper diagonal of B, for the centred rows."""
    dims = len(total)
    rng = np.random.default_rng(dims)

    def orthogonal(w: np.ndarray, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            w = w - v @ (v.T @ w)
        return w

    v = np.zeros((dims, 0))
    short = np.zeros((dims, 0))  # u_j = X short_j
    image = np.zeros((dims, 0))  # X'u_j
    alphas, betas = [], []
    energy = trace * n
    scale = np.sqrt(energy)
    fresh, beta = rng.standard_normal(dims), 0.0
    while v.shape[1] < dims:
        nxt = orthogonal(fresh, v)
        v = np.column_stack((v, nxt / np.sqrt(nxt @ nxt)))
        k = v.shape[1] - 1
        ask = v[:, k] - (beta * short[:, -1] if k else 0.0)

        def part(batch, ask=ask, short=short):
            x = _centred(_matrix(batch, dims), n, total)
            u = x @ ask
            return np.concatenate((x.T @ u, (x @ short).T @ u, [u @ u]))

        got = _sums(rows, part, dims + k + 1)
        z, c, square = got[:dims], got[dims:dims + k], got[-1]
        # u against all earlier u; what is taken out is of rounding size, so the sums follow.
        z, ask, square = z - image @ c, ask - short @ c, square - c @ c
        alpha = np.sqrt(max(square, 0.0))
        if alpha <= NOTHING * scale:  # v lies in the null space: nothing to find along it
            alphas.append(0.0)
            short, image = np.column_stack((short, np.zeros(dims))), np.column_stack((image, np.zeros(dims)))
            fresh, beta = rng.standard_normal(dims), 0.0
            betas.append(0.0)
            continue
        alphas.append(alpha)
        short, image = np.column_stack((short, ask / alpha)), np.column_stack((image, z / alpha))
        fresh = orthogonal(image[:, -1] - alpha * v[:, k], v)
        beta = float(np.sqrt(fresh @ fresh))
        if beta <= NOTHING * scale:
            fresh, beta = rng.standard_normal(dims), 0.0
        betas.append(beta)
        left, s, _ = np.linalg.svd(_bidiagonal(alphas, betas))
        if len(s) >= wanted:
            settled = beta * np.abs(left[-1, :wanted]) <= tolerance * s[0]
            seen = float(np.square(alphas).sum() + np.square(betas[:-1]).sum())
            if settled.all() and energy * (1 + 1e-12) - seen < s[wanted - 1] ** 2 and beta > 0.0:
                break
    return v, np.array(alphas), np.array(betas)


def _bidiagonal(alphas, betas) -> np.ndarray:
    return np.diag(np.array(alphas)) + np.diag(np.array(betas[:len(alphas) - 1]), 1)


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> Fit | None:
    """Mean, leading components and variances of ``x``; None without rows or without variance."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    dims = first["d"]
    n, total = _exact_totals(rows, dims)

    def squares(batch):
        x = _centred(_matrix(batch, dims), n, total)
        return np.array([(x * x).sum()])

    trace = float(_sums(rows, squares, 1)[0]) / n
    if trace <= 0.0:
        return Fit(n, total, np.zeros((dims, 0)), np.zeros(0), 0.0)
    wanted = min(wanted, dims)
    v, alphas, betas = bidiagonalise(rows, n, total, wanted, trace)
    _, s, right = np.linalg.svd(_bidiagonal(alphas, betas))
    good = s[:wanted] > NOTHING * np.sqrt(trace * n)
    comps = (v @ right.T)[:, :wanted][:, good]
    comps /= np.sqrt((comps * comps).sum(axis=0))
    # The largest entry of a component is positive.
    comps *= np.sign(comps[np.abs(comps).argmax(axis=0), np.arange(comps.shape[1])])
    return Fit(n, total, comps, s[:wanted][good] ** 2 / n, trace)


def _whitened(x: np.ndarray, model: Fit) -> np.ndarray:
    return model.centred(x) @ model.components / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    dims, k = model.components.shape

    def part(batch):
        w = _whitened(_matrix(batch, dims), model)
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    got = _sums(rows, part, k + k * k)
    mean = got[:k] / model.n
    return float(np.abs(got[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exactly."""
    reach = n * (int(np.abs(x).max()) if x.size else 0) + max(map(abs, total))
    if reach < 2**62:
        y = n * x - np.array(total, np.int64)
        if int(np.abs(y).max()) ** 2 * x.shape[1] < 2**63:
            return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - np.array(total, object)
    return [d if d < 2**63 else None for d in (y * y).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per usable row and component."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = scaled(vectors, id_col, vec_col)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    dims, k = model.components.shape
    share = (model.values / model.trace).tolist()

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch, dims)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("id").take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, model.n, np.int64)),
                "deviation": pa.array(_deviations(x, model.n, model.total), pa.int64()).take(pa.array(each)),
                "whitened": pa.array(_whitened(x, model).ravel()),
                "explained": pa.array(share * m, pa.float64()),
                "identity_error": pa.array(np.full(m * k, error))})

    return rows.mapInArrow(run, schema)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """All usable embeddings projected on their 8 leading components, scaled to unit variance."""
    return whiten(common.table(spark, sf_dir, "embeddings"))
