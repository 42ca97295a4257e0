"""LM scoring by a log-bilinear neural model with noise-contrastive estimation.

Texts are tokens (words, ASCII lower case) and one end. Counts of all
training tokens give the unigram base and the model's classes, in two levels:
the ``CLASSES`` most frequent tokens and ``GROUPS`` groups of the others (by
their last two bytes), then the buckets of a group (by a hash of the token),
whose number grows with the square root of the distinct tokens. A context is
the two tokens before, each with an embedding (that of its bucket for tokens
outside the classes); the prediction vector is their sum, weighted by
position, and a logit its product with the vector of the class or bucket
plus a bias. Training contrasts each token of every training text with
``NOISE`` draws from the classes and ``INNER_NOISE`` from its group's
buckets, in numpy: each task trains on its texts, the tasks' parameters are
averaged by tokens, in ``ROUNDS`` rounds over different texts.

Scoring normalises over all classes, once a worker for the pairs of frequent
contexts and once a chunk for each other distinct context, and over the buckets
of a token's group; within
its bucket a token has its smoothed share of the counts. Empty buckets have no
probability; an unknown token has that of the base, the known ones share the
rest. So the probabilities of all known tokens and one unknown token add up to
one.

One pass turns the texts, in place, into chunks of about ``SCORE_CHUNK`` bytes:
their token numbers, compressed, and one row per distinct token with its
occurrences in training texts. These rows give the counts, the counts are
joined to them, and both meet the chunk's numbers again, so text is shuffled
never, counts are never broadcast, and a frequent token brings one row a chunk.
A text longer than a chunk is a chunk by itself, scored in steps.

Null and empty texts are the end token alone. Without training texts the
base is 0 for every token and the model's score equals it. Rows that repeat
are scored alike (and count in training as often as they occur).
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common, suffixes

CLASSES = 1000
GROUPS = 64
#: Buckets for each square root of the distinct tokens.
BUCKETS = 4
CONTEXT = 2
DIM = 24
NOISE = 64
INNER_NOISE = 16
#: Rows of a group that meet its noise in one product.
SIDE = 32
BATCH = 4096
ROUNDS = 2
RATE = 0.15
#: Contexts whose pairs' normalisers are taken once a Python worker, for all its chunks.
PAIRED = 3000
#: Rows of a product in scoring.
BLOCK = 512
CHUNK = 6_000_000
#: Text of one scoring chunk.
SCORE_CHUNK = 9_000_000
SMOOTHING = 0.1  # fixed by the contract
#: The end of a text; holds a space, as no word does.
END = b" "
LN10 = float(np.log(10.0))


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token numbers of all texts end to end, each text's first place (one more at the end), and the distinct tokens."""
    words, at = suffixes.split(texts, suffixes.PRINTED, lower=True)
    numbers, distinct = suffixes.numbered(words)
    numbers, bounds = suffixes.closed(numbers, at, np.full(len(at) - 1, len(distinct)))
    return numbers, bounds, pa.concat_arrays([distinct, pa.array([END], pa.large_binary())])


def group_size(distinct: int) -> int:
    """Buckets of a group."""
    return max(1, int(np.ceil(BUCKETS * np.sqrt(distinct) / GROUPS)))


def bucket(word: bytes, groups: int, size: int) -> int:
    tail = word[-2:]
    return (tail[0] * 31 + tail[-1]) % groups * size + zlib.crc32(word) % size


#: CRC-32 of each byte, for the words of a batch at once.
_CRC = np.array([zlib.crc32(bytes([b])) ^ 0xFF000000 for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0") ^ 0xFF000000)
#: Words longer than this are hashed one by one.
_LONG = 64


def buckets(words: pa.Array, groups: int, size: int) -> np.ndarray:
    """``bucket`` of many words (large_binary, none empty)."""
    if not len(words):
        return np.zeros(0, np.int64)
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data, start, n = np.frombuffer(words.buffers()[2], np.uint8), at[:-1], np.diff(at)
    crc = np.full(len(n), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(n <= _LONG)
    for k in range(_LONG):
        live = live[n[live] > k]
        if not len(live):
            break
        own = crc[live]
        crc[live] = _CRC[(own ^ data[start[live] + k]) & 255] ^ (own >> np.uint32(8))
    crc = ~crc
    for i in np.flatnonzero(n > _LONG):
        crc[i] = zlib.crc32(words[int(i)].as_py())
    first, last = data[at[1:] - np.minimum(n, 2)].astype(np.int64), data[at[1:] - 1].astype(np.int64)
    return (first * 31 + last) % groups * size + crc.astype(np.int64) % size


def count_buckets(counts: DataFrame, words: list[bytes], size: int) -> np.ndarray:
    """Smoothed counts by bucket of the tokens that are not ``words``."""
    def run(batches):
        mass, top = np.zeros(GROUPS * size), pa.array(words, pa.large_binary())
        for batch in batches:
            found = batch.column("word").cast(pa.large_binary())
            rest = pc.is_null(pc.index_in(found, value_set=top))
            c = batch.column("c").filter(rest).to_numpy(zero_copy_only=False)
            mass += np.bincount(buckets(found.filter(rest), GROUPS, size), c + SMOOTHING, len(mass))
        at = np.flatnonzero(mass)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "mass": pa.array(mass[at], pa.float64())})

    found = counts.mapInArrow(run, "bucket long, mass double").groupBy("bucket").agg(F.sum("mass").alias("mass")).collect()
    out = np.zeros(GROUPS * size)
    for r in found:  # grows with the square root of the distinct tokens
        out[r["bucket"]] = r["mass"]
    return out


@dataclass(eq=False)
class Model:
    """``words`` are the classes' tokens; parameters in ``p``; totals of the counts; smoothed counts by group and bucket."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    p: dict[str, np.ndarray]
    mass: np.ndarray
    #: Of ``with_norms``: context ids' places (-1: none) in a table of normalisers, one token back by two.
    place_of: np.ndarray | None = None
    norms: np.ndarray | None = None

    def __post_init__(self):
        self.place = {w: i for i, w in enumerate(self.words)}
        self.listed = pa.array(self.words, pa.large_binary())
        self.base_mass = self.total + SMOOTHING * (self.distinct + 1)
        self.other_mass = self.base_mass - float((self.counts + SMOOTHING).sum())
        shut = lambda m: np.where(m > 0, 0, -1e30).astype(np.float32)
        self.shut = np.append(np.zeros(len(self.words), np.float32), shut(self.mass.sum(axis=1)))
        self.inner_shut = shut(self.mass)

    @property
    def classes(self) -> int:
        return len(self.words) + len(self.mass)

    @property
    def start(self) -> int:
        """Context id before a text's first token."""
        return len(self.words) + self.mass.size

    def ids(self, word: bytes) -> tuple[int, int]:
        """Output id (class, or the number of classes' tokens plus the bucket) and context id of a known token."""
        k = self.place.get(word)
        if k is None:
            k = len(self.words) + bucket(word, *self.mass.shape)
        return k, k

    def ids_of(self, words: pa.Array) -> np.ndarray:
        """``ids`` of many tokens; output and context id are the same."""
        out = pc.index_in(words, value_set=self.listed).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = np.flatnonzero(out < 0)
        groups, size = self.mass.shape
        out[rest] = len(self.words) + buckets(words.take(pa.array(rest)), groups, size)
        return out

    def levels(self, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of output ids; the places of those in groups, and their buckets."""
        inner = np.flatnonzero(out >= len(self.words))
        buckets = out[inner] - len(self.words)
        cls = out.copy()
        cls[inner] = len(self.words) + buckets // self.mass.shape[1]
        return cls, inner, buckets

    def contexts(self, ctx: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
        """Context ids one, two ... tokens back; ``begins`` are the texts' first places."""
        out, prev = [], ctx
        for _ in range(CONTEXT):
            prev = np.concatenate(([self.start], prev[:-1]))
            prev[begins] = self.start
            out.append(prev)
        return out

    def predict(self, back: list[np.ndarray]) -> np.ndarray:
        return sum(self.p["at"][j] * self.p["context"].take(c, axis=0) for j, c in enumerate(back))


def new_model(words: list[bytes], counts: list[int], total: int, distinct: int, seed: int = 0, mass: np.ndarray | None = None) -> Model:
    """``mass``: of ``count_buckets``; without it all other tokens are one bucket."""
    rng = np.random.default_rng(seed)
    c = np.array(counts, float)
    if mass is None:
        mass = np.array([total + SMOOTHING * distinct - (c + SMOOTHING).sum()])
    mass = mass.reshape(min(GROUPS, len(mass)), -1)
    share = np.append(c, np.maximum(mass.sum(axis=1), 0.5)) / max(total, 1)
    inner = np.maximum(mass, SMOOTHING) / np.maximum(mass, SMOOTHING).sum(axis=1, keepdims=True)
    p = {"context": rng.normal(0, 0.2, (len(words) + mass.size + 1, DIM)), "at": np.ones((CONTEXT, DIM)),
         "word": rng.normal(0, 0.2, (len(words) + len(mass), DIM)), "bias": np.log(share),
         "inner": rng.normal(0, 0.2, (mass.size, DIM)), "inner_bias": np.log(inner).reshape(-1)}
    return Model(words, c, total, distinct, {k: v.astype(np.float32) for k, v in p.items()}, mass)


def _distinct(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, all below ``size``, in order, and the place among them of each id."""
    seen = np.zeros(size, bool)
    seen[ids] = True
    found = np.flatnonzero(seen)
    place = np.empty(size, np.intp)
    place[found] = np.arange(len(found))
    return found, place.take(ids)


def _add_rows(out: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
    """Adds each of ``rows`` to the row ``at`` of ``out``; both are contiguous, in single precision, of the same even width.

    Numpy adds fastest at flat places, and two columns as one complex number.
    """
    width = out.shape[1] // 2
    places = (at[:, None] * width + np.arange(width)).reshape(-1)
    np.add.at(out.reshape(-1).view(np.complex64), places, rows.reshape(-1).view(np.complex64))


def _chance(negative: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-logit)) from -logit, in place; a logit far below zero gives zero."""
    with np.errstate(over="ignore"):
        np.exp(negative, out=negative)
    negative += 1.0
    return np.reciprocal(negative, out=negative)


class Trainer:
    """Stochastic gradient steps on one task's texts."""

    def __init__(self, model: Model, seed: int):
        self.model = model
        self.p = model.p = {k: v.copy() for k, v in model.p.items()}
        self.square = {k: np.full_like(v, 0.1) for k, v in self.p.items()}
        self.rng = np.random.default_rng(seed)
        share = np.append(model.counts, model.mass.sum(axis=1))
        self.noise = share / share.sum()
        self.log_noise = np.log(NOISE * np.maximum(self.noise, 1e-30)).astype(np.float32)
        self.cumulative = np.cumsum(self.noise)
        # Group g's buckets fill the places from g to g + 1.
        mass = model.mass / np.maximum(model.mass.sum(axis=1, keepdims=True), 1e-30)
        self.inner_cumulative = (np.cumsum(mass, axis=1) + np.arange(len(mass))[:, None]).reshape(-1)
        self.inner_log_noise = np.log(INNER_NOISE * np.maximum(mass, 1e-30)).reshape(-1).astype(np.float32)
        self.tokens = 0

    def texts(self, texts: pa.Array | list[str | None]) -> None:
        numbers, bounds, distinct = coded(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        ids = self.model.ids_of(distinct)[numbers]
        back = self.model.contexts(ids, bounds[:-1])
        order = self.rng.permutation(len(ids))
        for k in range(0, len(order), BATCH):
            some = order[k:k + BATCH]
            self.step(ids[some], [b[some] for b in back])
        self.tokens += len(ids)

    def step(self, target: np.ndarray, back: list[np.ndarray]) -> None:
        p, n = self.p, len(target)
        scale = np.float32(-1.0 / n)
        target, inner, buckets = self.model.levels(target)
        drawn = np.searchsorted(self.cumulative, self.rng.random(NOISE), side="right").clip(max=len(self.noise) - 1)
        parts = [p["context"].take(c, axis=0) for c in back]
        r = sum(p["at"][j] * c for j, c in enumerate(parts))
        wt, wn = p["word"].take(target, axis=0), p["word"].take(drawn, axis=0)
        st = (self.log_noise - p["bias"]).take(target) - np.einsum("nd,nd->n", r, wt)
        sn = r @ -wn.T
        sn += self.log_noise[drawn] - p["bias"][drawn]
        # Derivatives of the objective by the logits: data rows up, noise rows down (these n times too large).
        gt, gn = (1.0 - _chance(st)) / n, _chance(sn)
        dr = gn @ (wn * scale)
        wt *= gt[:, None]
        dr += wt
        g = {"word": np.zeros_like(p["word"]), "at": np.empty_like(p["at"]),
             "bias": np.bincount(target, gt, len(p["bias"])) + np.bincount(drawn, (np.ones(n, np.float32) @ gn) * scale, len(p["bias"]))}
        _add_rows(g["word"], gt[:, None] * r, target)
        _add_rows(g["word"], (gn.T @ r) * scale, drawn)
        if len(inner) and self.model.mass.shape[1] > 1:
            dr[inner] += self.inner_step(r.take(inner, axis=0), buckets, n)
        found, place = _distinct(np.concatenate(back), len(p["context"]))
        sums = np.zeros((len(found), dr.shape[1]), np.float32)
        for j, c in enumerate(parts):
            g["at"][j] = np.einsum("nd,nd->d", dr, c)
            _add_rows(sums, dr * p["at"][j], place[j * n:(j + 1) * n])
        self.add("context", found, sums, n)
        for k, v in g.items():
            self.add(k, None, v, n)

    def inner_step(self, r: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """The step of the buckets within their groups, with noise drawn once a group; the derivative by ``r``."""
        p, (groups, size) = self.p, self.model.mass.shape
        order = np.argsort((buckets // size).astype(np.uint16), kind="stable")
        r, buckets = r.take(order, axis=0), buckets.take(order)
        own = np.bincount(buckets // size, minlength=groups)
        wt = p["inner"].take(buckets, axis=0)
        gt = (1.0 - _chance((self.inner_log_noise - p["inner_bias"]).take(buckets) - np.einsum("nd,nd->n", r, wt))) / n
        first = np.arange(groups)[:, None]
        drawn = np.searchsorted(self.inner_cumulative, first + self.rng.random((groups, INNER_NOISE)), side="right")
        drawn = drawn.clip(first * size, first * size + size - 1)
        # A group's rows fill lines of SIDE places; the noise of places left empty counts nothing.
        lines = -(-own // SIDE)
        place = np.arange(len(r)) + np.repeat((np.cumsum(lines) - lines) * SIDE - (np.cumsum(own) - own), own)
        drawn = drawn[np.repeat(np.arange(groups), lines)]
        wn, bn = p["inner"].take(drawn, axis=0), self.inner_log_noise[drawn] - p["inner_bias"][drawn]
        side, scale = np.zeros((len(drawn) * SIDE, r.shape[1]), np.float32), np.zeros(len(drawn) * SIDE, np.float32)
        side[place], scale[place] = r, -1.0 / n
        side = side.reshape(len(drawn), SIDE, -1)
        gn = side @ wn.transpose(0, 2, 1)
        gn = _chance(np.subtract(bn[:, None], gn, out=gn))
        gn *= scale.reshape(len(drawn), SIDE, 1)
        # Sums of vectors and, in the last two columns, of biases and nothing.
        found, at = _distinct(np.concatenate([buckets, drawn.reshape(-1)]), len(p["inner"]))
        sums, rows = np.zeros((len(found), r.shape[1] + 2), np.float32), np.zeros((len(at), r.shape[1] + 2), np.float32)
        np.multiply(gt[:, None], r, out=rows[:len(r), :-2])
        rows[:len(r), -2] = gt
        rows[len(r):, :-2] = (gn.transpose(0, 2, 1) @ side).reshape(-1, r.shape[1])
        rows[len(r):, -2] = gn.sum(axis=1).reshape(-1)
        _add_rows(sums, rows, at)
        wt *= gt[:, None]
        wt += (gn @ wn).reshape(-1, r.shape[1]).take(place, axis=0)
        self.add("inner", found, sums[:, :-2], n)
        self.add("inner_bias", found, sums[:, -2], n)
        back = np.empty_like(wt)
        back[order] = wt
        return back

    def add(self, name: str, rows: np.ndarray | None, v: np.ndarray, n: int) -> None:
        """A step along ``v``, of the given rows or all."""
        v = v.astype(np.float32) * np.float32(np.sqrt(n))
        square = self.square[name] if rows is None else self.square[name].take(rows, axis=0)
        square += v * v
        v *= np.float32(RATE)
        v /= np.sqrt(square)
        if rows is None:
            self.p[name] += v
        else:
            self.square[name][rows] = square
            v += self.p[name].take(rows, axis=0)
            self.p[name][rows] = v


def _packed(p: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)]).astype("<f8").tobytes()


def _unpacked(data: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = data[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(texts: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """Train on every text once: round r takes the rows whose ``part`` column modulo ``rounds`` is r."""
    spark = texts.sparkSession
    for r in range(rounds):
        shipped = spark.sparkContext.broadcast(model)  # bounded by the number of classes and buckets

        def run(batches, shipped=shipped, r=r):
            own = shipped.value
            trainer = Trainer(replace(own), seed=r)
            for batch in common.chunks(batches, "text", CHUNK):
                trainer.texts(batch.column("text"))
            if trainer.tokens:
                weighted = np.frombuffer(_packed(trainer.p), "<f8") * trainer.tokens
                yield pa.RecordBatch.from_pydict({"tokens": pa.array([trainer.tokens], pa.int64()),
                                                  "sums": pa.array([weighted.tobytes()], pa.binary())})

        def add(batches):
            tokens, total = 0, None
            for batch in batches:
                for n, s in zip(batch.column("tokens").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    x = np.frombuffer(s, "<f8")
                    tokens, total = tokens + n, x.copy() if total is None else total + x
            if tokens:
                yield pa.RecordBatch.from_pydict({"tokens": pa.array([tokens], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

        part = texts.filter(F.pmod(F.col("part"), F.lit(rounds)) == r).select("text")
        # The tasks' sums meet in 16 partial sums; only those come to the driver.
        sums = part.mapInArrow(run, "tokens long, sums binary").repartition(16).mapInArrow(add, "tokens long, sums binary")
        rows = sums.collect()
        tokens = sum(x["tokens"] for x in rows)
        if tokens:
            mean = sum(np.frombuffer(x["sums"], "<f8") for x in rows) / tokens
            model = replace(model, p=_unpacked(mean, model.p))
    return model


def _reach(p: dict[str, np.ndarray], weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no logit, whatever the context, can leave the range of exp in single precision."""
    longest = sum(np.sqrt(np.square(p["context"] * a).sum(axis=1).max()) for a in p["at"])
    return longest * np.sqrt(np.square(weights).sum(axis=1).max()) + np.abs(bias[bias > -1e29]).max(initial=0) < 60


def _log_sums(vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray, safe: bool = False) -> np.ndarray:
    """Logarithm of the sum over all classes of exp(logit), for each vector; ``safe``: see ``_reach``.

    Logits are summed in double precision: a product's single precision
    depends on the row's place, and equal texts are to score alike.
    """
    out = np.empty(len(vectors))
    # The bias is one more row of the product, which a last entry of one picks.
    columns, ones = np.concatenate((weights.T, bias[None])).astype(np.float64), np.ones(len(weights), np.float32)
    own = np.zeros((BLOCK, vectors.shape[1] + 1))
    own[:, -1] = 1.0
    wide, logit = np.empty((BLOCK, len(weights))), np.empty((BLOCK, len(weights)), np.float32)
    for k in range(0, len(vectors), BLOCK):
        some = vectors[k:k + BLOCK]
        own[:len(some), :-1] = some
        logit[:] = np.matmul(own, columns, out=wide)
        top = np.zeros(BLOCK)
        if not safe:
            top = logit.max(axis=1)
            logit -= top[:, None]
        out[k:k + BLOCK] = (top + np.log((np.exp(logit, out=logit) @ ones).astype(np.float64)))[:len(some)]
    return out


def _tables(model: Model, live: list[np.ndarray], bias: np.ndarray, block: int):
    """By blocks of classes, exp of what a context one and two ... tokens back gives to the logits, a row for each context id.

    A logit is the sum of what either token gives, so its exp is a product:
    exp is taken once a token and class, not once a pair and class. Rows in
    blocks without a ``live`` id are left empty; a row's place in a product
    follows from its id, so it is rounded alike for every chunk.
    """
    p, size, parts = model.p, model.start + 1, []
    for at in p["at"]:
        part = np.zeros((-(-size // BLOCK) * BLOCK, DIM), np.float32)
        np.multiply(p["context"], at, out=part[:size])
        parts.append(part)
    used = [[k for k in range(0, size, BLOCK) if own[k:k + BLOCK].any()] for own in live]
    for b in range(0, len(bias), block):
        weights = np.ascontiguousarray(p["word"][b:b + block].T)
        out = [np.empty((len(part), weights.shape[1]), np.float32) for part in parts]
        for j, table in enumerate(out):
            for k in used[j]:
                np.matmul(parts[j][k:k + BLOCK], weights, out=table[k:k + BLOCK])
                rows = table[k:min(k + BLOCK, size)]
                if j == 0:
                    rows += bias[b:b + block]
                np.exp(rows, out=rows)
        yield out


def _pair_log_sums(model: Model, found: np.ndarray, bias: np.ndarray, block: int = 256, step: int = 512) -> np.ndarray | None:
    """``_log_sums`` over the classes for pairs of context tokens, sorted; None if exp could leave its range."""
    size = model.start + 1
    if not _reach(model.p, model.p["word"], bias):
        return None
    each = [found // size**j % size for j in range(CONTEXT)]
    sums = np.zeros(len(found))
    for one, two in _tables(model, [np.bincount(c, minlength=size) > 0 for c in each], bias, block):
        for k in range(0, len(found), step):
            some = slice(k, k + step)
            sums[some] += np.einsum("ij,ij->i", one.take(each[0][some], axis=0), two.take(each[1][some], axis=0))
    return np.log(sums)


@functools.lru_cache(maxsize=1)
def with_norms(model: Model, most: int = PAIRED) -> Model:
    """The trained model with the normalisers of all pairs of its ``most`` most frequent contexts.

    Taken once a Python worker, for all its chunks, so that the table is never shipped.
    """
    bias = model.p["bias"] + model.shut
    if not _reach(model.p, model.p["word"], bias):
        return model
    often = np.argsort(-np.concatenate([[np.inf], model.counts, model.mass.reshape(-1)]), kind="stable")[:most] - 1
    often[0] = model.start
    place = np.full(model.start + 1, -1)
    place[often] = np.arange(len(often))
    made = [[table.take(often, axis=0) for table in tables] for tables in _tables(model, [place >= 0] * CONTEXT, bias, 256)]
    one, two = (np.concatenate(parts, axis=1) for parts in zip(*made, strict=True))
    sums = one @ two.T
    return replace(model, place_of=place, norms=np.log(sums, out=sums))


def _norms(model: Model, back: list[np.ndarray], bias: np.ndarray, step: int) -> np.ndarray:
    """``_log_sums`` over the classes for each token's context."""
    out, rest, size = np.empty(len(back[0])), np.arange(len(back[0])), model.start + 1
    if model.norms is not None:
        one, two = (model.place_of.take(c) for c in back)
        listed = (one >= 0) & (two >= 0)
        out[listed] = model.norms[one[listed], two[listed]]
        rest = np.flatnonzero(~listed)
    if not len(rest):
        return out
    # Every other context once, in order.
    key = sum(c.take(rest) * size**j for j, c in enumerate(back))
    turn = np.argsort(key)
    key = key.take(turn)
    head = np.append(True, key[1:] != key[:-1])
    found = key[head]
    norm = _pair_log_sums(model, found, bias)
    if norm is None:
        norm = np.concatenate([_log_sums(model.predict([found[k:k + step] // size**j % size for j in range(CONTEXT)]), model.p["word"], bias)
                               for k in range(0, len(found), step)])
    out[rest.take(turn)] = norm.take(np.cumsum(head) - 1)
    return out


def log_probabilities(model: Model, cls: np.ndarray, ctx: np.ndarray, begins: np.ndarray, step: int = 50 * BLOCK) -> np.ndarray:
    """Normalised natural log-probability of each token's class (and bucket in it), given the two tokens before it."""
    p = model.p
    cls, inner, buckets = model.levels(cls)
    bias = p["bias"] + model.shut
    back = model.contexts(ctx, begins)
    out = -_norms(model, back, bias, step)
    for k in range(0, len(cls), step):
        some = slice(k, k + step)
        own = cls[some]
        out[some] += np.einsum("ij,ij->i", model.predict([c[some] for c in back]), p["word"].take(own, axis=0)) + bias.take(own)
    groups, size = model.mass.shape
    if size == 1:
        return out
    vectors_of, inner_bias = p["inner"].reshape(-1, size, DIM), p["inner_bias"].reshape(-1, size) + model.inner_shut
    safe = _reach(p, p["inner"], inner_bias.reshape(-1))
    order = np.argsort((buckets // size).astype(np.uint16), kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(buckets // size, minlength=groups)))
    for g in np.flatnonzero(np.diff(ends)):
        for k in range(ends[g], ends[g + 1], step):
            some = order[k:min(k + step, ends[g + 1])]
            own, at = model.predict([c.take(inner.take(some)) for c in back]), buckets.take(some) - g * size
            logit = np.einsum("ij,ij->i", own, vectors_of[g].take(at, axis=0)) + inner_bias[g].take(at)
            out[inner[some]] += logit - _log_sums(own, vectors_of[g], inner_bias[g], safe)
    return out


def score_tokens(model: Model | None, numbers: np.ndarray, bounds: np.ndarray, ids: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of texts given as token numbers; ``ids`` (``Model.ids``) and counts ``c`` of the distinct tokens."""
    begins = bounds[:-1]
    total, distinct = (model.total, model.distinct) if model else (0, 0)
    base = np.log10((c + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))[numbers]
    score = base
    if model:
        unknown = c == 0
        share = np.zeros(len(c))  # of a token in its bucket
        other = ~unknown & (ids >= len(model.words))
        share[other] = np.log10((c[other] + SMOOTHING) / model.mass.reshape(-1)[ids[other] - len(model.words)])
        score = log_probabilities(model, np.where(unknown, 0, ids)[numbers], ids[numbers], begins) / LN10 + share[numbers]
        score = np.where(unknown[numbers], base, score + np.log10(1 - SMOOTHING / model.base_mass))
    return {"n_tokens": np.diff(bounds), "n_known": np.add.reduceat((c > 0).astype(np.int64)[numbers], begins),
            "train_tokens": np.full(len(begins), total, np.int64),
            "base_score": np.add.reduceat(base, begins), "score": np.add.reduceat(score, begins)}


def score_chunk(model: Model | None, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    """Scores of documents; ``words`` holds the count of each of their tokens."""
    numbers, bounds, distinct = coded(pa.array(docs["text"], pa.string()))
    known = dict(zip(map(bytes, words["word"]), words["c"], strict=True))
    c = np.array([known[w] for w in distinct.to_pylist()], np.float64)
    ids = model.ids_of(distinct) if model else np.zeros(len(c), np.int64)
    return pd.DataFrame({"doc_id": docs["doc_id"], "held_out": docs["held_out"], **score_tokens(model, numbers, bounds, ids, c)})


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: A chunk's row holds its documents and compressed token numbers; its other rows a distinct token each.
_CHUNKS = "chunk long, at int, word binary, n long, ids array<long>, held array<boolean>, bounds array<long>, numbers binary"
_TOKEN = {"at": pa.int32(), "word": pa.binary(), "n": pa.int64()}
_CHUNK = {"ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "bounds": pa.list_(pa.int64()), "numbers": pa.binary()}


def chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """The texts of ``rows`` as chunks of token numbers and their distinct tokens, as a table in the shared folder."""

    def run(batches):
        for k, batch in enumerate(common.chunks(batches, "text", chunk)):
            name = batch.column("pid")[0].as_py() << 32 | k
            numbers, bounds, words = coded(batch.column("text"))
            learn = ~np.array(batch.column("held_out").to_pylist(), bool)
            n = np.bincount(numbers[np.repeat(learn, np.diff(bounds))], minlength=len(words))
            packed = pa.compress(numbers.astype("<i4").tobytes(), "zstd", asbytes=True)
            one = {"ids": [batch.column("doc_id").to_pylist()], "held": [batch.column("held_out").to_pylist()],
                   "bounds": [bounds.tolist()], "numbers": [packed]}
            for fields, size in (({"at": np.arange(len(words), dtype=np.int32), "word": words.cast(pa.binary()), "n": n}, len(words)), (one, 1)):
                columns = {"chunk": pa.array(np.full(size, name, np.int64))}
                for c, t in (_TOKEN | _CHUNK).items():
                    columns[c] = pa.array(fields[c], t) if c in fields else pa.nulls(size, t)
                yield pa.RecordBatch.from_pydict(columns)

    return common.stored(rows.withColumn("pid", F.spark_partition_id()).mapInArrow(run, _CHUNKS))


def scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES,
           chunk: int = SCORE_CHUNK) -> DataFrame:
    """One row per input row (see ``SCORES``), learned from the rows where ``held`` is false."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = common.texts(docs, id_col, text_col, held.alias("held_out"), F.crc32(F.col(id_col).cast("string")).alias("part"))
    rows = rows.withColumn("part", F.floor(F.coalesce("part", F.lit(0)) / 16))
    table = chunked(rows.select("doc_id", "held_out", "text"), chunk)
    tokens = table.filter(F.col("at").isNotNull())
    counts = common.stored(tokens.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    model = None
    if total:
        top = counts.orderBy(F.col("c").desc(), "word").limit(classes).collect()
        words = [bytes(r["word"]) for r in top]
        mass = count_buckets(counts, words, group_size(distinct))
        model = train(rows.filter(~F.col("held_out")), new_model(words, [r["c"] for r in top], total, distinct, mass=mass))
    shipped = spark.sparkContext.broadcast(model)

    def numbered(batches):
        for batch in batches:
            ids = shipped.value.ids_of(batch.column("word").cast(pa.large_binary())) if shipped.value else np.zeros(len(batch), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(ids)], names=["word", "c", "id"])

    # A known token's id travels in place of the token.
    # Hashed, not sorted: a partition's distinct tokens are its share of the counts.
    known = tokens.select(F.col("chunk").alias("of_chunk"), "at", "word").join(
        counts.mapInArrow(numbered, "word binary, c long, id long").hint("shuffle_hash"), "word", "left")
    known = known.select("of_chunk", "at", "c", "id", F.when(F.col("c").isNull(), F.col("word")).alias("word"))
    bodies = table.filter(F.col("at").isNull()).select("chunk", "ids", "held", "bounds", "numbers")

    def score(body: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("at")
        bounds = np.array(body["bounds"][0].as_py(), np.int64)
        numbers = np.frombuffer(pa.decompress(body["numbers"][0].as_py(), int(bounds[-1]) * 4, "zstd"), "<i4")
        c = words["c"].fill_null(0).to_numpy().astype(np.float64)
        ids = words["id"].fill_null(0).to_numpy().copy()
        if shipped.value:
            new = pa.concat_arrays(words["word"].chunks).cast(pa.large_binary()).drop_null()
            ids[c == 0] = shipped.value.ids_of(new)
        made = score_tokens(shipped.value and with_norms(shipped.value), numbers, bounds, ids, c)
        return pa.table({"doc_id": pa.array(body["ids"][0].as_py(), pa.int64()), "held_out": pa.array(body["held"][0].as_py(), pa.bool_()), **made})

    return bodies.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(score, SCORES)


def op7_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Every document's unigram base and model score, learned from the documents that are not held out."""
    return scores(common.table(spark, sf_dir, "documents"), common.remainder("doc_id", 10) == 0)
