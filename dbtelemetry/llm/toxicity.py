"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as its own embedding (words of the fitted vocabulary; its
first component starts as the word's log odds of toxic documents) next to
the mean of its characters' embeddings (each
character taken with the one before it, hashed). The network reads windows of
``WINDOW`` words, ``STRIDE`` apart, forwards and backwards; attention weighs
the states into one vector a window, and that gives the window's logit.
All overlapping windows of a text are scored. The text's score is a logistic
function of its largest logit, fitted on labelled documents that the network
did not see.

The network is trained in numpy on a bounded sample: at most ``TOXIC`` toxic
and ``CLEAN`` clean labelled training documents (by hash of the id), from
each toxic one the window with most evidence, from each clean one that
window and one at random.

A text without words (null, empty) scores 0. Without labels of both kinds
every text with words scores the share of toxic labels (0 without labels).
Of several labels of one id the largest counts; null labels count not.
Rows that repeat are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dbtelemetry.llm import common

WINDOW = 32
STRIDE = 16
TOXIC = 1500
CLEAN = 2500
THRESHOLD = 0.7
VOCABULARY = 8000
MIN_DOCS = 6
#: Documents that a word's odds are shrunk by towards those of all words.
SHRINK = 10
WORD_DIM = 9
CHARS = 2048
CHAR_DIM = 8
HIDDEN = 12
EPOCHS = 5
BATCH = 256
SCORE_BATCH = 2048
CHUNK = 1_500_000
CACHE_WORDS = 60_000

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def starts(n: int) -> range:
    """First words of the windows of a text with ``n`` words: all words are covered, neighbours overlap."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE) if n else range(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _char_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each character with the one before it, all words end to end, and each word's first place."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    first = np.concatenate(([0], ends[:-1])).astype(np.int64)
    before = np.roll(codes, 1)
    before[first] = 1
    return (codes * 131 + before * 7919) % CHARS, first


class Network:
    """Parameters and both passes. ``p`` maps names to arrays."""

    def __init__(self, vocab: dict[str, int], evidence: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.vocab = vocab
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        word = rng.normal(0, 0.1, (len(vocab) + 1, WORD_DIM))
        word[1:, 0] = evidence
        word[0, 0] = 0.0
        p = {"word": word, "char": rng.normal(0, 0.1, (CHARS, CHAR_DIM)), "attend": rng.normal(0, 0.1, 2 * h),
             "out": rng.normal(0, 0.3, 2 * h), "bias": np.zeros(1)}
        for side in "fb":
            p["w" + side] = rng.normal(0, d**-0.5, (d, 3 * h))
            p["u" + side] = rng.normal(0, h**-0.5, (h, 3 * h))
            p["b" + side] = np.zeros(3 * h)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input vector of each word, and what the backward pass needs of it."""
        ids = np.array([self.vocab.get(w, 0) for w in words], np.int64)
        chars, first = _char_rows(words)
        n = np.diff(np.append(first, len(chars)))
        mean = np.add.reduceat(self.p["char"][chars], first) / n[:, None]
        return np.concatenate((self.p["word"][ids], mean), axis=1).astype(np.float32), (ids, chars, n)

    def projected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["wf"] + self.p["bf"], x @ self.p["wb"] + self.p["bb"]

    def _run(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, u: np.ndarray, order, keep: bool):
        h_n = HIDDEN
        h = np.zeros((len(at), h_n), np.float32)
        states = np.zeros((at.shape[1], len(at), h_n), np.float32)
        cache = {}
        for t in order:
            g, m = gates[at[:, t]], mask[:, t:t + 1]
            v = h @ u
            zr = _sigmoid(g[:, :2 * h_n] + v[:, :2 * h_n])
            z, r = zr[:, :h_n], zr[:, h_n:]
            n = np.tanh(g[:, 2 * h_n:] + r * v[:, 2 * h_n:])
            new = n + z * (h - n)
            if keep:
                cache[t] = (h, z, r, n, v[:, 2 * h_n:])
            h = np.where(m, new, h)
            states[t] = h
        return states, cache

    def forward(self, gf: np.ndarray, gb: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logit of each window. ``at``: word places (windows x positions), -1 beyond the text's end."""
        mask = at >= 0
        place = np.where(mask, at, 0)
        n = at.shape[1]
        sf, cf = self._run(gf, place, mask, self.p["uf"], range(n), keep)
        sb, cb = self._run(gb, place, mask, self.p["ub"], range(n - 1, -1, -1), keep)
        both = np.concatenate((sf, sb), axis=2)
        a = np.where(mask.T, both @ self.p["attend"], -np.inf)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * both).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return logit, (mask, place, both, a, pooled, cf, cb)

    def gradients(self, words: list[str], at: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of windows over ``words``."""
        h_n, p = HIDDEN, self.p
        x, (ids, chars, n_chars) = self.inputs(words)
        gf, gb = self.projected(x)
        logit, (mask, place, both, a, pooled, cf, cb) = self.forward(gf, gb, at, keep=True)
        d = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["bias"][0], grad["out"] = d.sum(), d @ pooled
        d_pool = d[:, None] * p["out"]
        d_both = a[:, :, None] * d_pool
        d_a = (both * d_pool).sum(axis=2)
        d_s = a * (d_a - (a * d_a).sum(axis=0))
        grad["attend"] = np.einsum("tb,tbh->h", d_s, both)
        d_both = d_both + d_s[:, :, None] * p["attend"]
        dx = np.zeros_like(x)
        for side, cache, order, part in (("f", cf, range(at.shape[1] - 1, -1, -1), d_both[:, :, :h_n]),
                                         ("b", cb, range(at.shape[1]), d_both[:, :, h_n:])):
            u = p["u" + side]
            dh = np.zeros((len(at), h_n), np.float32)
            dg_all = np.zeros((len(words), 3 * h_n), np.float32)
            for t in order:
                h, z, r, n, vn = cache[t]
                m = mask[:, t:t + 1]
                dh = dh + part[t]
                dn = np.where(m, dh * (1 - z), 0) * (1 - n * n)
                dz = np.where(m, dh * (h - n), 0) * z * (1 - z)
                dr = dn * vn * r * (1 - r)
                dg = np.concatenate((dz, dr, dn), axis=1)
                dv = np.concatenate((dz, dr, dn * r), axis=1)
                grad["u" + side] += h.T @ dv
                np.add.at(dg_all, place[:, t], dg)
                dh = np.where(m, dh * z, dh) + dv @ u.T
            grad["w" + side] = x.T @ dg_all
            grad["b" + side] = dg_all.sum(axis=0)
            dx += dg_all @ p["w" + side].T
        np.add.at(grad["word"], ids, dx[:, :WORD_DIM])
        np.add.at(grad["char"], chars, np.repeat(dx[:, WORD_DIM:] / n_chars[:, None], n_chars, axis=0))
        return grad


def _windows(words: list[str]) -> list[list[str]]:
    return [words[s:s + WINDOW] for s in starts(len(words))]


def _places(windows: list[list[str]]) -> tuple[list[str], np.ndarray]:
    """Distinct words of the windows and their places (windows x WINDOW, -1 as padding)."""
    seen: dict[str, int] = {}
    at = np.full((len(windows), WINDOW), -1, np.int64)
    for i, w in enumerate(windows):
        at[i, :len(w)] = [seen.setdefault(x, len(seen)) for x in w]
    return list(seen), at


@dataclass
class Model:
    """A trained network and the document's logistic function, or a constant score."""

    constant: float
    network: Network | None = None
    weights: np.ndarray | None = None

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        if model.network:
            width = 3 * HIDDEN
            self.gf, self.gb = np.zeros((0, width), np.float32), np.zeros((0, width), np.float32)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Largest window logit and number of windows of each text."""
        net = self.model.network
        split = [words_of(t) for t in texts]
        if len(self.place) > CACHE_WORDS:
            self.place, self.gf, self.gb = {}, self.gf[:0], self.gb[:0]
        fresh = [w for w in set().union(*split) if w not in self.place]
        if fresh:
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            gf, gb = net.projected(net.inputs(fresh)[0])
            self.gf, self.gb = np.concatenate((self.gf, gf)), np.concatenate((self.gb, gb))
        doc, rows = [], []
        largest, count = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        size = 0

        def flush():
            at = np.concatenate(rows)
            logit, _ = net.forward(self.gf, self.gb, at)
            np.maximum.at(largest, np.concatenate(doc), logit)

        for i, words in enumerate(split):
            begin = np.array(starts(len(words)), np.int64)
            if not len(begin):
                continue
            count[i] = len(begin)
            ids = np.full(begin[-1] + WINDOW, -1, np.int64)
            ids[:len(words)] = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            for k in range(0, len(begin), SCORE_BATCH):
                some = begin[k:k + SCORE_BATCH]
                rows.append(ids[some[:, None] + np.arange(WINDOW)])
                doc.append(np.full(len(some), i))
                size += len(some)
                if size >= SCORE_BATCH:
                    flush()
                    doc, rows, size = [], [], 0
        if rows:
            flush()
        return largest, count

    def score(self, texts: list[str]) -> list[float]:
        if self.model.network is None:
            return [self.model.constant if _WORD.search(t) else 0.0 for t in texts]
        top, n = self.logits(texts)
        with np.errstate(invalid="ignore"):
            p = _sigmoid(_features(top, n) @ self.model.weights)
        return np.where(n > 0, p, 0.0).tolist()


def _features(top: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack((np.ones(len(top)), np.where(n > 0, top, 0.0)), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        s = weight * p * (1 - p)
        step = np.linalg.solve((x * s[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (weight * (y - p)) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str], toxic: list[int], share: float, seed: int = 0) -> Model:
    """Train on texts with labels; ``share`` is the share of toxic ones among all training labels."""
    label = np.array(toxic, np.float32)
    if not 0 < label.sum() < len(label):
        return Model(constant=share)
    rng = np.random.default_rng(seed)
    split = [words_of(t) for t in texts]
    own = np.arange(len(texts)) % 10 < 7  # the rest fits the document's logistic function
    seen = {1: Counter(), 0: Counter()}
    for i in np.flatnonzero(own):
        seen[int(label[i])].update(set(split[i]))
    n1, n0 = label[own].sum(), (1 - label[own]).sum()
    often = [(-(seen[1][w] + seen[0][w]), w) for w in seen[1].keys() | seen[0].keys() if seen[1][w] + seen[0][w] >= MIN_DOCS]
    vocab = {w: i + 1 for i, (_, w) in enumerate(sorted(often)[:VOCABULARY])}
    prior = n1 / (n1 + n0)
    odds = np.array([np.log((seen[1][w] + SHRINK * prior) / n1) - np.log((seen[0][w] + SHRINK * (1 - prior)) / n0) for w in vocab])
    evidence = np.clip(odds / 2, -2, 2)
    weigh = dict(zip(vocab, np.maximum(odds, 0), strict=True))
    windows, target = [], []
    for i in np.flatnonzero(own):
        all_ = _windows(split[i])
        if not all_:
            continue
        best = int(np.argmax([sum(weigh.get(w, 0) for w in x) for x in all_]))
        for k in {best} if label[i] else {best, int(rng.integers(len(all_)))}:
            windows.append(all_[k])
            target.append(label[i])
    net = Network(vocab, evidence, seed)
    target = np.array(target, np.float32)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for k in range(0, len(order), BATCH):
            some = order[k:k + BATCH]
            words, at = _places([windows[i] for i in some])
            grad = net.gradients(words, at, target[some])
            step += 1
            for name, g in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                net.p[name] -= 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    rest = np.flatnonzero(~own)
    model = Model(constant=share, network=net)
    top, n = Scorer(model).logits([texts[i] for i in rest])
    y = label[rest]
    if not 0 < y.sum() < len(y):
        return Model(constant=share)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.weights = _logistic(_features(top, n), y, weight)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN) -> Model:
    """Fit on a bounded sample of the documents labelled in ``labels``; ``learn`` is a condition on its id."""
    known = (labels.filter(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    known = known.withColumn("y", (F.col("y") > 0).cast("int"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = total.get(1, 0) / max(1, sum(total.values()))
    # The first rows by hash, at most toxic + clean of them: each task keeps no more than that many.
    chosen = {r["id"]: r["y"] for y, n in ((1, toxic), (0, clean))
              for r in known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n).collect()}
    if not chosen:
        return Model(constant=0.0)
    rows = common.texts(docs, id_col, text_col).filter(F.col("doc_id").isin(sorted(chosen)))
    # One row an id, reduced in the map tasks: repeated rows do not come to the driver.
    texts = dict(rows.groupBy("doc_id").agg(F.min("text").alias("text")).collect())
    order = sorted(texts)
    return fit([texts[i] for i in order], [chosen[i] for i in order], share)


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the text's toxicity score, 0 to 1."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary and the network's size

    def start():
        scorer = shipped.value.scorer()
        return lambda texts: {name: scorer.score(texts)}

    return common.with_columns(docs, start, [(name, T.DoubleType())], text_col, CHUNK)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of documents that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"), common.remainder("doc_id", 3) != 1)
    rows = docs.select("doc_id", (common.remainder("doc_id", 3) == 1).alias("held_out"), "text")
    out = with_toxicity(rows, model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
