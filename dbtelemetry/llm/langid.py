"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public
vocabulary. A word (a run of letters, lower-cased, with the vocabulary's
word-start mark before it) has the probability of all its segmentations
into pieces together, summed by a forward pass; a text has the product over
its words. Pieces never cross words, so each distinct word of a chunk is
summed once. Piece probabilities are fitted by expectation maximisation
(forward and backward sums) on word counts of a bounded sample.

The sample: at most ``PER_LANGUAGE`` training documents a language (by hash
of the id) and of these the ``WORDS_PER_LANGUAGE`` most frequent words of
at most ``FIT_CHARS`` letters. Everything else covers all rows and texts.

A null text and a text without letters get ``und`` with score 0. Ties go
to the language first in code point order. Without any labelled training
row every prediction is ``und``. Rows that repeat are predicted alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dbtelemetry.llm import common

PIECES = "piece_bpe_32k.model"
PER_LANGUAGE = 400
WORDS_PER_LANGUAGE = 30_000
FIT_CHARS = 40
ROUNDS = 4
SMOOTHING = 0.05
MAX_PIECE = 16
UNKNOWN = "und"
MARK = "▁"
#: Probability of each letter that is no piece, in every language, next to a share for all of them.
RARE = 1e-3
CACHE_WORDS = 200_000
BLOCK = 200_000
SALTS = 16

_WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pieces(path: str | None = None) -> list[str]:
    """The distinct pieces of the vocabulary that consist of letters, lower-cased, with or without the word mark."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_byte(i)}
    return sorted(p for p in found if 0 < len(p) <= MAX_PIECE and p.lstrip(MARK).isalpha() or p == MARK)


def _mix(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Lattice:
    """Finds pieces in words: ids of all substrings, for blocks of words of similar length."""

    def __init__(self, names: list[str]):
        self.size = len(names) + 1  # the last id: any letter that is no piece
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(names):
            by_length.setdefault(len(p), []).append(i)
        self.tables = {}
        for n, ids in by_length.items():
            h = self._hashes(np.array([[ord(c) for c in names[i]] for i in ids], np.uint32))
            order = np.argsort(h)
            self.tables[n] = (np.append(h[order], np.uint64(2**64 - 1)), np.append(np.array(ids, np.int32)[order], np.int32(-1)))
        self.longest = max(by_length)

    @staticmethod
    def _hashes(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for k in range(codes.shape[1]):
            h = h * _BASE + _mix(codes[:, k])
        return h

    def blocks(self, words: list[str]):
        """``(places, width, ids)``: ids[n][:, s] is the piece of n letters from s on, or -1; every word has ``width`` letters, mark included."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(lengths, kind="stable")
        begin = 0
        while begin < len(order):
            width = int(lengths[order[begin]])
            end = min(int(np.searchsorted(lengths[order], width, "right")), begin + max(1, BLOCK // width))
            at = order[begin:end]
            codes = np.frombuffer("".join(MARK + words[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), width)
            mixed, h, ids = _mix(codes), None, {}
            for n in range(1, min(self.longest, width) + 1):
                h = mixed if h is None else h[:, :-1] * _BASE + mixed[:, n - 1:]
                if n in self.tables:
                    table, own = self.tables[n]
                    k = np.searchsorted(table, h)
                    found = np.where(table[k] == h, own[k], -1)
                    if n == 1:
                        found = np.where(found < 0, self.size - 1, found)
                    if (found >= 0).any():
                        ids[n] = found
            yield at, width, ids
            begin = end


def _sums(width: int, ids: dict, prob: np.ndarray, rows: int, back: bool = False) -> np.ndarray:
    """Logarithms of the sums of all segmentations of each prefix (``back``: of each rest), per language.

    ``prob`` has a last row of zeros, which id -1 finds. Every sum is taken
    relative to the one before it, so no length and no language underflows;
    a single letter is always a piece, so no sum is zero.
    """
    out = np.zeros((width + 1, rows, prob.shape[1]))
    places = range(width - 1, -1, -1) if back else range(1, width + 1)
    for e in places:
        near = out[e + 1] if back else out[e - 1]
        total = np.zeros(near.shape)
        for n, found in ids.items():
            if back and e + n <= width:
                part = prob[found[:, e]]
                total += part if n == 1 else part * np.exp(out[e + n] - near)
            elif not back and n <= e:
                part = prob[found[:, e - n]]
                total += part if n == 1 else part * np.exp(out[e - n] - near)
        out[e] = near + np.log(total)
    return out


@dataclass
class Model:
    """Languages in code point order, and piece probabilities (pieces x languages, a last row of zeros)."""

    langs: list[str]
    names: list[str]
    prob: np.ndarray

    def scorer(self):
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.names)
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(model.langs)))

    def words(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language, all segmentations summed."""
        out = np.zeros((len(words), len(self.model.langs)))
        for at, width, ids in self.lattice.blocks(words):
            out[at] = _sums(width, ids, self.model.prob, len(at))[width]
        return out

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text in each language, and its number of letters."""
        split = [words_of(t) for t in texts]
        if len(self.place) > CACHE_WORDS:
            self.place, self.known = {}, self.known[:0]
        place = self.place
        fresh = [w for w in set().union(*split) if w not in place]
        place.update(zip(fresh, range(len(place), len(place) + len(fresh)), strict=True))
        self.known = np.concatenate((self.known, self.words(fresh)))
        total = np.zeros((len(texts), len(self.model.langs)))
        for i, ws in enumerate(split):
            if ws:
                total[i] = self.known[np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
        return total, np.array([sum(map(len, ws)) for ws in split])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        total, letters = self.texts(texts)
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        score = 1.0 / share.sum(axis=1)
        return ([self.model.langs[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)],
                [float(s) if n else 0.0 for s, n in zip(score, letters, strict=True)])


def fit(counts: dict[str, dict[str, int]], names: list[str], rounds: int = ROUNDS) -> Model | None:
    """Piece probabilities of each language from its word counts."""
    langs = sorted(lang for lang, c in counts.items() if c)
    if not langs:
        return None
    words = sorted(set().union(*[counts[lang] for lang in langs]))
    weight = np.array([[counts[lang].get(w, 0) for lang in langs] for w in words], float)
    lattice = Lattice(names)
    prob = np.full((lattice.size + 1, len(langs)), 1.0 / lattice.size)
    prob[-2], prob[-1] = RARE / lattice.size, 0.0
    blocks = list(lattice.blocks(words))
    for _ in range(rounds):
        found = np.full((lattice.size, len(langs)), SMOOTHING)
        for at, width, ids in blocks:
            a, b = _sums(width, ids, prob, len(at)), _sums(width, ids, prob, len(at), back=True)
            share = weight[at]
            for s in range(width):
                for n, own in ids.items():
                    if s + n <= width:
                        used = own[:, s] >= 0
                        piece = own[used, s]
                        mass = share[used] * prob[piece] * np.exp(a[s][used] + b[s + n][used] - a[width][used])
                        for k in range(len(langs)):
                            found[:, k] += np.bincount(piece, weights=mass[:, k], minlength=lattice.size)
        prob[:-1] = found / found.sum(axis=0)
        prob[-2] = np.maximum(prob[-2], 1e-9) * RARE  # shared by all letters that are no pieces
    return Model(langs, names, prob)


def _first(rows: DataFrame, order: list[Column], n: int, spread: str) -> DataFrame:
    """The first ``n`` rows a language in ``order``; salted first, so no task gets more than ``SALTS * n`` rows of a language."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread, F.lit(5)), F.lit(SALTS)))
    for keys in (["lang", "_salt"], ["lang"]):
        salted = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= n)
    return salted.drop("_salt", "_n")


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, words_per_language: int = WORDS_PER_LANGUAGE, path: str | None = None) -> Model | None:
    """Fit on a bounded sample of the rows where ``learn`` holds and text and language are not null."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), learn.alias("learn"))
    rows = rows.filter(F.col("learn") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    ids = _first(rows.select("doc_id", "lang"), [F.xxhash64("doc_id"), F.col("doc_id")], per_language, "doc_id")
    # At most per_language rows a language: a bounded list of ids.
    chosen = sorted({r[0] for r in ids.select("doc_id").collect() if r[0] is not None})
    sample = rows.filter(F.col("doc_id").isin(chosen)) if chosen else rows.limit(0)

    def count(batches):
        for batch in batches:
            tally: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for w in words_of(text):
                    if len(w) < FIT_CHARS:
                        tally[lang, w] = tally.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in tally], "word": [k[1] for k in tally],
                                              "n": pa.array(tally.values(), pa.int64())},
                                             schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    tally = sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    tally = tally.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    tally = _first(tally, [F.col("n").desc(), F.col("word")], words_per_language, "word")
    counts: dict[str, dict[str, int]] = {}
    for lang, word, n in tally.select("lang", "word", "n").collect():
        counts.setdefault(lang, {})[word] = n
    return fit(counts, pieces(path))


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", lang_name: str = "lang_pred",
                  score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability (even prior)."""
    if model is None:
        return docs.withColumn(lang_name, F.lit(UNKNOWN)).withColumn(score_name, F.lit(0.0))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages: bounded by the vocabulary

    def start():
        scorer = shipped.value.scorer()

        def compute(texts):
            langs, scores = scorer.predict(texts)
            return {lang_name: langs, score_name: scores}

        return compute

    return common.with_columns(docs, start, [(lang_name, T.StringType()), (score_name, T.DoubleType())], text_col)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learned from the labelled documents that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 4) == 2
    model = train(docs, ~held)
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return with_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")
