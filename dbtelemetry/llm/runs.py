"""Periodic run detection by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, of at least
``times * q`` and ``least`` words, that no neighbouring word extends. In the
suffix array of a text's words, the last square of a run of period q starts
at two suffixes, q apart, in different children of an LCP interval of depth
q. So, for every LCP interval of depth d, the suffixes i of all children
but the largest are tested: is the place of i + d or of i - d inside the
interval, in another child? The squares found are rotated to the left as
far as the words agree, and squares that lie in a run already found with a
shorter period are merged into it. Intervals come from nearest smaller LCP
values; no tree is built.

Texts are handled in chunks of a few megabytes inside a task, without a
shuffle; the suffixes of different texts of a chunk never share a prefix.
A text longer than a chunk is a chunk of its own and takes some 200 bytes
of memory a word.

A null text has no words. Rows that repeat get the same result each; a
null id is kept. Columns beyond id and text are left out. Empty input
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common, suffixes

TIMES = 4
LEAST = 6
CHUNK = 4_000_000
RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _squares(words: suffixes.Suffixes, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of all branching squares that can end a run of ``times`` periods."""
    order, place, n = words.order, words.place, words.n
    lcp = np.full(n + 1, -1, np.int64)
    lcp[1:n] = words.common_prefix(order[:-1], order[1:])
    lcp[lcp == 0] = -1  # no interval of depth 0: borders end the search of the nearest smaller value
    left, right = suffixes.smaller_before(lcp), suffixes.smaller_after(lcp)
    # Interval [left, right) of every border between two children; a run's interval holds one suffix a period.
    border = np.flatnonzero((lcp >= 1) & (right - left >= times))
    if not len(border):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = left[border] * (n + 1) + right[border]
    by = np.argsort(key, kind="stable")
    border, key = border[by], key[by]
    head = np.append(True, key[1:] != key[:-1])
    group = np.cumsum(head) - 1
    lead = border[head]
    # Children: from the interval's start to its first border, then from each border to the next one or the end.
    until = np.where(np.append(head[1:], True), right[border], np.append(border[1:], 0))
    begin = np.concatenate((left[lead], border))
    end = np.concatenate((lead, until))
    owner = np.concatenate((np.arange(len(lead)), group))
    size = end - begin
    by = np.lexsort((size, owner))
    small = by[np.append(owner[by][1:] == owner[by][:-1], False)]  # all but the largest child
    begin, size, owner = begin[small], size[small], owner[small]
    total = int(size.sum())
    at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(total)
    low, high = np.repeat(begin, size), np.repeat(begin + size, size)
    depth, lo, hi = (np.repeat(v[lead][owner], size) for v in (lcp, left, right))
    i = order[at]

    def in_other_child(j: np.ndarray) -> np.ndarray:
        p = place[np.clip(j, 0, n - 1)]
        return (j >= 0) & (j < n) & (p >= lo) & (p < hi) & ((p < low) | (p >= high))

    ahead, behind = in_other_child(i + depth), in_other_child(i - depth)
    start = np.concatenate((i[ahead], (i - depth)[behind]))
    period = np.concatenate((depth[ahead], depth[behind]))
    both = np.unique(np.stack((start, period), axis=1), axis=0)
    return both[:, 0], both[:, 1]


def find(numbers: np.ndarray, bounds: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Runs of all texts: text, start (word number in the text), length, period, in this order."""
    texts = np.arange(len(bounds) - 1)
    sizes = np.diff(bounds)
    distinct = int(numbers.max()) + 1 if len(numbers) else 0
    base = np.repeat(texts, sizes) * (distinct + 1)
    symbols, first = suffixes.closed(numbers[bounds[0]:bounds[-1]] + base, bounds - bounds[0], texts * (distinct + 1) + distinct)
    none = np.zeros(0, np.int64)
    if not len(symbols):
        return none, none, none, none
    words = suffixes.Suffixes(symbols, keep=True)
    start, period = _squares(words, times)
    by = np.lexsort((period, start + 2 * period))
    start, period = start[by], period[by]
    found = []
    while len(start):
        end = start + 2 * period
        head = np.append(True, end[1:] != end[:-1])
        s, q, e = start[head], period[head], end[head]
        s = s - words.common_before(s, s + q)
        found.append((s, e, q))
        # Squares inside the run just found repeat its period several times over.
        rest = ~head & (start < s[np.cumsum(head) - 1])
        start, period = start[rest], period[rest]
    if not found:
        return none, none, none, none
    s, e, q = (np.concatenate(c) for c in zip(*found, strict=True))
    long = e - s >= np.maximum(least, times * q)
    s, e, q = s[long], e[long], q[long]
    text = np.searchsorted(first, s, "right") - 1
    by = np.lexsort((q, s))
    return text[by], (s - first[text])[by], (e - s)[by], q[by]


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    """One list a text from values sorted by text."""
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, least: int = LEAST,
             rewrite: Callable[[list, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs`` (by start, then period) and ``text``.

    ``text`` holds the words, joined by one blank, without those that some
    run contains after its first period. ``rewrite`` may replace the words
    beforehand: from the ids and the bounds of the texts to the word number
    that each word takes.
    """
    common.small_batches(docs.sparkSession)
    rows = common.texts(docs, id_col, text_col)

    def run(batches):
        for batch in common.chunks(batches, "text", CHUNK):
            words, bounds = suffixes.split(batch.column("text"), suffixes.PRINTED)
            n = len(batch)
            numbers, _ = suffixes.numbered(words)
            take = np.arange(len(words))
            if rewrite is not None:
                take = rewrite(batch.column("doc_id").to_pylist(), bounds)
                numbers = numbers[take]
            text, start, length, period = find(numbers, bounds, times, least)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, bounds[text] + start + period, 1)
            np.add.at(cover, bounds[text] + start + length, -1)
            kept = np.cumsum(cover[:-1]) == 0
            owner = np.repeat(np.arange(n), np.diff(bounds))[kept]
            # A blank a word joins the words of a text.
            listed = _lists(words.cast(pa.binary()).take(pa.array(take[kept])), owner, n)
            joined = pc.binary_join(listed, b" ").cast(pa.string())
            runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), _lists(runs, text, n), joined],
                names=["doc_id", "n_words", "runs", "text"])

    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, text string")


def planted(ids: list, bounds: np.ndarray) -> np.ndarray:
    """The query's rewriting: one text in ten, by the hash of its id, is made periodic from some word on."""
    import zlib

    take = np.arange(int(bounds[-1]))
    for k, doc in enumerate(ids):
        n = int(bounds[k + 1] - bounds[k])
        if doc is None or not n:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        begin = int(bounds[k]) + a
        take[begin:int(bounds[k + 1])] = begin + np.arange(n - a) % p
    return take


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest one, and digests of the list of runs and of the collapsed text."""
    out = collapse(common.table(spark, sf_dir, "documents"), rewrite=planted)
    # The longest run; of equal length the first, then the shortest period.
    top = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] > a["length"], r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    out = out.withColumn("top", top)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
