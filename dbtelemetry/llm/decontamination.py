"""Benchmark decontamination by suffix arrays over the training texts.

Inside the tasks, the words of the training texts are laid out in shards of
about ``SHARD`` words, each with its distinct words and the suffix array of
its word numbers. Every suffix of every test text is binary searched in
every shard: the range of suffixes with the same first words is narrowed
word by word, which gives the longest verbatim match, and all its places,
when the range runs empty. Where ``window`` words of it (or all words of a
shorter text) agree, the words at all places of that range are hit, and the
training text is contaminated by the test text.

Distinct test texts are dealt by hash to blocks of about ``BLOCK`` words;
one block at a time is sent to all tasks, whatever the number of test texts
(with several blocks, the training texts are a table in the shared folder).
Training texts of over ``SHARD`` words and test texts of over ``PIECE``
words are cut into parts that overlap by ``OVERLAP`` words, so every window
of up to ``OVERLAP`` words is whole in some part; only the longest matches
of more words may be given in several parts.

Words are runs of letters, digits and non-ASCII characters, A-Z folded to
lower case; other characters separate words. A null text has no words; a
text without words neither contaminates nor is contaminated. The words hit
by a test text without an id count, its id is not listed. Test rows that
repeat an id are one item with several texts. Training rows that repeat
get the same result each; a null id is kept. Other columns are left out,
or kept as they are by ``clean``.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common, suffixes

WINDOW = 10
SHARD = 1_000_000
PIECE = 100_000
OVERLAP = 4096
BLOCK = 1_000_000
CHUNK = 5_000_000


def _parts(bounds: np.ndarray, longest: int, overlap: int) -> list[tuple[int, int, int]]:
    """``text, first word, end`` of all parts of at most ``longest`` words, which overlap within a text."""
    out = []
    for k in range(len(bounds) - 1):
        a, end = int(bounds[k]), int(bounds[k + 1])
        while end - a > longest:
            out.append((k, a, a + longest))
            a += longest - overlap
        out.append((k, a, end))
    return out


@dataclass
class Shard:
    """Parts of training texts, end to end: their rows and first words, and the suffix array of their word numbers."""

    row: np.ndarray
    firsts: np.ndarray
    bounds: np.ndarray
    numbers: np.ndarray
    order: np.ndarray
    words: pa.Array

    @staticmethod
    def of(words: pa.Array, at: np.ndarray, parts: list[tuple[int, int, int]]) -> Shard:
        numbers, distinct = suffixes.numbered(pa.concat_arrays([words.slice(a, b - a) for _, a, b in parts]))
        row = np.array([k for k, _, _ in parts], np.int64)
        sizes = np.array([b - a for _, a, b in parts], np.int64)
        symbols, bounds = suffixes.closed(numbers, np.append(0, np.cumsum(sizes)), len(distinct) + np.arange(len(parts)))
        return Shard(row, np.array([a for _, a, _ in parts], np.int64) - at[row], bounds, symbols,
                     suffixes.Suffixes(symbols).order, distinct)

    def part(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, "right") - 1

    def word(self, places: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Word numbers in their texts."""
        return places - self.bounds[part] + self.firsts[part]

    def _first(self, lo: np.ndarray, hi: np.ndarray, number: np.ndarray, depth: int) -> np.ndarray:
        """First place in [lo, hi) whose suffix has a word of at least ``number`` after ``depth`` words."""
        a, b = lo.copy(), hi.copy()
        while (live := a < b).any():
            mid = (a + b) >> 1
            less = self.numbers[self.order[np.where(live, mid, 0)] + np.where(live, depth, 0)] < number
            a = np.where(live & less, mid + 1, a)
            b = np.where(live & ~less, mid, b)
        return a

    def search(self, block: Block, window: int) -> Found:
        """Longest match of every test suffix, its range of places, and the range that shares a window."""
        own = pc.index_in(block.words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        test = own[block.tokens]
        n, room = len(test), block.room
        need = np.minimum(window, block.lengths)
        lo, hi, length = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        wlo, whi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        act = np.arange(n)
        a, b = np.zeros(n, np.int64), np.full(n, len(self.order), np.int64)
        depth = 0
        while len(act):
            on = (room[act] > depth) & (test[np.minimum(act + depth, n - 1)] >= 0)
            act, a, b = act[on], a[on], b[on]
            number = test[act + depth]
            a = self._first(a, b, number, depth)
            b = self._first(a, b, number + 1, depth)
            on = a < b
            act, a, b = act[on], a[on], b[on]
            depth += 1
            lo[act], hi[act], length[act] = a, b, depth
            full = act[need[act] == depth]
            wlo[full], whi[full] = lo[full], hi[full]
        return Found(lo, hi, length, wlo, whi, need)


@dataclass
class Found:
    lo: np.ndarray
    hi: np.ndarray
    length: np.ndarray
    window_lo: np.ndarray
    window_hi: np.ndarray
    need: np.ndarray


@dataclass
class Block:
    """Distinct test texts: word numbers of all, end to end; ``room`` and ``lengths`` a word, ``text`` the text's number."""

    words: pa.Array
    tokens: np.ndarray
    room: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    first: np.ndarray
    items: list[list[int]]

    @staticmethod
    def of(rows: list) -> Block:
        """From rows of ``_tests``: words separated by blanks, length of the whole text, first word of the part, item ids."""
        words, at = suffixes.split(pa.array([r[0] for r in rows], pa.string()), suffixes.PRINTED)
        numbers, distinct = suffixes.numbered(words)
        sizes = np.diff(at)
        text = np.repeat(np.arange(len(rows)), sizes)
        room = at[1:][text] - np.arange(len(words))
        lengths = np.array([r[1] for r in rows], np.int64)[text]
        first = np.array([r[2] for r in rows], np.int64)
        return Block(distinct, numbers, room, lengths, text, first, [list(r[3]) for r in rows])


def _tests(items: DataFrame, id_col: str, text_col: str, piece: int, overlap: int) -> DataFrame:
    """Parts of the distinct test texts: ``words, length`` (of the whole text), ``first`` (word), ``n`` (words) and ``items``."""
    rows = items.select(F.col(id_col).cast("long").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in common.chunks(batches, "text", CHUNK):
            words, at = suffixes.split(batch.column("text"), suffixes.ALPHANUMERIC, lower=True)
            out = {"item": [], "words": [], "length": [], "first": [], "n": []}
            for k, a, b in _parts(at, piece, overlap):
                if b > a:
                    out["item"].append(batch.column("item")[k].as_py())
                    out["words"].append(b" ".join(words.slice(a, b - a).to_pylist()).decode())
                    out["length"].append(int(at[k + 1] - at[k]))
                    out["first"].append(a - int(at[k]))
                    out["n"].append(b - a)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item", pa.int64()), ("words", pa.string()), ("length", pa.int64()), ("first", pa.int64()), ("n", pa.int64())]))

    common.small_batches(items.sparkSession)
    parts = rows.mapInArrow(run, "item long, words string, length long, first long, n long")
    return common.stored(parts.groupBy("words", F.least("length", F.lit(piece)).alias("length"), "first", "n")
                         .agg(F.collect_set("item").alias("items")))


def _laid_out(ranges_lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges that start at ``ranges_lo``."""
    return np.repeat(ranges_lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


_HITS = "rid long, doc_id long, digest string, n long, hits array<struct<start:long,stop:long>>, items array<long>"


def _hits(batch: pa.RecordBatch, shard: Shard, block: Block, window: int) -> pa.RecordBatch:
    """Merged stretches of hit words, and the items that hit, for every part of the shard."""
    found = shard.search(block, window)
    parts = len(shard.row)
    at = np.flatnonzero(found.window_hi > found.window_lo)
    # Test suffixes with the same window share a range: each is laid out once.
    ranges, which = np.unique(np.stack((found.window_lo[at], found.window_hi[at], found.need[at]), axis=1), axis=0, return_inverse=True)
    size = ranges[:, 1] - ranges[:, 0]
    start = shard.order[_laid_out(ranges[:, 0], size)]
    cover = np.zeros(len(shard.numbers) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + np.repeat(ranges[:, 2], size), -1)
    hit = np.cumsum(cover) > 0  # never a closing symbol
    step = np.diff(hit.astype(np.int8), prepend=0)
    begins, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    owner = shard.part(begins)
    pairs = pa.StructArray.from_arrays([pa.array(shard.word(begins, owner)), pa.array(shard.word(stops, owner))], names=["start", "stop"])
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=parts))).astype(np.int32)
    # Items: of each part the ranges that it lies in, of each range its test texts.
    of_range: list[set] = [set() for _ in ranges]
    for r, t in set(zip(which.reshape(-1).tolist(), block.text[at].tolist(), strict=True)):
        of_range[r].update(block.items[t])
    named: list[set] = [set() for _ in range(parts)]
    lies = np.stack((shard.part(start), np.repeat(np.arange(len(ranges)), size)), axis=1)
    for p, r in np.unique(lies, axis=0).tolist():
        named[p] |= of_range[r]
    row = pa.array(shard.row)
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c).take(row) for c in ("rid", "doc_id", "digest")], pa.array(np.diff(shard.bounds) - 1 + shard.firsts),
         pa.ListArray.from_arrays(pa.array(offsets), pairs), pa.array([sorted(s) for s in named], pa.list_(pa.int64()))],
        names=["rid", "doc_id", "digest", "n", "hits", "items"])


_LONGEST = "items array<long>, item_start long, length long, doc_id long, doc_start long"


def _longest(batch: pa.RecordBatch, shard: Shard, block: Block, window: int) -> pa.RecordBatch:
    """The longest matches in the shard of every test text, at all their places."""
    found = shard.search(block, window)
    best = np.zeros(len(block.items), np.int64)
    np.maximum.at(best, block.text, found.length)
    at = np.flatnonzero((found.length == best[block.text]) & (found.length > 0))
    size = (found.hi - found.lo)[at]
    each = np.repeat(at, size)
    start = shard.order[_laid_out(found.lo[at], size)]
    part = shard.part(start)
    text = block.text[each]
    begin = np.searchsorted(block.text, np.arange(len(block.items)))
    return pa.RecordBatch.from_arrays(
        [pa.array([block.items[t] for t in text.tolist()], pa.list_(pa.int64())), pa.array(block.first[text] + each - begin[text]),
         pa.array(found.length[each]), batch.column("doc_id").take(pa.array(shard.row[part])), pa.array(shard.word(start, part))],
        names=["items", "item_start", "length", "doc_id", "doc_start"])


def _searched(docs: DataFrame, items: DataFrame, answer, schema: str, window: int, id_col: str, text_col: str, item_col: str,
              item_text: str, shard: int, block: int, piece: int, overlap: int) -> DataFrame:
    """What ``answer`` gives for every shard of the training texts and every block of test texts."""
    common.small_batches(docs.sparkSession)
    rows = common.texts(docs, id_col, text_col, F.monotonically_increasing_id().alias("rid"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    tests = _tests(items, item_col, item_text, max(piece, 2 * overlap), overlap)
    count = -(-(tests.agg(F.sum("n")).first()[0] or 0) // block)
    if count > 1:
        rows = common.stored(rows)  # row numbers must be the same for every block
    found = []
    for k in range(max(1, count)):
        part = tests.filter(F.pmod(F.xxhash64("words", F.lit(3)), F.lit(max(1, count))) == k)
        own = Block.of(part.select("words", "length", "first", "items").orderBy("words", "first").collect())
        sent = docs.sparkSession.sparkContext.broadcast(own)  # about ``block`` words

        def run(batches, sent=sent):
            for batch in common.chunks(batches, "text", CHUNK):
                words, at = suffixes.split(batch.column("text"), suffixes.ALPHANUMERIC, lower=True)
                group, held = [], 0
                parts = _parts(at, max(shard, 2 * overlap), overlap)
                for n, one in enumerate(parts):
                    group.append(one)
                    held += one[2] - one[1]
                    if held >= shard or n == len(parts) - 1:
                        yield answer(batch, Shard.of(words, at, group), sent.value, window)
                        group, held = [], 0

        out = rows.mapInArrow(run, schema)
        found.append(common.stored(out) if count > 1 else out)
    return functools.reduce(DataFrame.union, found)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, shard: int = SHARD, block: int = BLOCK,
                 piece: int = PIECE, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: ``doc_id, digest`` (MD5 of the text), ``n_words, n_hit`` and ``items``, the ids of the items found, in order."""
    if not 0 < window <= overlap:
        raise ValueError("a window has 1 to ``overlap`` words")
    rows = _searched(docs, items, _hits, _HITS, window, id_col, text_col, item_col, item_text, shard, block, piece, overlap)
    # Parts of one text and answers of several blocks come together; all others are alone.
    rows = rows.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"), F.max("n").alias("n_words"),
                                   F.flatten(F.collect_list("hits")).alias("hits"),
                                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = F.lit(0).cast("long")
    n_hit = F.aggregate(F.array_sort("hits"), F.struct(none.alias("n"), none.alias("end")), lambda s, h: F.struct(
        (s["n"] + F.greatest(none, h["stop"] - F.greatest(h["start"], s["end"]))).alias("n"),
        F.greatest(s["end"], h["stop"]).alias("end")), lambda s: s["n"])
    return rows.select("doc_id", "digest", "n_words", n_hit.alias("n_hit"), "items")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows that hold a window of some item, with exactly the input's columns."""
    gone = contaminated(docs, items, id_col, text_col, **kw).filter("n_hit > 0").select(
        F.col("doc_id").alias("__gone_id"), F.col("digest").alias("__gone_digest")).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    same = docs[id_col].cast("long").eqNullSafe(F.col("__gone_id")) & (F.md5(text.cast("binary")) == F.col("__gone_digest"))
    return docs.join(gone, same, "left_anti")


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", shard: int = SHARD, block: int = BLOCK, piece: int = PIECE, overlap: int = OVERLAP) -> DataFrame:
    """Longest verbatim matches of every item and all their places: ``item_id, item_start, length, doc_id, doc_start`` (word numbers)."""
    rows = _searched(docs, items, _longest, _LONGEST, 1, id_col, text_col, item_col, item_text, shard, block, piece, overlap)
    rows = common.stored(rows.withColumn("item_id", F.explode("items")).drop("items"))
    best = rows.groupBy("item_id").agg(F.max("length").alias("length"))
    return rows.join(best, ["item_id", "length"]).select("item_id", "item_start", "length", "doc_id", "doc_start").distinct()


def op11_suffix_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words of every document that verbatim windows of the benchmark cover, and the items they are from."""
    out = contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(named.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# Lower case for A-Z alone; every window length of the items is looked up among the windows of that length.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
o AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
h AS (SELECT o.doc_id, o.s, o.k, i.item_id FROM o JOIN i ON o.k = i.k AND o.win = i.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
