"""Near-dedup by ProbMinHash, banding and exact verification.

A text's shingles are its runs of five words (all its words, if fewer),
each weighted 1 + ln(its number of occurrences). Every shingle produces
arrivals of a Poisson process of its weight's rate, each at a random
register; a register keeps the shingle that arrives first. Shingles stop as
soon as their next arrival is later than the last register's. Two texts
agree in a register with the probability Jaccard similarity of their
weighted shingles, which is plain Jaccard where no shingle repeats.

Registers are banded; texts that share a band's registers are candidates,
and links are the candidates whose exact probability Jaccard is
``threshold`` or more. A class is a connected component of links.

Nothing emits all pairs of a bucket. Equal texts are one node. Each node is
first compared with one hub (the smallest node of its buckets), then with
the other buckets' hubs that are not in its component yet. What is still
apart within a bucket is compared in blocks of bounded size, by registers
first: pairs whose agreement is more than four standard deviations below
the threshold are passed over, the rest is verified there exactly, and only
links come out.

A null text counts as empty; texts without words have no shingles and are
linked to equal texts alone. Rows that repeat an id are rows of their own.
The class id is the smallest doc_id in the class, and that row stays (one of
them, if it repeats).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dbtelemetry.llm import common
from dbtelemetry.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
BANDS = 26
ROWS = 5
#: Allowed for in sums of weights that should equal the threshold.
ROUNDING = 1e-12
#: Rows of one bucket that are compared with one another in one task.
BLOCK = 1024
SLICE = 1_000_000
CHUNK = 3_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word; long texts are split at white space, slice by slice."""
    parts, at = [], 0
    data = text.encode()
    while at < len(data):
        end = at + SLICE
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        words = data[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text, and their weights."""
    w = word_hashes(text)
    if not len(w):
        return np.zeros(0, np.uint64), np.zeros(0)
    n = min(words, len(w))
    h = np.full(len(w) - n + 1, np.uint64(n))
    for k in range(n):
        h = _mix(h * _GOLD + w[k:len(w) - n + 1 + k])
    found, count = np.unique(h, return_counts=True)
    return found, 1.0 + np.log(count)


def sketch(elements: list[np.ndarray], weights: list[np.ndarray], registers: int) -> np.ndarray:
    """Registers (texts x registers) holding the winning shingle's hash; zeros for texts without shingles."""
    texts = len(elements)
    who = np.zeros((texts, registers), np.uint64).reshape(-1)
    if not any(map(len, elements)):
        return who.reshape(texts, registers)
    first = np.full(texts * registers, np.inf)
    doc = np.repeat(np.arange(texts), [len(e) for e in elements])
    x = np.concatenate(elements)
    # Rates add up to one in each text.
    total = np.array([w.sum() for w in weights])
    rate = np.concatenate(weights) / total[doc]
    when = np.zeros(len(x))
    k = 0
    with np.errstate(over="ignore"):
        while len(x):
            k += 1
            r = _mix(x + np.uint64(k) * _GOLD)
            when = when - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
            place = doc * registers + (_mix(r + _GOLD) % np.uint64(registers)).astype(np.int64)
            better = np.flatnonzero(when < first[place])
            at, t = place[better], when[better]
            np.minimum.at(first, at, t)
            won = t == first[at]
            who[at[won]] = x[better[won]]
            docs = np.unique(doc)
            last = np.zeros(texts)
            last[docs] = first.reshape(texts, registers)[docs].max(axis=1)
            on = when < last[doc]
            x, doc, rate, when = x[on], doc[on], rate[on], when[on]
    return who.reshape(texts, registers)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted shingle sets (sorted, distinct)."""
    if not len(a) or not len(b):
        return 0.0
    common_, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common_):
        return 0.0
    if (wa == 1.0).all() and (wb == 1.0).all():
        return len(common_) / (len(a) + len(b) - len(common_))  # plain Jaccard, without rounding
    wa, wb = wa / wa.sum(), wb / wb.sum()
    ca, cb = wa[ia], wb[ib]
    rest_a, rest_b = 1.0 - ca.sum(), 1.0 - cb.sum()
    ratio = cb / ca
    order = np.argsort(ratio, kind="stable")
    ratio, ca, cb = ratio[order], ca[order], cb[order]
    # For shingle x: the sum over y of max(a(y) / a(x), b(y) / b(x)).
    low = np.cumsum(ca)
    high = cb.sum() - np.cumsum(cb)
    return float((ca / (low + rest_a + (high + rest_b) / ratio)).sum())


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``rid, doc_id, digest, registers, keys``: a row number, the text's digest, its registers and band keys.

    Stored in the shared folder, so that row numbers stay.
    """
    common.small_batches(docs.sparkSession)
    src = common.texts(docs, id_col, text_col)
    src = src.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")

    def run(batches):
        for batch in common.chunks(batches, "text", CHUNK):
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            reg = sketch([s for s, _ in sets], [w for _, w in sets], bands * rows)
            filled = np.array([len(s) > 0 for s, _ in sets])
            short = _mix(reg + _GOLD).astype(np.uint32)
            keys = np.zeros((len(sets), bands), np.uint64)
            with np.errstate(over="ignore"):
                for b in range(bands):
                    h = np.full(len(sets), np.uint64(b + 1))
                    for r in range(rows):
                        h = _mix(h * _GOLD + reg[:, b * rows + r])
                    keys[:, b] = h
            lists = [k.view(np.int64).tolist() if f else [] for k, f in zip(keys, filled, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "digest": batch.column("digest"),
                "registers": pa.array([r.astype("<u4").tobytes() for r in short], pa.binary()),
                "keys": pa.array(lists, pa.list_(pa.int64()))})

    made = src.mapInArrow(run, "doc_id long, digest binary, registers binary, keys array<long>")
    return common.stored(made.select(F.monotonically_increasing_id().alias("rid"), "*"))


def _set(packed: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(packed, "<u8")
    return x, np.frombuffer(weights, "<f8") if weights else np.ones(len(x))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity is ``threshold`` or more."""
    left = sets.select(F.col("rid").alias("a"), F.col("set").alias("set_a"), F.col("weights").alias("weights_a"))
    right = sets.select(F.col("rid").alias("b"), F.col("set").alias("set_b"), F.col("weights").alias("weights_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "weights_a", "set_b", "weights_b")

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in batch.schema.names]
            a, b = [], []
            for i, j, sa, wa, sb, wb in zip(*cols, strict=True):
                if similarity(*_set(sa, wa), *_set(sb, wb)) >= threshold - ROUNDING:
                    a.append(i)
                    b.append(j)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Shingle sets of ``nodes`` (``rid, doc_id, digest``), from the texts."""
    src = common.texts(docs, id_col, text_col)
    src = src.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")
    src = src.withColumnRenamed("doc_id", "_id")
    found = src.join(nodes, (src["_id"].eqNullSafe(nodes["doc_id"])) & (src["digest"] == nodes["digest"])).select("rid", "text")

    def run(batches):
        for batch in batches:
            sets, weights = [], []
            for t in batch.column("text").to_pylist():
                s, w = shingles(t, words)
                sets.append(s.astype("<u8").tobytes())
                weights.append(w.astype("<f8").tobytes() if (w != 1.0).any() else b"")
            yield pa.RecordBatch.from_pydict({"rid": batch.column("rid"), "set": pa.array(sets, pa.binary()),
                                              "weights": pa.array(weights, pa.binary())})

    # Rows that repeat id and text meet the same node; one of them is enough.
    return common.stored(found.mapInArrow(run, "rid long, set binary, weights binary").dropDuplicates(["rid"]))


def _apart(buckets: DataFrame, registers: DataFrame, sets: DataFrame, bands: int, rows: int, threshold: float, block: int) -> DataFrame:
    """Links within the given buckets (``key, band, rid, label``) between nodes that lie in different components.

    The rows of a bucket meet in parts of about ``block`` rows, with their
    registers and shingle sets; a task passes on only the links that join
    what its own links have not joined yet.
    """
    per = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"),
                                     F.max("label").alias("hi"), F.min("rid").alias("hub")).filter("lo <> hi")
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    dealt = (buckets.join(per, "key").join(registers, "rid").join(sets, "rid")
             .withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")))
    # Each part meets every part, itself included, once: groups (low part, high part).
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    names = ("key", "band", "p", "q", "part", "rid", "label", "hub", "registers", "set", "weights")
    dealt = dealt.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}).select(*names)
    need = threshold - 4.0 * np.sqrt(threshold * (1 - threshold) / (bands * rows))

    def compare(group: dict) -> tuple[list, list]:
        reg = np.frombuffer(b"".join(group["registers"]), "<u4").reshape(-1, bands * rows)
        rid, label, part = (np.array(group[c]) for c in ("rid", "label", "part"))
        low = np.flatnonzero(part == group["p"][0])
        high = np.flatnonzero(part == group["q"][0])
        own = group["p"][0] == group["q"][0]
        a, b = [], []
        for k, i in enumerate(low.tolist()):
            if rid[i] == group["hub"][0]:
                continue  # all were compared with the hub already
            to = high[k + 1:] if own else high
            to = to[(label[to] != label[i]) & (rid[to] != group["hub"][0])]
            if not len(to):
                continue
            same = reg[to] == reg[i]
            near = same.mean(axis=1) >= need
            to, same = to[near], same[near]
            # A pair may share several buckets; it is looked at in the first band that it shares.
            to = to[same.reshape(len(to), bands, rows).all(axis=2).argmax(axis=1) == group["band"][0]]
            for j in to.tolist():
                if label[i] != label[j] and similarity(*_set(group["set"][i], group["weights"][i]),
                                                       *_set(group["set"][j], group["weights"][j])) >= threshold - ROUNDING:
                    a.append(int(rid[i]))
                    b.append(int(rid[j]))
                    label[label == label[j]] = label[i]
        return a, b

    def run(batches):
        held: dict[str, list] = {}

        def finish():
            a, b = compare(held)
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in names}
            for i in range(batch.num_rows):
                if held and any(held[c][0] != cols[c][i] for c in ("key", "p", "q")):
                    yield finish()
                    held = {}
                for c in names:
                    held.setdefault(c, []).append(cols[c][i])
        if held:
            yield finish()

    grouped = dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return grouped.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
            threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``rid, doc_id, digest, class_id, class_size, n_texts, kept``."""
    sig = signatures(docs, id_col, text_col, words, bands, rows)
    nodes = common.stored(sig.groupBy("digest").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies")))
    entries = sig.join(nodes.select("rid"), "rid", "left_semi").select("rid", F.posexplode("keys").alias("band", "key"))
    hubs = entries.groupBy("key").agg(F.min("rid").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    buckets = common.stored(entries.join(hubs, "key"))  # only buckets with company
    proposals = common.stored(buckets.filter("rid <> hub").select(F.col("rid").alias("a"), F.col("hub").alias("b")).distinct())
    meant = buckets.select("rid").distinct()
    wanted = sig.select("rid", "doc_id", "digest").join(meant, "rid", "left_semi")
    sets = _sets(docs, wanted, id_col, text_col, words)

    tried = common.stored(proposals.groupBy("a").agg(F.min("b").alias("b")))
    links = common.stored(_verified(tried, sets, threshold))
    labels = components(links)

    def labelled(df: DataFrame, col: str, name: str) -> DataFrame:
        own = labels.select(F.col("node").alias(col), F.col("label").alias(name))
        return df.join(own, col, "left").withColumn(name, F.coalesce(F.col(name), F.col(col)))

    rest = proposals.join(tried, ["a", "b"], "left_anti")
    rest = labelled(labelled(rest, "a", "la"), "b", "lb").filter("la <> lb").select("a", "b")
    links = common.stored(links.unionByName(_verified(rest, sets, threshold)))
    labels = components(links)
    open_ = common.stored(labelled(buckets.select("key", "band", "rid"), "rid", "label"))
    more = common.stored(_apart(open_, sig.select("rid", "registers"), sets, bands, rows, threshold, block))
    if not common.is_empty(more):
        links = links.unionByName(more)
        labels = components(links)

    members = sig.select("rid", "doc_id", "digest").join(nodes.select("digest", F.col("rid").alias("node")), "digest")
    members = common.stored(labelled(members, "node", "class"))
    per = members.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"),
                                       F.count(F.lit(1)).alias("class_size"), F.count(F.when(F.col("rid") == F.col("node"), 1)).alias("n_texts"))
    return members.join(per, "class").select(
        "rid", "doc_id", "digest", F.col("first.doc_id").alias("class_id"), "class_size", "n_texts",
        (F.col("rid") == F.col("first.rid")).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows that stay, one of each class, with the input's columns."""
    keep = classes(docs, id_col, text_col, **kw).filter("kept").select(
        F.col("doc_id").alias("__near_id"), F.col("digest").alias("__near_kept"))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    rows = docs.withColumn("__near_digest", digest)
    out = rows.join(keep, F.col(id_col).cast("long").eqNullSafe(F.col("__near_id")) & (F.col("__near_digest") == F.col("__near_kept")), "left_semi").drop("__near_digest")
    repeated = docs.groupBy(id_col).count().filter("count > 1")
    if common.is_empty(repeated):
        return out
    # Rows that repeat id and text: one of them.
    one = Window.partitionBy(id_col, "__near_digest").orderBy(F.col(text_col).isNull())
    out = rows.join(keep, F.col(id_col).cast("long").eqNullSafe(F.col("__near_id")) & (F.col("__near_digest") == F.col("__near_kept")), "left_semi")
    return out.withColumn("__near_n", F.row_number().over(one)).filter("__near_n = 1").drop("__near_n", "__near_digest")


def op5_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class, the class's size, and whether it stays."""
    out = classes(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "n_texts", "kept")
