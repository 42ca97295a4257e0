"""Suffix arrays and what rests on them: periodic runs and decontamination, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_helpers import by_id, make  # noqa: F401
from dbtelemetry.llm import decontamination, runs, suffixes

SF_SMALL = "/root/testdata/sf0.001"


def brute_runs(words, times=4, least=6):
    """All maximal repetitions: per period the stretches of equal words that far apart, smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, times * q):
                found.setdefault((s, length), q)  # a multiple of the period has the same stretch
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_collapse(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plant(doc, words):
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_split():
    texts = ["Ab, cd", "ef", "", None, " \x0bgh\xa0ü-1 ", "i"]
    words, bounds = suffixes.split(pa.array(texts), suffixes.ALPHANUMERIC, lower=True)
    assert [w.decode() for w in words.to_pylist()] == ["ab", "cd", "ef", "gh\xa0ü", "1", "i"]
    assert bounds.tolist() == [0, 2, 3, 3, 3, 5, 6]
    words, bounds = suffixes.split(pa.array(texts)[1:5], suffixes.PRINTED)
    assert [w.decode() for w in words.to_pylist()] == ["ef", "gh\xa0ü-1"] and bounds.tolist() == [0, 1, 1, 1, 2]
    assert len(suffixes.split(pa.array(["", None]), suffixes.PRINTED)[0]) == 0


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 60)
        x = [rng.randint(0, rng.choice([1, 2, 6])) for _ in range(n)] + [99]
        s = suffixes.Suffixes(np.array(x, np.int64), keep=True)
        assert s.order.tolist() == sorted(range(n + 1), key=lambda i: x[i:])
        assert s.place[s.order].tolist() == list(range(n + 1))
        for _ in range(20):
            a, b = sorted(rng.sample(range(n + 1), 2))
            k = 0
            while b + k <= n and x[a + k] == x[b + k]:
                k += 1
            assert s.common_prefix(np.array([a]), np.array([b]))[0] == k
            k = 0
            while a - k > 0 and x[a - k - 1] == x[b - k - 1]:
                k += 1
            assert s.common_before(np.array([a]), np.array([b]))[0] == k


def test_nearest_smaller():
    rng = random.Random(5)
    for _ in range(50):
        v = [-1] + [rng.randint(0, 4) for _ in range(rng.randint(0, 30))] + [-1]
        left, right = suffixes.smaller_before(np.array(v)), suffixes.smaller_after(np.array(v))
        for k in range(1, len(v) - 1):
            assert left[k] == max(j for j in range(k) if v[j] < v[k])
            assert right[k] == min(j for j in range(k + 1, len(v)) if v[j] < v[k])


def test_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            size = rng.choice([1, 2, 3, 9])
            words = [rng.randint(0, size) for _ in range(rng.randint(0, 70))]
            if rng.random() < 0.6 and words:
                unit = words[:rng.randint(1, 9)]
                at = rng.randint(0, len(words))
                words[at:at] = unit * rng.randint(2, 9) + unit[:rng.randint(0, len(unit))]
            texts.append(words)
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        flat = np.array([w for t in texts for w in t], np.int64)
        for times, least in ((4, 6), (2, 2)):
            text, start, length, period = runs.find(flat, bounds, times, least)
            for k, t in enumerate(texts):
                own = text == k
                got = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist()))
                assert sorted(got) == brute_runs(t, times, least)
                assert [(g[0], g[2]) for g in got] == sorted((g[0], g[2]) for g in got)


def test_collapse_odd_rows(spark, make):
    rows = [(1, "a b " * 9), (2, None), (3, ""), (4, " \n\t"), (5, "x " * 50_000 + "y"), (6, "a b c"), (6, "a b c"), (None, "q q q q q q")]
    out = runs.collapse(make(rows))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted([
        (1, 18, [(0, 18, 2)], "a b"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 50_001, [(0, 50_000, 1)], "x y"),
        (6, 3, [], "a b c"), (6, 3, [], "a b c"), (None, 6, [(0, 6, 1)], "q")], key=str)
    assert runs.collapse(make([])).count() == 0


def test_registered_runs_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in docs:
        words = plant(r.doc_id, [w.decode() for w in (r.text or "").encode().split()])
        found = brute_runs(words)
        s, length, q = max(found, key=lambda f: (f[1], -f[0], -f[2])) if found else (None, None, None)
        want[r.doc_id] = (len(found), s, length, q, 1000 * length // q if found else None,
                          sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda f: (f[0], f[2])))),
                          sha(brute_collapse(words, found)))
    got = by_id(runs.op12_periodic_runs(spark, SF_SMALL), "n_runs", "start", "length", "period", "exponent_milli",
                "runs_sha256", "collapsed_sha256")
    assert got == want and sum(v[0] > 0 for v in want.values()) > 5


def brute_contaminated(text, items, window=10):
    words_of = lambda t: [w.decode() for w in suffixes.split(pa.array([t]), suffixes.ALPHANUMERIC, lower=True)[0].to_pylist()]
    words, hit, names = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        k = min(window, len(own))
        for s in range(len(own) - k + 1) if k else ():
            for i in range(len(words) - k + 1):
                if words[i:i + k] == own[s:s + k]:
                    hit.update(range(i, i + k))
                    if item is not None:
                        names.add(item)
    return len(words), len(hit), sorted(names)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, rid string, n int")


def test_contaminated_against_brute_force(spark, make):
    rng = random.Random(2)
    for size, window in ((2, 3), (5, 4), (40, 10)):
        word = lambda: rng.choice(["Ab", "c'", "dé", "9", "e-f"] + [f"w{k}" for k in range(size)])  # noqa: B023, E731
        items = [(i % 17, " ".join(word() for _ in range(rng.choice([0, 1, 3, 12, 30])))) for i in range(20)]
        items += [(30, None), (31, " - "), (None, "alpha beta gamma"), (32, "w1 " * 40)]
        docs = [(1, None), (2, ""), (3, "W1 " * 60), (None, "x Alpha, beta; gamma"), (7, "dup " + (items[3][1] or "z")), (7, "dup " + (items[3][1] or "z"))]
        for d in range(10, 60):
            words = [word() for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.5:
                body = rng.choice(items)[1] or ""
                words[3:3] = body.split()
            docs.append((d, " ".join(words)))
        want = sorted((str(d), *brute_contaminated(t or "", items, window)) for d, t in docs)
        for shard, block in ((1_000_000, 1_000_000), (50, 150)):
            out = decontamination.contaminated(make(docs), items_frame(spark, items), window=window, shard=shard, block=block)
            got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in out.collect())
            assert got == want
    kept = decontamination.clean(make(docs), items_frame(spark, items), window=window)
    assert kept.columns == make(docs).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(w[0] for w in want if not w[2])


def test_long_texts_are_cut_with_overlap(spark, make):
    rng = random.Random(4)
    long = [f"a{rng.randint(0, 30)}" for _ in range(400)]
    items = [(1, " ".join(long[90:300])), (2, "zz " * 50)]
    docs = [(1, " ".join(long)), (2, " ".join(long[:95] + ["b"] * 30 + long[200:214])), (3, "zz " * 9), (4, "zz " * 33)]
    # The first window that crosses a cut must still be found, and nothing counted twice.
    out = decontamination.contaminated(make(docs), items_frame(spark, items), shard=30, block=35, piece=40, overlap=12)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in out.collect()}
    assert got == {d: brute_contaminated(t, items) for d, t in docs}


def test_longest_matches(spark, make):
    docs = [(1, "p q r s t u"), (2, "x q r s y"), (3, "no"), (4, None), (5, "q r s x q r s")]
    items = [(1, "a Q R s z"), (2, "no yes"), (3, "absent"), (4, None)]
    got = sorted(tuple(r) for r in decontamination.longest_matches(make(docs), items_frame(spark, items)).collect())
    assert got == [(1, 1, 3, 1, 1), (1, 1, 3, 2, 1), (1, 1, 3, 5, 0), (1, 1, 3, 5, 4), (2, 0, 1, 3, 0)]


def test_contamination_of_empty_tables(spark, make):
    docs, items = make([(1, "a b"), (2, None)]), items_frame(spark, [(1, "a b")])
    assert decontamination.contaminated(make([]), items).count() == 0
    got = by_id(decontamination.contaminated(docs, items.limit(0)), "n_words", "n_hit", "items")
    assert got == {1: (2, 0, []), 2: (0, 0, [])}
    assert decontamination.clean(make([]), items.limit(0)).count() == 0
    assert decontamination.longest_matches(docs, items.limit(0)).count() == 0
