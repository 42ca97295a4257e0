"""Nearest neighbours, sharding, mixing, the pipeline and the registered queries."""

import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import make  # noqa: F401
from dbtelemetry.llm import bpe, langid, minhash_dedup, mixing, nearest, sharding

SF_SMALL = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")


def test_nearest_finds_most_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[1000:1300] = x[0]  # a hot vector, split into blocks
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = vectors(spark, rows)
    out = nearest.search(df, df.filter("vec_id % 50 = 0"), block=64, query_block=8).collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 50):
        s = u @ u[q]
        s[q] = -9
        s = np.round(s, 12)
        best = np.lexsort((np.arange(1500), -s))[:5]
        assert len(got[q]) == 5
        assert all(abs(s[v] - c) < 1e-9 for v, c in got[q])
        hits += len({v for v, _ in got[q]} & set(best.tolist()))
    assert hits / 150 >= 0.9
    # Ties: the smaller ids, nearest first.
    assert [v for v, _ in got[1000]] == [0, 1001, 1002, 1003, 1004]


def test_nearest_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
            (7, [1.0, 1.0, 1.0]), (8, [1e30, 1.0]), (50, [0.0, 3.0]), (1, [2.0, 0.0]), (None, [1.0, 0.0]), (100, [])]
    df = vectors(spark, rows)
    out = nearest.search(df, df.filter("vec_id % 50 = 0")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    assert got[0][:2] == [1, 8] and set(got) <= {0, 50}
    assert nearest.search(df.limit(0), df.limit(0)).count() == 0


def test_nearest_gives_all_that_there_are(spark):
    """Queries whose neighbours are nearly opposite still get five, or all candidates."""
    rng = np.random.default_rng(3)
    x = np.concatenate([[np.ones(12)], -np.ones((8, 12)) + rng.normal(0, 0.05, (8, 12))])
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [(100, [1.0, 2.0]), (101, [-1.0, -2.0]), (102, [-2.0, 1.0])])
    out = nearest.search(df, df.filter("vec_id % 50 = 0")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert got[0] == (1 + np.argsort(-(u[1:] @ u[0]), kind="stable")[:5]).tolist()
    assert got[100] == [102, 101]


def test_shards_fit_and_are_minimal(make):
    rows = [(i, "x" * (i % 97)) for i in range(3000)] + [(5000, None), (None, "abc"), (7000, "y" * 5000), (8000, "z" * 900), (8000, "z" * 900)]
    out = sharding.shards(make(rows), limit=1500).collect()
    assert len(out) == len(rows)
    size = defaultdict(int)
    for r in out:
        size[r.shard] += r.bytes
    for r in out:
        assert size[r.shard] == r.shard_bytes and len(r.shard) == r.depth
        assert r.shard_bytes <= 1500 or r.over_limit
    assert {r.doc_id for r in out if r.over_limit} == {7000, 8000}
    # Every bucket's parent is too large, and no bucket is the prefix of another.
    for s in size:
        if s:
            assert sum(n for t, n in size.items() if t.startswith(s[:-1])) > 1500
        assert not any(t != s and t.startswith(s) for t in size)
    assert sharding.shards(make([])).count() == 0
    assert [r.shard for r in sharding.shards(make([(1, "a"), (2, "b")])).collect()] == ["", ""]


def test_shards_are_written(spark, make, scratch):
    sharding.write(make([(i, "x" * 100) for i in range(200)]), scratch + "/out", limit=2000)
    back = spark.read.parquet(scratch + "/out")
    assert back.count() == 200
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] <= 2000


def fill(sizes, weights, cap):
    """Targets by repeated resharing."""
    target, free, rest = {}, set(sizes), sum(sizes.values())
    while free:
        w = sum(weights[s] for s in free)
        share = {s: rest * weights[s] / w for s in free}
        over = {s for s in free if share[s] >= cap * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = cap * sizes[s]
            rest -= cap * sizes[s]
        free -= over
    return target


def test_mixing_targets_and_takes(make):
    rows, n = [], 0
    for s, docs in (("é", 900), ("a", 12), ("b", 30), (None, 60), ("c", 200), ("z", 1)):
        for _ in range(docs):
            rows.append((n, " ".join(["w"] * (n * 7919 % 60)), "en", s))
            n += 1
    rows += [(n, None, "en", "a"), (n + 1, "", "en", "empty"), (3, rows[3][1], "en", "é"), (None, "w w", "en", "a")]
    docs = make(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    words = {}
    out = mixing.mix(docs, range_rows=50).collect()
    assert len(out) == len(rows)
    source = {r[0]: r[3] for r in rows}
    for i, t, _, s in rows:
        size[s] += len((t or "").split())
        words[i] = len((t or "").split())
    for r in out:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        assert r.size == words[r.doc_id] and r.source_size == size[s]
        assert r.taken <= 3 * r.size and len(r.positions) * r.size == r.taken
        assert r.positions == sorted(r.positions) and all(0 < p < 1 for p in r.positions)
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = fill({s: size[s] for s in size if size[s]}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    for s in size:
        assert math.isclose(target[s], want.get(s, 0), rel_tol=1e-9, abs_tol=1e-9)
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.mix(docs, range_rows=17).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert mixing.mix(make([])).count() == 0


def test_mixing_follows_schedules(make):
    """Up to any time, a source has spent its share of its integrated schedule."""
    docs = make([(i, "w " * 10, "en", "ab"[i % 2]) for i in range(2000)])
    out = mixing.mix(docs, weights=(1, 1), slopes=(-0.5, 0.5), max_epochs=1).collect()
    for part, slope in ((0, -0.5), (1, 0.5)):
        at = sorted(p for r in out if r.doc_id % 2 == part for p in r.positions)
        for u in (0.25, 0.5, 0.75):
            share = (1 - slope) * u + slope * u * u
            assert abs(sum(p < u for p in at) / len(at) - share) < 0.01


def test_sequence_is_sorted(make):
    docs = make([(i, "w " * (i % 9), "en", "abc"[i % 3]) for i in range(300)])
    out = mixing.sequence(docs, payload=("doc_id", "text")).collect()
    assert [r.position for r in out] == sorted(r.position for r in out)
    assert all(r.text == "w " * (r.doc_id % 9) for r in out)


def test_registered(spark):
    import __spark_entry__ as entry

    qs = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in qs) for n in range(1, 14)) and "pipeline" in qs


def test_pipeline_against_its_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.train(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    names, scores = model.scorer().predict([rows[i].text for i in sorted(rows)])
    keep = [i for i, n, s in zip(sorted(rows), names, scores) if n != "und" and s >= 0.5]
    last = {}
    for i in keep:
        last[rows[i].text] = max(i, last.get(rows[i].text, i))
    ids = sorted(last.values())
    sets = {i: minhash_dedup.shingles(rows[i].text) for i in ids}
    label = {i: i for i in ids}
    for a in ids:  # links go from the smaller id: repeated until stable
        for b in ids:
            if a < b and minhash_dedup.similarity(*sets[a], *sets[b]) >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    first = sorted(set(label.values()))
    taken = {r.doc_id: len(r.positions) for r in mixing.mix(docs.filter(F.col("doc_id").isin(first))).collect()}
    out = cp.run(spark, SF_SMALL).collect()
    count = defaultdict(int)
    vocab = bpe.vocabulary()
    for r in out:
        count[r.doc_id] += 1
        assert vocab.decode(np.frombuffer(r.ids, "<u4")) == rows[r.doc_id].text and r.n_tokens * 4 == len(r.ids)
    assert dict(count) == {i: n for i, n in taken.items() if n}


def test_pipeline_stages_on_odd_input(spark, make):
    import corpus_pipeline as cp

    docs = make([(1, None, None, None), (2, "", "en", None), (3, "the thing", "en", "a"), (3, "the thing", "en", "a"), (None, "that of", "en", None)])
    for start in (docs, docs.limit(0)):
        step = start
        for k, (_, stage) in enumerate(cp.STAGES):
            step = stage(spark, step, SF_SMALL)
            if k < 4:
                assert step.columns == list(cp.COLUMNS)
        step.collect()
