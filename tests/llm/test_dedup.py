"""Exact dedup, near-dedup, line dedup, components."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import make  # noqa: F401
from dbtelemetry.llm import exact_dedup, graph, line_dedup, minhash_dedup

ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b " * 40_000), (6, "b " * 40_000), (7, "c"), (7, "c"), (None, "a"), (8, "A")]


def test_exact_groups(spark, make):
    out = exact_dedup.groups(make(ROWS)).collect()
    assert len(out) == len(ROWS)
    got = {(r.doc_id, r.text_sha256): r for r in out}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for doc, text, keep, size in [(1, "a", 2, 3), (None, "a", 2, 3), (3, "", 4, 2), (5, "b " * 40_000, 6, 2), (7, "c", 7, 2), (8, "A", 8, 1)]:
        r = got[doc, sha(text)]
        assert (r.keep_id, r.group_size) == (keep, size)
    kept = [r.doc_id for r in out if r.kept]
    assert sorted(kept) == [2, 4, 6, 7, 8]  # the repeated row stays once


def test_exact_groups_with_colliding_digests(make):
    one = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    rows = [(i, f"text {i % 37}") for i in range(400)]
    a = exact_dedup.groups(make(rows), digest=one).select("doc_id", "keep_id", "group_size", "kept").collect()
    b = exact_dedup.groups(make(rows)).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(a) == sorted(b)


def test_exact_winners_keep_columns(make):
    docs = make(ROWS)
    out = exact_dedup.winners(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 4, 6, 7, 8]
    only_null = exact_dedup.winners(make([(9, None)])).collect()
    assert only_null[0].text is None


def test_empty_tables(make):
    docs = make([])
    assert exact_dedup.groups(docs).count() == 0 and exact_dedup.winners(docs).count() == 0
    assert minhash_dedup.classes(docs).count() == 0 and minhash_dedup.kept_rows(docs).count() == 0
    assert line_dedup.clean(docs).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (7, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 7: 5, 9: 5}


def test_similarity_is_probability_jaccard():
    rng = np.random.default_rng(0)
    for _ in range(30):
        a = np.unique(rng.integers(0, 40, 25).astype(np.uint64))
        b = np.unique(rng.integers(0, 40, 25).astype(np.uint64))
        wa, wb = 1 + rng.random(len(a)), 1 + rng.random(len(b))
        da = dict(zip(a.tolist(), wa / wa.sum()))
        db = dict(zip(b.tolist(), wb / wb.sum()))
        want = sum(1 / sum(max(da.get(y, 0) / da[x], db.get(y, 0) / db[x]) for y in da.keys() | db.keys()) for x in da.keys() & db.keys())
        assert abs(minhash_dedup.similarity(a, wa, b, wb) - want) < 1e-12
    ones = np.ones(3)
    assert minhash_dedup.similarity(np.array([1, 2, 3], np.uint64), ones, np.array([2, 3, 4], np.uint64), ones) == 0.5


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    sets, weights = [], []
    x = rng.integers(1, 2**62, 400).astype(np.uint64)
    for lo in (0, 40):
        s = np.sort(x[lo:lo + 360])
        sets.append(s)
        weights.append(1 + rng.random(len(s)) * 0)
    reg = minhash_dedup.sketch(sets, weights, 2000)
    assert abs((reg[0] == reg[1]).mean() - minhash_dedup.similarity(sets[0], weights[0], sets[1], weights[1])) < 0.05
    alone = minhash_dedup.sketch([x[:1]], [np.ones(1)], 64)
    assert (alone == x[0]).all()


def near_copies(seed, groups, size, words=120):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randrange(6)):
                t[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(t))
    rng.shuffle(rows)
    return rows


def brute(texts):
    sets = [minhash_dedup.shingles(t) for t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or minhash_dedup.similarity(*sets[i], *sets[j]) >= 0.8 - 1e-12:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_classes_match_brute_force(make):
    texts = near_copies(5, 4, 20) + ["", "", "x y", "x y", "x z", "one two three four five"] + near_copies(6, 30, 1)
    want = brute(texts)
    for block in (1024, 4):  # small blocks: buckets are compared part by part
        out = minhash_dedup.classes(make(list(enumerate(texts))), block=block).collect()
        got = {r.doc_id: r.class_id for r in out}
        assert [got[i] for i in range(len(texts))] == want
        assert sorted(r.doc_id for r in out if r.kept) == sorted(set(want))
        size = Counter(want)
        assert all(r.class_size == size[r.class_id] for r in out)


def test_near_dedup_nulls_and_repeats(make):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make([(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "w " * 60_000)])
    out = minhash_dedup.kept_rows(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text is None) for r in out.collect()) in ([(1, False), (2, True), (4, False)],)


def lines_brute(docs):
    """Template tree and recurrence in plain Python."""
    variable = lambda t: any(c in "0123456789@/" for c in t)
    lines, docs_of = [], defaultdict(set)
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            tokens = line.split()
            if not all(map(variable, tokens)):
                tokens = ["<*>" if variable(t) else t for t in tokens]
            if tokens:
                lines.append((doc, k, tuple(tokens)))
                docs_of[tuple(tokens)].add(doc)
    leaves = defaultdict(list)
    for t in docs_of:
        m = len(t) - 3
        for q in range(4):
            part = t[3 + q * m // 4:3 + (q + 1) * m // 4]
            if m >= 4 and any(not variable(x) and x != "<*>" for x in part):
                leaves[len(t), t[:3], q, part].append(t)
    templates = [[t] for t in docs_of]
    for (n, *_), own in leaves.items():
        anchor = max(own, key=lambda t: (len(docs_of[t]), " ".join(t)))
        templates.append([t for t in own if sum(a == b for a, b in zip(t[3:], anchor[3:])) >= 0.7 * (n - 3)])
    gone = set()
    for own in templates:
        found = set().union(*(docs_of[t] for t in own))
        if len(found) >= 5 or len(found) >= 2 and len(own[0]) > 50:
            gone.update((d, k) for d, k, t in lines if t in set(own) and d != min(found))
    return gone


def test_lines_match_brute_force(make):
    rng = random.Random(2)
    parts = ["user {} logged in from host now at once", "job for {} ended and {} began to run there", "one two three {} {} {} {} end", "copyright {} all rights reserved here", "a b c", "", "   ",
             " ".join(f"p{i}" for i in range(60))]
    docs = []
    for d in range(40):
        text = "\n".join([rng.choice(parts).format(*rng.choices(["x7", "bob", "12", "a@b", "eve"], k=4)) for _ in range(5)] + [f"own line number {chr(97 + d % 26)}{chr(97 + d // 26)} k"])
        docs.append((d, text))
    docs += [(40, None), (41, ""), (42, "z " * 30_000)]
    gone = lines_brute(docs)
    assert gone
    got = {r.doc_id: r for r in line_dedup.clean(make(docs)).collect()}
    for d, text in docs:
        all_ = (text or "").split("\n")
        assert got[d].text == "\n".join(x for k, x in enumerate(all_) if (d, k) not in gone)
        assert got[d].n_dropped == sum(1 for x in gone if x[0] == d)
        assert got[d].n_lines == sum(1 for x in all_ if x.strip())


def dropped(make, lines):
    return [r.doc_id for r in line_dedup.clean(make(list(enumerate(lines)))).collect() if r.n_dropped]


def test_unlike_short_lines_stay(make):
    ends = ["came home", "came away", "went home", "sat home", "lay home", "ran home"]
    assert dropped(make, [f"the old man {e}" for e in ends]) == []
    assert dropped(make, ["12 44 99", "71 2 3", "1 1 1", "5 6 7", "88 1 0"]) == []
    assert sorted(dropped(make, ["12 44 99"] * 5)) == [1, 2, 3, 4]


def test_two_families_of_one_leaf(make):
    one = "at that time the water rose over the low banks of the river near old {}"
    two = "at that time all seven ships left with salt and corn bound for the port {}"
    lines = [one.format(w) for w in "abcdefg"] + [two.format(w) for w in "hijklm"] + ["at that time nothing like either of them was to be seen in any street at all"]
    assert sorted(dropped(make, lines)) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12]


def test_lines_repeated_rows_and_null_ids(make):
    long = " ".join(f"q{i}" for i in range(55))
    out = line_dedup.clean(make([(1, long), (1, long), (2, long), (None, long)])).collect()
    assert sorted((r.doc_id or 99, r.n_dropped) for r in out) == [(1, 0), (1, 0), (2, 1), (99, 1)]


def test_line_dedup_is_native(make):
    plan = line_dedup.clean(make([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
