"""Language ID, LM scoring, toxicity, BPE."""

import binascii
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from llm_helpers import make  # noqa: F401
from pyspark.sql import functions as F
from dbtelemetry.llm import bpe, common, langid, lm, toxicity

EN = "the of and that this nation reading with from thing".split()
FR = "le la de une que nous réseau avec pour été".split()


def prose(words, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def corpus():
    rows = [(i, prose(EN if i % 2 else FR, 40, i), "en" if i % 2 else "fr") for i in range(80)]
    return rows + [(100, None, "en"), (101, "", "en"), (102, "123 !!", None), (103, prose(EN, 30_000, 9), "en"), (104, "le " * 3, None), (104, "le " * 3, None)]


def test_forward_sums_all_segmentations():
    names = [langid.MARK, langid.MARK + "a", "a", "ab", "b", "ba"]
    rng = np.random.default_rng(0)
    prob = rng.random((len(names) + 2, 2))
    prob[-1] = 0
    index = {p: i for i, p in enumerate(names)}
    scorer = langid.Scorer(langid.Model(["x", "y"], names, prob))

    def every(s):
        if not s:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(s) + 1):
            p = prob[index[s[:n]]] if s[:n] in index else prob[-2] if n == 1 else None
            if p is not None:
                total = total + p * every(s[n:])
        return total

    words = ["a", "abab", "bab", "cab", "aaaaaaa"]
    assert np.allclose(scorer.words(words), [np.log(every(langid.MARK + w)) for w in words])
    # Long words are scaled step by step: the same sums, and no underflow.
    word = "ab" * 30
    assert np.allclose(scorer.words([word])[0], np.log(every_fast(names, prob, langid.MARK + word)))
    assert np.isfinite(scorer.words(["ab" * 3000])).all()


def every_fast(names, prob, s):
    index = {p: i for i, p in enumerate(names)}
    f = [np.ones(2)] + [np.zeros(2) for _ in s]
    for e in range(1, len(s) + 1):
        for b in range(max(0, e - 16), e):
            x = s[b:e]
            p = prob[index[x]] if x in index else prob[-2] if len(x) == 1 else None
            if p is not None:
                f[e] = f[e] + f[b] * p
    return f[-1]


def test_language(make):
    docs = make(corpus())
    model = langid.train(docs, common.remainder("doc_id", 4) != 2)
    assert model.langs == ["en", "fr"]
    out = langid.with_language(docs, model).collect()
    assert len(out) == docs.count()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    right = [got[i][0] == lang for i, text, lang in corpus() if lang and text]
    assert sum(right) / len(right) > 0.95
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[104][0] == "fr"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_language_without_labels(make):
    docs = make([(1, "text"), (2, None)])
    model = langid.train(docs, common.remainder("doc_id", 4) != 2)
    assert model is None
    assert {r.lang_pred for r in langid.with_language(docs, model).collect()} == {"und"}


def tokens(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def test_lm_base_and_model(make):
    rows = corpus() + [(200, "The THE the É x\x1cy"), (None, "the of")]
    held = lambda d: d is not None and binascii.crc32(str(d).encode()) % 10 == 0
    docs = make(rows)
    out = lm.scores(docs, common.remainder("doc_id", 10) == 0, classes=8, chunk=5000).collect()
    assert len(out) == len(rows)
    count = Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    total, v = sum(count.values()), len(count)
    for r in out:
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        own = tokens(text)
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (v + 1))) for t in own)
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base))
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(own), sum(count[t] > 0 for t in own), total, held(r.doc_id))
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # contexts tell the language


def test_lm_is_normalised():
    words = [b"a", b"b", lm.END]
    model = lm.new_model(words, [5, 4, 3], 20, 6)
    known = {b"a": 5, b"b": 4, lm.END: 3, b"c": 4, b"d": 3, b"e": 1}
    ctx = np.array([model.ids(b"c")[1], model.ids(b"a")[1], 0])
    total = 0.0
    for w, c in [*known.items(), (b"never seen", 0)]:
        cls = model.ids(w)[0]
        lp = lm.log_probabilities(model, np.array([0, 0, cls]), ctx, np.array([0]))[-1]
        total += math.exp(lp) * ((c + 0.1) / model.other_mass if cls == len(words) else 1.0)
    assert abs(total - 1) < 1e-5


def test_lm_model_size():
    model = lm.new_model([b"%d" % i for i in range(lm.CLASSES)], [1] * lm.CLASSES, 2 * lm.CLASSES, 2 * lm.CLASSES)
    assert model.classes >= 1001 and model.p["word"].shape[1] >= 24 and lm.NOISE >= 64


def test_lm_repeated_vocabulary_rows():
    model = lm.new_model([b"a", b"b", lm.END], [5, 4, 3], 20, 6)
    docs = pd.DataFrame({"doc_id": [1], "held_out": [False], "text": ["c a b"]})
    words = pd.DataFrame({"word": [b"a", b"b", b"c", lm.END], "c": [5, 4, 4, 3]})
    once = lm.score_chunk(model, docs, words)
    assert lm.score_chunk(model, docs, pd.concat([words, words])).equals(once)


def test_lm_buckets_are_normalised_and_learn(spark):
    assert lm.group_size(4_000_000) > lm.group_size(400_000) > 1
    count = {b"w%d" % i: 1 + i % 7 for i in range(3000)} | {lm.END: 500, b"the": 900}
    table = spark.createDataFrame(list(count.items()), "word binary, c long")
    words = [b"the", lm.END]
    mass = lm.count_buckets(table, words, lm.group_size(10_000))
    model = lm.new_model(words, [900, 500], sum(count.values()), len(count), mass=mass)
    assert abs(mass.sum() - (model.other_mass - 0.1)) < 1e-6 and (mass == 0).any()

    def chances(model, before):
        known = pd.DataFrame({"word": [*count], "c": [*count.values()]})
        both = np.array([model.ids(w)[0] for w in count], np.int64)
        first = model.ids(before.encode())
        flat = np.stack([np.full(len(both), first[0]), both], axis=1).reshape(-1)
        ctx = np.stack([np.full(len(both), first[1]), both], axis=1).reshape(-1)
        lp = lm.log_probabilities(model, flat, ctx, np.arange(len(both)) * 2)[1::2]
        inner = both >= len(words)
        lp[inner] += np.log((known["c"].to_numpy()[inner] + 0.1) / mass[both[inner] - len(words)])
        return dict(zip(known["word"], np.exp(lp)))

    before = chances(model, "the")
    assert abs(sum(before.values()) - 1) < 1e-4
    trainer = lm.Trainer(model, 0)
    for _ in range(10):
        trainer.texts(["the w17 w1234"] * 300)
    known = pd.DataFrame({"word": [b"the", b"w17", b"never", lm.END], "c": [900, count[b"w17"], 0, 500]})
    one = lambda text: lm.score_chunk(trainer.model, pd.DataFrame({"doc_id": [1], "held_out": [True], "text": [text]}), known).iloc[0]
    assert one("the w17").score > one("the w17").base_score and one("never").n_known == 1
    after = chances(trainer.model, "the")
    assert abs(sum(after.values()) - 1) < 1e-4
    assert after[b"w17"] > 3 * before[b"w17"] and after[b"w17"] > 3 * after[b"w1234"]  # rare tokens are told apart by context


def test_lm_without_training_rows(make):
    zero = next(i for i in range(1000) if binascii.crc32(str(i).encode()) % 10 == 0)
    r = lm.scores(make([(zero, "a b")]), common.remainder("doc_id", 10) == 0).collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in r] == [(3, 0, 0, 0.0, 0.0)]
    assert lm.scores(make([]), common.remainder("doc_id", 10) == 0).count() == 0


def test_toxicity_gradients():
    rng = np.random.default_rng(1)
    net = toxicity.Network({f"w{i}": i + 1 for i in range(5)}, np.zeros(5))
    net.p = {k: a.astype(np.float64) for k, a in net.p.items()}
    words, at = toxicity._places([[f"w{rng.integers(8)}" for _ in range(int(rng.integers(1, 9)))] for _ in range(6)])
    y = np.array([0, 1, 0, 1, 1, 0.0])
    grad = net.gradients(words, at, y)

    def loss():
        logit, _ = net.forward(*net.projected(net.inputs(words)[0]), at)
        p = 1 / (1 + np.exp(-logit))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k, a in net.p.items():
        flat = a.reshape(-1)
        i = int(np.argmax(np.abs(grad[k].reshape(-1))))
        old = flat[i]
        flat[i] = old + 1e-3
        up = loss()
        flat[i] = old - 1e-3
        down = loss()
        flat[i] = old
        assert abs((up - down) / 2e-3 - grad[k].reshape(-1)[i]) < 1e-4


def test_toxicity_windows_cover_texts():
    for n in range(0, 200):
        seen = {w for s in toxicity.starts(n) for w in range(s, min(n, s + toxicity.WINDOW))}
        assert seen == set(range(n))


def test_toxicity(spark, make):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        w = prose(EN, 100, i).split()
        if i % 5 == 0:
            for _ in range(4):
                w[rng.randrange(100)] = rng.choice(["vile", "scum", "rot"])
        rows.append((i, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "!!"), (903, prose(EN, 40_000, 1)), (0, rows[0][1])]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(5, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    docs = make(rows)
    model = toxicity.train(docs, labels, common.remainder("doc_id", 3) != 1)
    got = {r.doc_id: r.score for r in toxicity.with_toxicity(docs, model).collect()}
    held = [i for i in range(400) if binascii.crc32(str(i).encode()) % 3 == 1]
    right = [(got[i] >= 0.7) == (i % 5 == 0) for i in held]
    assert sum(right) / len(right) > 0.97, [(i, got[i]) for i, ok in zip(held, right) if not ok]
    assert got[900] == got[901] == got[902] == 0.0 and got[903] < 0.7
    none = toxicity.train(docs, labels.limit(0), common.remainder("doc_id", 3) != 1)
    assert {r.score for r in toxicity.with_toxicity(docs, none).collect()} == {0.0}


def test_toxicity_sample_has_one_row_an_id(spark, make, monkeypatch):
    rows = [(1, "b vile"), (1, "a vile"), (1, "c vile"), (2, "the of"), (2, "the and")] + [(1, "b vile")] * 50
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, share: (texts, y))
    for own in (rows, rows[::-1]):
        assert toxicity.train(make(own), labels, F.lit(True)) == (["a vile", "the and"], [1, 0])


TEXTS = ["aaaaaaa aaaa", "<|endoftext|>x<|endoftext|>", " \n\n  a  \t b", "", "hello'sworld'll 12 345", "x" * 20_000, "é" * 5000,
         "日本語 текст \U0001f600‍\U0001f600", "a\x1cb\x85c d e", " " * 300, "ab " * 5000]


def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_library():
    ref = reference()
    vocab = bpe.vocabulary()
    rng = random.Random(7)
    texts = TEXTS + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0xD000), rng.randrange(0xE000, 0x2FFFF)])) for _ in range(60)) for _ in range(300)]
    want = ref.encode_batch(texts, add_special_tokens=False)
    for chunk in (7, 1_000_000):
        got = bpe.Encoder(vocab, chunk).encode(texts)
        for t, g, w in zip(texts, got, want, strict=True):
            ids = np.frombuffer(g, "<u4")
            assert ids.tolist() == w.ids, t[:30]
            assert vocab.decode(ids) == ref.decode(w.ids, skip_special_tokens=False) == t


def test_bpe_frame(make):
    rows = [*enumerate(TEXTS), (50, None), (0, TEXTS[0]), (None, "x")]
    enc = bpe.encode(make(rows), decoded=True)
    got = {r.doc_id: r for r in bpe.digests(enc).collect()}
    ref = reference()
    for i, t in rows:
        ids = ref.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    back = {r.doc_id: r.text for r in bpe.decode(enc).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    assert bpe.encode(make([])).count() == 0


def test_language_scores_do_not_jump_with_length():
    """One more unknown letter costs about the same at any length; very long words stay finite."""
    words = {"the": 500, "then": 80, "of": 300, "and": 400, "with": 100}
    model = langid.fit({"a": {w: n * 1000 for w, n in words.items()}, "b": {w[::-1]: n * 1000 for w, n in words.items()}}, langid.pieces())
    scorer = model.scorer()
    lengths = [1, 2, 37, 38, 39, 40, 41, 45, 300, 5000]
    got = scorer.words(["Ж" * n for n in lengths])
    assert np.isfinite(got).all()
    step = got[1] - got[0]
    for n, row in zip(lengths, got):
        assert np.allclose(row, got[0] + step * (n - 1), rtol=1e-6)
    long = scorer.words(["the" * 2000, "eht" * 2000])
    assert np.isfinite(long).all() and long[0, 0] > long[0, 1] and long[1, 1] > long[1, 0]


def test_language_id_of_an_empty_table(make):
    docs = make([])
    model = langid.train(docs, F.lit(True))
    assert model is None and langid.with_language(docs, model).count() == 0


def scalar_logit(net, window):
    """The network's logit of one window, one number at a time."""
    h_n, p = toxicity.HIDDEN, {k: v.astype(float) for k, v in net.p.items()}
    dot = lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b))
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    inputs = []
    for w in window:
        codes = [ord(c) for c in w]
        rows = [p["char"][(c * 131 + (1 if i == 0 else codes[i - 1]) * 7919) % toxicity.CHARS] for i, c in enumerate(codes)]
        inputs.append([*p["word"][net.vocab.get(w, 0)], *[sum(r[k] for r in rows) / len(rows) for k in range(toxicity.CHAR_DIM)]])
    states = {}
    for side, turn in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
        h = [0.0] * h_n
        for t in turn:
            g = [dot(inputs[t], p["w" + side][:, k]) + p["b" + side][k] for k in range(3 * h_n)]
            v = [dot(h, p["u" + side][:, k]) for k in range(3 * h_n)]
            z = [sigmoid(g[k] + v[k]) for k in range(h_n)]
            r = [sigmoid(g[k + h_n] + v[k + h_n]) for k in range(h_n)]
            n = [math.tanh(g[k + 2 * h_n] + r[k] * v[k + 2 * h_n]) for k in range(h_n)]
            h = [n[k] + z[k] * (h[k] - n[k]) for k in range(h_n)]
            states[side, t] = h
    both = [[*states["f", t], *states["b", t]] for t in range(len(window))]
    weight = [math.exp(dot(b, p["attend"])) for b in both]
    pooled = [sum(w * b[k] for w, b in zip(weight, both)) / sum(weight) for k in range(2 * h_n)]
    return dot(pooled, p["out"]) + float(p["bias"][0])


def test_toxicity_forward_against_scalars():
    rng = random.Random(9)
    words = ["the", "of", "vile", "scum", "naïve", "x", "longerword"]
    net = toxicity.Network({w: i + 1 for i, w in enumerate(words[:4])}, np.array([0.1, -0.2, 2.0, 1.5]), seed=3)
    windows = [[rng.choice(words) for _ in range(rng.randint(1, 7))] for _ in range(5)]
    seen, at = toxicity._places(windows)
    logit, _ = net.forward(*net.projected(net.inputs(seen)[0]), at)
    assert np.allclose(logit, [scalar_logit(net, w) for w in windows], atol=1e-4)
    # A text's logit is that of its largest window, whatever else is in the chunk.
    text = " ".join(rng.choice(words) for _ in range(toxicity.WINDOW * 2 + 7))
    scorer = toxicity.Model(0.0, net, np.array([0.0, 1.0, 0.0])).scorer()
    largest, count = scorer.logits(["of the", text, ""])
    own = [scalar_logit(net, w) for w in toxicity._windows(toxicity.words_of(text))]
    assert abs(largest[1] - max(own)) < 1e-4 and count.tolist()[1:] == [len(own), 0]


def test_toxicity_of_an_empty_table(spark, make):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(make([]), labels, F.lit(True))
    assert toxicity.with_toxicity(make([]), model).count() == 0


def test_lm_score_against_scalars():
    """Every token's probability by the definition: class among all classes, bucket in its group, share in its bucket."""
    count = {b"w%d" % i: 1 + i % 7 for i in range(400)} | {lm.END: 50, b"the": 90, b"of": 60}
    words = [b"the", b"of", lm.END]
    size = 5
    mass = np.zeros(lm.GROUPS * size)
    for w, c in count.items():
        if w not in words:
            mass[lm.bucket(w, lm.GROUPS, size)] += c + lm.SMOOTHING
    model = lm.new_model(words, [90, 60, 50], sum(count.values()), len(count), mass=mass)
    trainer = lm.Trainer(model, 0)
    trainer.texts(["the w1 of w2 w3", "of the w9"] * 50)
    p = {k: v.astype(float) for k, v in trainer.model.p.items()}
    text = "the w1 never of w2 w399 the the w7 unseen"
    own = [*text.encode().split(), lm.END]
    ids = [model.ids(w)[1] for w in own]
    want = 0.0
    for i, w in enumerate(own):
        if w not in count:
            want += math.log10(0.1 / (model.total + 0.1 * (model.distinct + 1)))
            continue
        r = sum(p["at"][j] * p["context"][ids[i - 1 - j] if i > j else model.start] for j in range(lm.CONTEXT))
        out = model.ids(w)[0]
        groups = model.mass.sum(axis=1)
        cls = out if out < 3 else 3 + (out - 3) // size
        logits = {k: r @ p["word"][k] + p["bias"][k] for k in range(model.classes) if k < 3 or groups[k - 3] > 0}
        want += (logits[cls] - math.log(sum(math.exp(v) for v in logits.values()))) / math.log(10)
        if out >= 3:
            g = (out - 3) // size
            inner = {k: r @ p["inner"][g * size + k] + p["inner_bias"][g * size + k] for k in range(size) if model.mass[g, k] > 0}
            want += (inner[(out - 3) % size] - math.log(sum(math.exp(v) for v in inner.values()))) / math.log(10)
            want += math.log10((count[w] + 0.1) / model.mass.reshape(-1)[out - 3])
        want += math.log10(1 - 0.1 / model.base_mass)
    known = pd.DataFrame({"word": [*count, b"never", b"unseen"], "c": [*count.values(), 0, 0]})
    got = lm.score_chunk(trainer.model, pd.DataFrame({"doc_id": [1], "held_out": [True], "text": [text]}), known).iloc[0]
    assert abs(got.score - want) < 1e-4 and got.n_known == len(own) - 2


def test_lm_repeated_rows_and_a_long_text(make):
    rows = [(7, "the of and")] * 300 + [(8, prose(EN, 30_000, 2)), (9, "the of and"), (10, None)]
    out = lm.scores(make(rows), common.remainder("doc_id", 10) == 0, classes=8, chunk=2000).collect()
    assert len(out) == len(rows)
    assert len({(r.n_tokens, r.base_score, round(r.score, 9)) for r in out if r.doc_id == 7}) == 1
    assert {r.n_tokens for r in out if r.doc_id in (8, 10)} == {30_001, 1}


def test_lm_pairs_normalise_by_products_of_their_tokens(monkeypatch):
    """op7: exp is taken by token and class, not by pair and class; what cannot be held so goes the longer way."""
    rng = np.random.default_rng(3)
    words = [f"w{i}".encode() for i in range(300)]
    model = lm.new_model(words, list(range(900, 600, -1)), 10**6, 5000, mass=rng.random(lm.GROUPS * 3) * 1000)
    found = np.unique(rng.integers(0, (model.start + 1)**2, 60_000))
    bias = model.p["bias"] + model.shut
    size = model.start + 1
    vectors = model.predict([found % size, found // size])
    want = lm._log_sums(vectors, model.p["word"], bias)
    done = []
    exp = np.exp
    monkeypatch.setattr(np, "exp", lambda x, **k: (done.append(np.size(x)), exp(x, **k))[1])
    got = lm._pair_log_sums(model, found, bias)
    monkeypatch.undo()
    assert np.abs(got - want).max() < 1e-5 and sum(done) <= 2 * size * len(bias) < len(found) * len(bias) / 10
    model.p["word"] *= 1000
    assert lm._pair_log_sums(model, found, bias) is None


def lm_model(classes, groups_of, seed=5):
    """A model with trained-like vectors; its classes are w0, w1, ..."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}".encode() for i in range(classes - 1)] + [lm.END]
    model = lm.new_model(words, list(range(3 * classes, 2 * classes, -1)), 10**6, 50_000, mass=rng.random(lm.GROUPS * groups_of) * 1000)
    for k in ("context", "word", "inner"):
        model.p[k] += rng.normal(0, 0.3, model.p[k].shape).astype(np.float32)
    return model


def test_lm_equal_texts_score_the_same_in_every_chunk():
    """op7: a text's score does not hang on the texts that share its chunk, to the last bit."""
    rng = np.random.default_rng(6)
    for most in (0, 40):
        model = lm_model(300, 21)
        model = lm.with_norms(model, most) if most else model
        text = "w3 w9 w3 w250 x1 x2 w9 w3 x3 w1"
        others = [" ".join(f"w{i}" if i < 320 else f"x{i}" for i in rng.integers(0, 900, n)) for n in (1, 700, 30, 5_000, 2)]
        found = set()
        for texts in ([text], [text, *others[:1]], [*others[:2], text], [*others, text, text], [others[3], text]):
            numbers, bounds, words = lm.coded(pa.array(texts, pa.string()))
            c = np.array([7 if w.startswith(b"x") else 9 for w in words.to_pylist()], float)
            made = lm.score_tokens(model, numbers, bounds, model.ids_of(words), c)
            found |= {made["score"][i] for i, t in enumerate(texts) if t == text}
        assert len(found) == 1


def test_lm_normalisers_of_frequent_pairs_are_taken_once(monkeypatch):
    """op7: pairs of frequent contexts read a table made once; the others are summed a chunk; the scores are the same."""
    model = lm_model(200, 3)
    table = lm.with_norms(model, 250)
    assert table.norms.shape == (250, 250) and table.place_of[model.start] == 0
    assert sorted(table.place_of[table.place_of >= 0]) == list(range(250))
    rng = np.random.default_rng(7)
    often = np.flatnonzero(table.place_of[:-1] >= 0)
    ids = np.append(rng.choice(often, 5_000), rng.integers(0, model.start, 5_000))
    begins = np.array([0, 10, 5_000, 7_500])
    want = lm.log_probabilities(model, ids, ids, begins)
    pairs, plain = [], lm._pair_log_sums
    monkeypatch.setattr(lm, "_pair_log_sums", lambda m, found, *a: (pairs.append(len(found)), plain(m, found, *a))[1])
    assert np.abs(lm.log_probabilities(table, ids, ids, begins) - want).max() < 1e-5 and pairs[0] < 5_000
    lm.log_probabilities(table, ids[:5_000], ids[:5_000], begins[:2])
    assert len(pairs) == 1
    wide = lm_model(200, 3)
    wide.p["word"] *= 1000
    assert lm.with_norms(wide).norms is None


def test_lm_noise_of_groups_of_every_length():
    """op7: the buckets' step by its definition, for groups of none, one, a full line and several lines of rows."""
    model = lm_model(10, 6)
    trainer = lm.Trainer(model, 0)
    groups, size = model.mass.shape
    rng = np.random.default_rng(8)
    own = {0: 1, 1: lm.SIDE, 2: lm.SIDE + 1, 5: 3 * lm.SIDE, 63: 2}
    buckets = rng.permutation(np.concatenate([g * size + rng.integers(0, size, n) for g, n in own.items()]))
    n, r = 500, rng.normal(0, 0.5, (len(buckets), lm.DIM)).astype(np.float32)
    p = {k: v.astype(float) for k, v in trainer.p.items()}
    drawn = np.random.default_rng(0)
    trainer.rng = np.random.default_rng(0)
    first = np.arange(groups)[:, None]
    drawn = np.searchsorted(trainer.inner_cumulative, first + drawn.random((groups, lm.INNER_NOISE)), side="right")
    drawn = drawn.clip(first * size, first * size + size - 1)
    chance = lambda i, k: 1 / (1 + math.exp(trainer.inner_log_noise[k] - p["inner_bias"][k] - r[i].astype(float) @ p["inner"][k]))
    want, vectors, biases = np.zeros(r.shape), np.zeros_like(p["inner"]), np.zeros_like(p["inner_bias"])
    for i, b in enumerate(buckets):
        for k, weight in [(b, (1 - chance(i, b)) / n), *((k, -chance(i, k) / n) for k in drawn[b // size])]:
            want[i] += weight * p["inner"][k]
            vectors[k] += weight * r[i]
            biases[k] += weight
    got = trainer.inner_step(r, buckets, n)
    assert np.abs(got - want).max() < 1e-6
    for name, g in (("inner", vectors), ("inner_bias", biases)):
        step = lm.RATE * g * math.sqrt(n) / np.sqrt(0.1 + n * g * g)
        assert np.abs(trainer.p[name] - p[name] - step).max() < 1e-4


def test_lm_buckets_of_many_words():
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(33, 256, n).astype(np.uint8)) for n in (1, 2, 3, 5, 63, 64, 65, 400) for _ in range(200)]
    packed = pa.array(words, pa.large_binary())
    assert lm.buckets(packed, 64, 134).tolist() == [lm.bucket(w, 64, 134) for w in words]
    assert lm.buckets(packed.slice(7, 50), 64, 3).tolist() == [lm.bucket(w, 64, 3) for w in words[7:57]]
    assert lm.buckets(packed.slice(0, 0), 64, 3).tolist() == []
