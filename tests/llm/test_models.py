"""Toxicity, language and language-model queries: held-out accuracy and brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import lm
from tidemark.llm.langid import Parser, language, plain
from tidemark.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    got = QUERIES["op7_language"](spark, MIDDLE).toPandas().merge(pd.read_parquet(f"{MIDDLE}/documents.parquet")[["doc_id", "lang"]], on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97


def greedy(text, sample):
    """Phrases of a text by searching the sample for ever longer ones."""
    i = n = 0
    while i < len(text):
        size = 1
        while i + size < len(text) and text[i : i + size + 1] in sample:
            size += 1
        i, n = i + size, n + 1
    return n


def test_cross_parsing_equals_brute_force():
    samples = [("a", plain("the cat sat on the mat and the dog ate the rest")), ("b", plain("el gato come en la mesa y el perro bebe"))]
    p = Parser(samples)
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice(["the", "gato", "mesa", "dog", "sat", "perro", "on"], 22_000))
    assert len(long) > 95_000
    texts = ["the dog sat on la mesa", "xyz the", "El PERRO, y el\n-- gato", "ü", "a" * 2500, long, *[long[k : k + 900 + 30 * k] for k in range(60)]]
    got = p.phrases([p.encode(t) for t in texts])
    for k, (_, s) in enumerate(samples):
        for j, t in enumerate(map(plain, texts)):
            assert abs(got[k, j] - greedy(t, s)) <= sum(c not in s for c in t)  # the root is left and reached again around a letter that no sample has
            if set(t) <= set(s):
                assert got[k, j] == greedy(t, s)
    assert [p.encode(t).tolist() for t in texts] == [np.where(np.array([ord(c) for c in plain(t)]) == 32, 0, p.code[[ord(c) for c in plain(t)]]).tolist() for t in texts]


def test_every_labelled_language_is_learned(spark):
    rng = np.random.default_rng(4)
    words = {k: ["".join(rng.choice(list(letters), 5)) for _ in range(300)] for k, letters in {"long": "abcdef", "short": "ghijkl", "copies": "mnopqr", "marks": "कखगघचछ"}.items()}
    prose = lambda k, n: " ".join(rng.choice(words[k], n))
    rows = [(prose("long", 1500), "long") for _ in range(20)] + [(prose("short", 2), "short") for _ in range(400)] + [(prose("copies", 1500), "copies")] * 3000 + [(prose("marks", 40), "marks") for _ in range(20)]
    texts = [*[prose(k, 30) for k in words], "²½ Ⅷ 12", "", None, "\u0301", "xyz"]
    rows += [(t, None) for t in texts]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language(docs, F.lit(True)).collect()}
    assert [got[len(rows) - len(texts) + i][0] for i in range(8)] == [*words, "und", "und", "und", "und"]
    assert got[len(rows) - 1][0] in words and all(0 <= s <= 1 for _, s in got.values())
    assert plain("नमस्ते दुनिया") == "नमस्ते दुनिया"
    assert all(r.lang_pred == "und" for r in language(docs, F.lit(False)).collect())


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op3_toxicity"](spark, sf).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    m = got.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = m[m.held_out & m.toxic.notna()]
    assert held[held.toxic == 1].predicted.mean() > 0.7 and held[held.toxic == 0].predicted.mean() < 0.01


def test_toxicity_equals_brute_force(spark):
    """FTRL-proximal with one coordinate at a time in plain Python, from words to scores."""
    from tidemark.llm import toxicity as tx

    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) + (" vile words" if k % 4 == 0 else "") for k in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(60)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in tx.toxicity(docs, labels, F.lit(True)).collect()}

    def coordinates(text):
        h = [int(x) for x in tx.word_hashes(text)]
        pairs = [x * int(tx.M2) + y for x, y in zip(h, h[1:])] + [x * int(tx.M3) + y for x, y in zip(h, h[2:])]
        mixed = [x % 2**64 for x in [*h, *pairs]]
        return {((x ^ (x >> 29)) * int(tx.M1) % 2**64) >> 44 for x in mixed}

    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id")).collect()]
    l1, z, n = min(tx.L1_MOST, max(tx.L1_LEAST, tx.L1_A_ROW * len(order))), Counter(), Counter()
    positive = sum(k % 4 == 0 for k in order)
    prior = math.log((positive + 1) / (len(order) - positive + 19))

    def weight(c, l1=l1):
        return 0.0 if abs(z[c]) <= l1 else (math.copysign(l1, z[c]) - z[c]) / ((tx.BETA + math.sqrt(n[c])) / tx.ALPHA + tx.L2)

    def score(text):
        return 1 / (1 + math.exp(-(prior + weight("bias", 0.0) + sum(weight(c) for c in coordinates(text)))))

    for _ in range(tx.EPOCHS):
        for k in order:
            g = score(texts[k]) - (k % 4 == 0)
            steps = {c: (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / tx.ALPHA * weight(c, 0.0 if c == "bias" else l1) for c in [*coordinates(texts[k]), "bias"]}
            for c, s in steps.items():
                z[c] += g - s
                n[c] += g * g
    assert all(abs(got[k] - score(t)) < 1e-4 for k, t in enumerate(texts))


def test_base_scores_equal_brute_force(spark):
    d = pd.read_parquet(f"{SMALL}/documents.parquet")
    own = {i: [*t.encode().lower().split(), None] for i, t in zip(d.doc_id, d.text, strict=True)}
    c = Counter()
    for i, w in own.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for r in QUERIES["op6_lm_scores"](spark, SMALL).collect():
        w = own[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert r.score < 0


def brute_tree(counts, word):
    """Context-tree probability of a token by recursion over the whole tree."""
    seqs = [(w if w == lm.END else w + b" ", k) for w, k in counts.items()]
    stats: dict = {}
    for s, k in seqs:
        for p in range(len(s)):
            context = (b" " * lm.DEPTH + s[:p])[-lm.DEPTH :]
            for i in range(8):
                node, bit = (1 << i) | (s[p] >> (8 - i)), s[p] >> (7 - i) & 1
                for depth in range(lm.DEPTH + 1):
                    stats.setdefault((context[lm.DEPTH - depth :], node), [0, 0])[bit] += k
    children: dict = {}
    for c, node in stats:
        if c:
            children.setdefault((c[1:], node), []).append((c, node))

    def own(a, b):
        return float(lm.log_own(np.array([a]), np.array([b]))[0])

    memo: dict = {}

    def weighted(key):
        if key not in memo:
            e = own(*stats[key])
            memo[key] = e if len(key[0]) == lm.DEPTH else float(np.logaddexp(e, sum(weighted(x) for x in children.get(key, [])))) - math.log(2)
        return memo[key]

    total, s = 0.0, word if word == lm.END else word + b" "
    for p in range(len(s)):
        context = (b" " * lm.DEPTH + s[:p])[-lm.DEPTH :]
        for i in range(8):
            node, bit = (1 << i) | (s[p] >> (8 - i)), s[p] >> (7 - i) & 1
            prob = None
            for depth in range(lm.DEPTH, -1, -1):
                key = (context[lm.DEPTH - depth :], node)
                if key not in stats:
                    continue
                a, b = stats[key]
                q = float(lm.next_bit(np.array([a]), np.array([b]), np.array([bit]))[0])
                share = 1.0 if depth == lm.DEPTH else math.exp(min(0.0, own(a, b) - math.log(2) - weighted(key)))
                prob = q if prob is None else share * q + (1 - share) * prob
            total += math.log10(0.5 if prob is None else prob)
    return total


def test_context_tree_equals_brute_force(spark):
    counts = {b"the": 7, b"then": 3, b"other": 2, b"to": 5, b"hat": 1, b"\xc3\xa9t\xc3\xa9": 2, lm.END: 4}
    unseen = [b"that", b"zz", b"longerword"]
    rows = [(bytearray(k), v) for k, v in counts.items()] + [(bytearray(k), 0) for k in unseen]
    got = {bytes(r.token): r.lp for r in lm.token_scores(spark.createDataFrame(rows, "token binary, c long")).collect()}
    assert got.keys() == counts.keys() | set(unseen)
    for w, v in got.items():
        assert math.isclose(v, brute_tree(counts, w), rel_tol=1e-6), w


def test_contexts_reach_across_words(spark):
    """A word is likelier behind the word that it always follows; the model of running text equals the tree by brute force."""
    rows = [(i, "left right up down", True) for i in range(8)] + [(8, "up left down right", False), (9, "left right", False), (10, "down right", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, teach boolean")
    got = {r.doc_id: r.score for r in lm.lm_scores(docs, F.col("teach")).collect()}
    assert got[0] > got[8] + 2 and got[9] > got[10] + 1
    # windows of the running text, listed byte by byte
    texts = {r[0]: b" " * lm.DEPTH + b" ".join(r[1].encode().split()) + b" " + lm.END for r in rows}
    own = {i: [int.from_bytes(t[p - lm.DEPTH : p + 1], "big") for p in range(lm.DEPTH, len(t))] for i, t in texts.items()}
    n = Counter({w: 0 for x in own.values() for w in x})
    n.update(w for i, x in own.items() if i < 8 for w in x)
    window = np.array(sorted(n))
    count = np.array([n[w] for w in window.tolist()])
    two = lm._levels(window, count, 2, lm.DEPTH)[0][0]
    below = pd.DataFrame({"key": (two.key >> 8 & 255) << 8 | two.key & 255, "w": two.log_w}).groupby("key").w.sum()
    pairs = pd.DataFrame({"pair": window & 65535, "n": count}).groupby("pair").n.sum()
    top = lm.Top(pairs.index.to_numpy(), pairs.to_numpy(), below.index.to_numpy(), below.to_numpy())
    lp = dict(zip(window.tolist(), lm.window_scores(window, count, top).tolist(), strict=True))
    for i, x in own.items():
        assert math.isclose(got[i], sum(lp[w] for w in x), rel_tol=1e-5)


def test_common_and_other_windows_alike(spark, monkeypatch):
    """Scores don't turn on which windows and tokens are broadcast and which are joined."""
    docs = spark.createDataFrame([(i, f"some words {i % 3} and more words {i % 7}") for i in range(40)] + [(40, ""), (41, None)], "doc_id long, text string").repartition(60)  # some partitions are empty
    want = {r.doc_id: r for r in lm.lm_scores(docs, F.col("doc_id") < 30).collect()}
    monkeypatch.setattr(lm, "SHARED", 20)
    monkeypatch.setattr(lm, "COMMON", 3)
    got = {r.doc_id: r for r in lm.lm_scores(docs, F.col("doc_id") < 30).collect()}
    assert len(got) == 42 and all(math.isclose(r.score, got[i].score, rel_tol=1e-5) and math.isclose(r.base_score, got[i].base_score) and r.n_known == got[i].n_known for i, r in want.items())
