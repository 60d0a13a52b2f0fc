"""Operators 11 to 13 against brute force, held-out rows and odd tables."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefixtrie, pulearn, tokenalign
from tidemark.llm.common import crc_mod, read

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- 11: positive-unlabelled learning ----


def test_held_out_quality_and_prior(spark):
    docs, labels = read(spark, MORE, "documents", "doc_id", "text"), read(spark, MORE, "labels", "doc_id", "quality")
    got = pulearn.pu_quality(docs, labels, crc_mod("doc_id", 5) != 0).join(labels, "doc_id").withColumn("held", crc_mod("doc_id", 5) == 0).toPandas()
    held = got[got["held"]]
    assert ((held["score"] >= 0.3) == (held["quality"] == 1)).mean() >= 0.94
    clean = held[held["quality"] == 1]
    assert (clean["score"] >= 0.3).mean() >= 0.97  # clean documents are left alone
    assert abs(got["prior"].iloc[0] - got["quality"].mean()) < 0.05


def test_labels_of_zero_and_held_out_labels_are_never_read(spark):
    docs, labels = read(spark, SMALL, "documents", "doc_id", "text"), read(spark, SMALL, "labels", "doc_id", "quality")
    teach = crc_mod("doc_id", 5) != 0
    plain = pulearn.pu_quality(docs, labels, teach).orderBy("doc_id").toPandas()
    turned = labels.withColumn("quality", F.when(teach, F.col("quality")).otherwise(1 - F.col("quality")))
    assert np.array_equal(plain["score"], pulearn.pu_quality(docs, turned, teach).orderBy("doc_id").toPandas()["score"])


def test_risk_is_that_of_the_definition():
    rng = np.random.default_rng(1)
    p, u, prior = rng.normal(1, 1, 50), rng.normal(0, 1, 80), 0.6
    loss = lambda z: np.mean(np.log1p(np.exp(-z)))
    got = pulearn.non_negative_risk(p, u, prior)
    assert np.allclose(got, (prior * loss(p), loss(-u) - prior * loss(-p)))
    x = np.concatenate([rng.normal(1, 1, (300, 4)), rng.normal(1, 1, (180, 4)), rng.normal(-1, 1, (120, 4))]).astype(np.float32)
    w, b = pulearn._minimise(x, np.arange(600) < 300, 0.6)
    total = lambda z: (r := pulearn.non_negative_risk(z[:300], z[300:], 0.6))[0] + max(0, r[1])
    assert total(x @ w + b) < 0.6 * total(np.zeros(600)) and ((x[300:480] @ w + b) > 0).mean() > 0.9 and ((x[480:] @ w + b) < 0).mean() > 0.9


def test_prior_is_the_share_where_classes_part():
    rng = np.random.default_rng(2)
    hist = lambda x: np.bincount(np.clip(x, 0, pulearn.SCORE_BINS - 1).astype(int), minlength=pulearn.SCORE_BINS)
    p, n = rng.normal(700, 60, 20_000), rng.normal(300, 60, 20_000)
    for share in (0.2, 0.5, 0.9):
        k = int(20_000 * share)
        assert abs(pulearn.best_ratio(hist(p), hist(np.concatenate([rng.normal(700, 60, k), n[: 20_000 - k]]))) - share) < 0.03
    assert pulearn.best_ratio(hist(p), hist(p[:0])) == 1


def test_odd_rows_of_quality(odd_docs, no_docs):
    labels = odd_docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"), F.lit(1).alias("text")).filter("doc_id < 9")
    got = pulearn.pu_quality(odd_docs, labels, F.lit(True)).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r.doc_id for r in odd_docs.collect())
    score = {r.doc_id: r.score for r in got}
    assert all(0 <= r.score <= 1 for r in got) and score[1] == score[2]
    assert pulearn.pu_quality(no_docs, labels, F.lit(True)).collect() == []
    assert {r.score for r in pulearn.pu_quality(odd_docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert {r.score for r in pulearn.pu_quality(odd_docs, labels.withColumn("quality", F.lit(0)), F.lit(True)).collect()} == {0.5}
    every = odd_docs.select("doc_id", F.lit(1).alias("quality"))
    assert {r.prior for r in pulearn.pu_quality(odd_docs, every, F.lit(True)).collect()} == {1.0}


# ---- 12: alignment of two vocabularies ----


def spans(ids, raw):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(raw[i]), i))
        at += len(raw[i])
    return out


def brute_alignment(rows):
    own = tokenalign.Aligner()
    memo, count = {}, collections.Counter()
    for _, t in rows:
        if not t:
            continue
        if t not in memo:
            a, b = own.a.encode(f" {t}", add_special_tokens=False).ids, own.b.encode(t)
            memo[t] = None
            if b"".join(own.raw_a[i] for i in a) == b"".join(own.raw_b[i] for i in b) == f" {t}".encode():
                x, y = spans(a, own.raw_a), spans(b, own.raw_b)
                links = [(i, j) for s, e, i in x for p, q, j in y if s < q and p < e]
                ends = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
                groups = [",".join(str(i) for s, e, i in x if lo < e <= hi) + "|" + ",".join(str(i) for s, e, i in y if lo < e <= hi) for lo, hi in zip([0, *ends], ends, strict=False)]
                memo[t] = (len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
        if memo[t]:
            count.update(memo[t][3])
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    for i, t in rows:
        m = memo.get(t) if t else None
        yield (i, 0, 0, 0, 0, 0, 0, "") if not m else (i, m[0], m[1], m[2], len(m[3]), sum(count[x] == best[x[1]] for x in m[3]), sum(count[x] for x in m[3]), m[4])


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "\n\nline\n  line\t\ttab ", "café   　 한국어 \U0001f600\U0001f601 ́", "can't won't I'LL 'tis",
    "x" * 3000, "12345 67 8.9e10 $%^&* (((", "word " * 500, "\r\n\x00\x1f\x85 a \x85b \x1c c", "the cat", "the cat", "the cat", "​‍ zero", "A" * 250 + " tail",
]


@pytest.mark.parametrize("common", [1 << 18, 20, 0])
def test_alignment_by_brute_force(spark, common):
    texts = [*ODD_TEXTS, *[r.text[:600] for r in read(spark, SMALL, "documents", "text").limit(60).collect()]]
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]  # null and repeated ids
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_a string").repartition(3)
    got = [tuple(r) for r in tokenalign.cross_alignment(docs, common=common).select(COLUMNS).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute_alignment(rows), key=key)


def test_groups_and_links_of_random_cuts():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 40)
        ends = [sorted({*rng.sample(range(1, n), rng.randint(0, n - 1)), n}) for _ in "ab"] if n > 1 else [[1], [1]]
        size = [np.diff([0, *e]) for e in ends]
        ids = [np.array([rng.choice([0, 7, 10, 99, 100, 12345]) for _ in e]) for e in ends]
        links, at, groups, text, _ = tokenalign.aligned(*ids, *size)
        want, cut = [], sorted(set(ends[0]) & set(ends[1]))
        for lo, hi in zip([0, *cut], cut, strict=False):
            want.append("|".join(",".join(str(i) for i, e in zip(x, y, strict=True) if lo < e <= hi) for x, y in zip(ids, ends, strict=True)))
        assert text.decode() == ";".join(want) + ";" and groups.tolist() == cut and len(links) == len(set(ends[0]) | set(ends[1])) == len(at)


def test_stored_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokenalign, "KEPT", 50)
    small, whole = tokenalign.Aligner(), tokenalign.Aligner()
    assert small.cuts and small.fast is not None
    whole.cuts = False
    texts = [f"some words {i} and w{i * 7} more {i % 13}" for i in range(200)]
    for lo in range(0, 200, 20):
        a, b = small.measure(texts[lo : lo + 20]), whole.measure(texts[lo : lo + 20])
        assert all(x[:5] == y[:5] and (x[5] == y[5]).all() and (x[6] == y[6]).all() for x, y in zip(a, b, strict=True))
    assert len(small.row) < 200


def test_alignment_of_no_rows(no_docs, odd_docs):
    assert tokenalign.cross_alignment(no_docs).collect() == []
    assert tokenalign.cross_alignment(odd_docs.filter("text IS NULL")).select("n_a", "groups_sha256").collect() == [(0, "")]


# ---- 13: prefix trie ----


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {c: own.get(c - c % 5, [])[: (h := zlib.crc32(str(c).encode()) % 9)] + v[h:] for c, v in own.items()}
    member, child, total = collections.defaultdict(list), collections.Counter(), {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            member[tuple(v[:d])].append(c)
    child.update(p[:-1] for p in member if p)
    for p in sorted(member, key=len, reverse=True):
        add = (child[p] == 0, (len(member[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        for d in range(len(p) + 1):
            t = total.setdefault(p[:d], [0, 0])
            t[0], t[1] = t[0] + add[0], t[1] + add[1]
    for p, m in member.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        yield (min(m), len(p), min(member[p[:-1]]) if p else None, len(m), child[p], *total[p], hashlib.sha256(ends.encode()).hexdigest())


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(spark, rows):
    c = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(c).select(TRIE).collect()), key=str)


@pytest.mark.parametrize(("seed", "turns"), [(1, 9), (2, 40)])
def test_trie_by_brute_force(spark, monkeypatch, seed, turns):
    monkeypatch.setattr(prefixtrie, "PIECE", 3)
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 1000, 1001, 12345]:
        for turn in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([turn, turn, turn, 1, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "é" * (turn + 1), None, ""]) if rng.random() < 0.3 else f"t{turn}"))
    rows += [(None, 0, "user", "x")] * 5 + rows[:10]
    assert trie_of(spark, rows) == sorted(brute_trie(rows), key=str)


def test_copies_turnless_and_no_conversations(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 2000, 5) for t in range(3)] + [(7, 0, "user", "x"), (9, 0, "user", "y")]
    got = trie_of(spark, rows)
    assert got == sorted(brute_trie(rows), key=str)
    assert trie_of(spark, [(c, 0, "user", "x") for c in (1, 6, 11)]) == sorted(brute_trie([(c, 0, "user", "x") for c in (1, 6, 11)]), key=str)
    assert trie_of(spark, []) == []
