"""Classes by shingle similarity against all pairs, on groups that share a template."""

import random

from tidemark.llm import neardup


def brute(docs, least=0.8):
    sets, own = {i: set(neardup.shingle_set(t, 5).tolist()) for i, t in docs}, {i: i for i, _ in docs}

    def top(i):
        while own[i] != i:
            own[i] = own[own[i]]
            i = own[i]
        return i

    ids, pairs = [i for i, _ in docs], 0
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                pairs += 1
                a, b = sorted((top(i), top(j)))
                own[b] = a
    return {i: top(i) for i in ids}, pairs


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def template_docs(rng, pairs, n, own, shared):
    """Pairs that share ``shared`` words besides a template of ``n``, each with ``own`` of its own."""
    base, out = words(rng, n), []
    for _ in range(pairs):
        both = words(rng, shared)
        for _ in "ab":
            out.append(" ".join(base + both + words(rng, own)))
    return out


def check(spark, texts, want_pairs=None):
    docs = list(enumerate(texts))
    want, pairs = brute(docs)
    assert want_pairs is None or pairs == want_pairs
    got = neardup.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    return want


def test_pairs_among_a_template(spark):
    rng = random.Random(8)
    check(spark, template_docs(rng, 150, 350, 40, 10), 150)  # pairs are just above 0.8, all others just below


def test_templates_within_templates_and_chains(spark):
    rng = random.Random(9)
    base, texts = words(rng, 300), []
    for _ in range(4):  # half-templates, in each of them documents near and beyond the threshold
        half = words(rng, 40)
        texts += [" ".join(base + half + words(rng, rng.choice([10, 25, 40, 60]))) for _ in range(25)]
    chain = base + words(rng, 60)
    for k in range(40):  # each near the one before
        chain[300 + k] = f"c{k}"
        texts.append(" ".join(chain))
    for _ in range(30):  # words taken out of the template
        cut = base[:]
        del cut[(at := rng.randrange(250)) : at + rng.choice([5, 20, 40])]
        texts.append(" ".join(cut + words(rng, 20)))
    rng.shuffle(texts)
    assert len(set(check(spark, texts).values())) > 5


def test_near_copies_and_dissimilar_texts_with_a_common_passage(spark):
    rng = random.Random(10)
    passage = words(rng, 60)
    texts = [" ".join(passage + words(rng, rng.randint(5, 200))) for _ in range(80)]
    one = words(rng, 200)
    for _ in range(80):
        own = one[:]
        own[rng.randrange(200)] = "changed"
        texts.append(" ".join(own))
    check(spark, [*texts, "", None, "one", "one", " ".join(one)][:-4] + ["one", "one", " ".join(one)])


def test_bands_are_compared_by_bit_planes_and_keep_all_pairs(spark):
    rng = random.Random(11)
    texts = template_docs(rng, 40, 350, 40, 10) + [" ".join(words(rng, 90)) for _ in range(5)] + ["a b", "a b c"]
    sets = [neardup.shingle_set(t, 5) for t in texts]
    groups = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "group long, id long, c long")
    prints = spark.createDataFrame([(i, len(x), bytearray(neardup.wide_print(x).tobytes())) for i, x in enumerate(sets)], "id long, size int, print binary")
    got = {(r.a, r.b) for r in neardup.close_pairs(groups, prints, 0.8).collect()}
    similar = {(i, j) for j in range(len(sets)) for i in range(j) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))}
    far = {(i, j) for i in range(80) for j in range(80, 85)}
    assert len(similar) == 40 and similar <= got and not got & far


def test_bands_of_texts_below_the_threshold_store_few_rows(spark, monkeypatch):
    rng, rows, keep = random.Random(12), [], neardup.stored

    def counted(df, what):
        out = keep(df, what)
        rows.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    base, texts = words(rng, 400), []
    for _ in range(60):  # similarity about 0.75, many differences shared: a group for each of them before
        own = base[:]
        for at in rng.sample(range(400), 6):
            own[at] = "z"
        texts.append(" ".join(own))
    check(spark, texts)
    assert sum(rows) < 10_000


def test_groups_with_their_sets_return_links_and_no_other_pairs(spark, monkeypatch):
    rng = random.Random(13)
    texts = template_docs(rng, 40, 350, 40, 10)  # 40 pairs above 0.8, 3120 just below
    one = words(rng, 300)
    texts += [" ".join([*one[:k], "changed", *one[k + 1 :]]) for k in range(30)]  # all near each other
    sets = [neardup.shingle_set(t, 5) for t in texts]
    groups = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "group long, id long, c long")
    rows = [(i, len(x), bytearray(neardup.wide_print(x).tobytes()), bytearray(x.astype("<u8").tobytes())) for i, x in enumerate(sets)]
    prints = spark.createDataFrame(rows, "id long, size int, print binary, shingles binary")
    for planar in (0, neardup.PLANAR):  # with and without bit planes
        monkeypatch.setattr(neardup, "PLANAR", planar)
        got = {(r.a, r.b) for r in neardup.close_pairs(groups, prints, 0.8).collect()}
        assert {p for p in got if p[0] < 80} == {(i, i + 1) for i in range(0, 80, 2)}
        assert len(got) == 40 + 29


def test_pairs_are_dealt_to_bins_whole_and_compared_by_every_text_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PAIRS", 50)
    met = {(0, i) for i in range(1, 400)} | {(i, 900) for i in range(1, 300)} | {(i, i + 1) for i in range(500, 540)}
    dealt = neardup.binned(spark.createDataFrame(sorted(met), "a long, b long")).collect()
    assert len(dealt) == len(met) and {(r.a, r.b) for r in dealt} == met
    sizes = {}
    for r in dealt:
        sizes[r.bin] = sizes.get(r.bin, 0) + 1
    assert max(sizes.values()) < 150
    whole = [(1, [1, 2, 3]), (1, list(range(10, 20))), (2, list(range(10, 19))), (3, [1, 2, 3, 4, 5])]
    whole = spark.createDataFrame([(i, bytearray(b"".join(v.to_bytes(8, "little") for v in x))) for i, x in whole], "id long, shingles binary")
    got = neardup.reaching(spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long"), whole, 0.8)
    assert [tuple(r) for r in got.collect()] == [(1, 2)]
