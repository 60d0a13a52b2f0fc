import pandas as pd
import pytest

import corpus_pipeline as cp
from tidemark.llm import substrings
from tidemark.llm.common import stored

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from tidemark.llm.common import read, stored

    docs, out = read(spark, SMALL, "documents", *cp.COLUMNS), []
    for _, f in cp.STAGES:
        docs = stored(f(spark, docs, SMALL), "stage")
        out.append(docs)
    return out


def test_stages(spark, stages):
    raw = pd.read_parquet(f"{SMALL}/documents.parquet")
    quality, near, parts, clean, pieces = (s.toPandas() for s in stages)
    assert all(list(s.columns) == cp.COLUMNS for s in stages[:-1])
    from tidemark.llm.queries import QUERIES

    kept = {r.doc_id for r in QUERIES["op8_quality_rules"](spark, SMALL).filter("kept").collect()}
    assert set(quality.doc_id) == kept < set(raw.doc_id)
    quality = quality.sort_values("doc_id")
    assert set(near.doc_id) == {quality.doc_id.iloc[k] for k in brute_classes(quality.text.tolist())}  # five-word similarity of 0.8
    assert set(parts.doc_id) == set(near.doc_id) and (parts.n_chars == parts.text.str.len()).all()
    assert set(clean.doc_id) <= set(parts.doc_id) and set(pieces.doc_id) == set(clean.doc_id) and pieces.round_trip.all()


def test_run_is_the_stages_in_turn(spark, stages):
    assert {(r.doc_id, tuple(r.ids)) for r in cp.run(spark, SMALL).collect()} == {(r.doc_id, tuple(r.ids)) for r in stages[-1].collect()}


def test_cut_words():
    assert cp.cut_words("a b  c\nd e", [(1, 2)]) == "a d e" and cp.cut_words("a b c", [(0, 3)]) == "" and cp.cut_words(" a b", [(1, 1)]) == " a "
    assert cp.cut_words("a b c d", [(0, 1), (2, 2)]) == "b "


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, f in cp.STAGES:
            docs = f(spark, docs, SMALL)
        docs.collect()


def _set(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {tuple(w)}


def brute_classes(texts):
    """Least places of the classes of texts joined by pairs of similarity 0.8 or more."""
    sets, own = [_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = own[i], own[j]
                own = [min(a, b) if c in (a, b) else c for c in own]
    return set(own)


def test_rows_of_null_and_repeated_ids_stay(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("item_id = 0").first()["text"]
    prose = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, prose[0]), (None, f"{prose[1]} {item}"), (7, prose[2]), (7, f"{item} x"), (7, prose[3])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = {(r.doc_id, r.text) for r in cp.decontamination_stage(spark, docs, SMALL).collect()}
    assert got == {(None, prose[0]), (7, prose[2]), (7, prose[3])}


def test_near_duplicates_are_those_of_shingle_similarity(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = [[f"w{v}" for v in rng.integers(0, 10**6, 100)] for _ in range(30)]
    texts = []
    for k, b in enumerate(base):
        texts += [b, [*b[:50], "changed", *b[51:]], [*b[: 85 - k], *(f"x{k}y{i}" for i in range(15 + k))]]
    texts += [[*base[0][:i], "z", *base[0][i + 1 :]] for i in range(20, 80, 2)]  # a band of more than SMALL_BAND classes
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    got = cp.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"), SMALL)
    assert {r.doc_id for r in got.collect()} == brute_classes([t for _, t, *_ in rows])


def test_substring_stage_stores_shared_seeds_only_and_joins_texts_once(spark, monkeypatch):
    sizes = {}

    def counted(df, what):
        out = stored(df, what)
        sizes[what] = out.count()
        return out

    monkeypatch.setattr(substrings, "stored", counted)
    own = lambda i, n: [f"w{i}x{k}" for k in range(n)]
    shared = own("all", 60)
    rows = [(i, " ".join(own(i, 500) + (shared if i < 2 else [])), "en", "s", 7) for i in range(40)] + [(None, " ".join(shared), "en", "s", 7), (50, None, "en", "s", None), (51, "", "en", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = cp.substring_stage(spark, docs, "")
    assert sum(sizes.values()) < 300  # 3,000 seeds are of one document
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter, (doc_id") == 1
    want = [(i, " ".join(own(1, 500)) + " ", "en", "s", len(" ".join(own(1, 500))) + 1) if i == 1 else (i, *rest) for i, *rest in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType


def test_near_duplicates_are_judged_by_text_whatever_their_ids(spark):
    prose = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdefgh"]
    rows = [(None, prose[0]), (None, prose[0]), (None, prose[0] + " end")]  # nothing but rows without an id: one stays
    rows += [(None, prose[1]), (9, prose[1]), (7, prose[1] + " end")]  # an id goes first
    rows += [(7, prose[2]), (3, prose[3]), (7, prose[3] + " end"), (7, prose[4])]  # one text of id 7 is near that of id 3, the others are near none
    rows += [(8, prose[5]), (8, prose[5]), (8, prose[5] + " end")]  # one id, one class
    rows += [(None, None), (None, ""), (20, ""), (2**60 + 1, prose[6] + " end"), (2**60, prose[6]), (None, prose[7])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = [(r.doc_id, r.text.removesuffix(" end")) for r in cp.near_duplicate_stage(spark, docs.repartition(4), SMALL).collect()]
    want = [(None, prose[0]), (7, prose[1]), (7, prose[2]), (3, prose[3]), (7, prose[4]), (8, prose[5]), (20, ""), (2**60, prose[6]), (None, prose[7])]
    assert sorted(got, key=str) == sorted(want, key=str)
