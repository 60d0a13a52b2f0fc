import numpy as np
import pandas as pd
import xxhash

from tidemark.llm.neardup import choices, forest, near, planes
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    w = text.encode().lower().split()
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) > 4 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=4):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    d = pd.read_parquet(f"{SMALL}/documents.parquet")
    fps = {i: brute_fingerprint(t) for i, t in zip(d.doc_id, d.text, strict=True)}
    want = brute_components(sorted(fps), fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_near_duplicates"](spark, SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_bit_sliced_distance_and_masks():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 150).astype(np.uint64)
    for k in range(0, 150, 3):  # near pairs
        fps[k] = fps[k - 1] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k % 7, replace=False)))
    for radius in (0, 1, 3, 4, 7, 10):
        hits = near(fps, planes(fps), radius, np.zeros((150, 3), np.uint64))
        got = np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little")[:, :150].astype(bool)
        assert (got == (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius)).all()
    for n in (10, 10**6, 10**9, 10**12):
        masks = choices(n, 4)
        for _ in range(50):
            d = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not d & m for m in masks)


def test_forest_connects_two_parts():
    a, b = np.array([0, 1, 3, 1 << 40], np.uint64), np.array([7, 2**63 + 1], np.uint64)
    pairs = forest(a, b, 1)
    assert pairs == [(1, 1), (2, 0)] or set(pairs) == {(1, 1), (2, 0)}
    assert len(forest(np.zeros(300, np.uint64), None, 4)) == 299
