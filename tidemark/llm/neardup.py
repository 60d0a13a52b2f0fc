"""Operator 4: SimHash near-duplicates by bit-sliced comparison.

1. Every text gets a 64-bit SimHash of its 4-word shingles.
2. Equal fingerprints become one class (a partial aggregate), so copies never meet in pairs.
3. The 64 bits are cut into b blocks. Two fingerprints within the radius r agree on at least k = b - r whole
   blocks, so each class goes to one cell for each choice of k blocks: no pair within the radius is missed. b grows with the
   number of classes, which keeps the mean size of a cell bounded.
4. A cell's fingerprints are stored as 64 vertical bit planes. Distances from a query to all others of the
   cell are counted at once by carry-save adders, 64 to a machine word, and a block of planes ends the count once all have
   passed the radius. A cell beyond ``CELL`` members is cut into parts, and each pair of parts is a task of its own.
5. Each task returns a spanning forest of its links (at most one edge per member), and star steps join the forests.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a row with a null id has a
fingerprint but no component and links nothing; repeated rows give one result row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored
from tidemark.llm.graph import components

SEED = 42
#: Members of a cell that one task compares with each other at once.
CELL = 2048
#: Words of texts hashed in one numpy step.
STEP = 200_000
#: Min-hash bands and hashes to a band: a pair of similarity 0.8 meets in none with a chance of (1 - 0.8 ** 4) ** 24, 3 in a million.
BANDS, ROWS = 24, 4
#: Members of a band that are all compared with each other at once, and those that all others of a larger band are compared with first.
SMALL_BAND, HUBS = 9, 2
#: Members of a group that one task compares with each other, and shingles of all of them; larger groups are parted first.
GROUP, GROUP_SHINGLES = 4096, 1 << 22
#: Members times shingles of a group from which fingerprints by bit planes spare more than they cost.
PLANAR = 1 << 30
#: Pairs whose sets meet in one task at once.
PAIRS = 512
#: Bits of a fingerprint of a shingle set, and shingles below which a set is compared without one, as its majorities are too coarse.
BITS, COARSE = 2048, 100


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of the space-joined word shingles of a lower-cased text, in order; fewer words: the whole sequence."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    digest = xxhash.xxh64_intdigest
    starts = [0, *[e + 1 for e in ends[:-size]]]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose hashes lie one after another: a bit is 1 if set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some) == 0:
        return out
    starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    out[some] = np.packbits(2 * ones > counts[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints_of(texts: list[str | None], size: int = 4) -> np.ndarray:
    out, hashes, counts = [], [], []
    for t in texts:
        h = shingle_hashes((t or "").encode("utf-8", "surrogatepass"), size)
        hashes += h
        counts.append(len(h))
        if len(hashes) >= STEP:
            out.append(majority(np.array(hashes, np.uint64), np.array(counts)))
            hashes, counts = [], []
    out.append(majority(np.array(hashes, np.uint64), np.array(counts, int)))
    return np.concatenate(out)


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fingerprints_of(b["text"].tolist(), size).view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of the fingerprints of 64 bits or a multiple, 64 members to a word: shape (bits, words)."""
    n = len(fps)
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    padded = np.zeros((-(-n // 64) * 64, bits.shape[1]), np.uint8)
    padded[:n] = bits
    return np.packbits(np.ascontiguousarray(padded.T), axis=1, bitorder="little").view(np.uint64)


def near(queries: np.ndarray, vertical: np.ndarray, radius: int, passed: np.ndarray) -> np.ndarray:
    """Members within ``radius`` of each query as bits, shape (queries, words). ``passed``: members to leave out.

    Counters are kept as bit slices. Eight planes at a time go through carry-save adders; members whose count has
    passed the radius are set in ``passed``, and the rest of the planes is left alone once that holds for all.
    """
    count = [np.zeros_like(passed) for _ in range(max(1, radius.bit_length()))]
    queries = queries.reshape(len(queries), -1)
    flipped = [np.where((queries[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1), np.uint64(2**64 - 1), np.uint64(0))[:, None] for p in range(len(vertical))]

    def adder(a, b, c):
        u = a ^ b
        return u ^ c, (a & b) | (u & c)

    for block in range(0, len(vertical), 8):
        d = [vertical[p][None, :] ^ flipped[p] for p in range(block, block + 8)]
        s1, c1 = adder(d[0], d[1], d[2])
        s2, c2 = adder(d[3], d[4], d[5])
        s3, c3 = d[6] ^ d[7], d[6] & d[7]
        ones, c4 = adder(s1, s2, s3)
        t1, e1 = adder(c1, c2, c3)
        twos, e2 = t1 ^ c4, t1 & c4
        fours, eights = e1 ^ e2, e1 & e2
        parts, carry = [ones, twos, fours, eights], np.zeros_like(passed)
        for k in range(max(len(count), 4)):
            if k >= len(count):
                passed |= parts[k]
            elif k < 4:
                count[k], carry = adder(count[k], parts[k], carry)
            else:
                count[k], carry = count[k] ^ carry, count[k] & carry
        passed |= carry
        if (block + 8) % (len(vertical) // 8):
            continue  # wide fingerprints are judged eight times in all
        less, more = np.full_like(passed, 2**64 - 1), np.zeros_like(passed)
        for k in range(len(count) - 1, -1, -1):
            if not radius >> k & 1:
                more |= less & count[k]
                less &= ~count[k]
            else:
                less &= count[k]
        passed |= more
        if (passed == np.uint64(2**64 - 1)).all():
            break
    return ~passed


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect all members linked in this cell: i in left, j in left, or in right if given.

    One link is kept for each two groups that it joins.
    """
    other = left if right is None else right
    n, m = len(left), len(other)
    vertical = planes(other)
    label = np.arange(n + (0 if right is None else m))
    shift = 0 if right is None else n
    found = []
    for at in range(0, n, 256):
        rows = np.arange(at, min(n, at + 256))
        keep = np.ones((len(rows), vertical.shape[1] * 64), np.uint8)
        keep[:, m:] = 0
        if right is None:
            keep[:, :m] = np.arange(m)[None, :] > rows[:, None]
        passed = ~np.packbits(keep, axis=1, bitorder="little").view(np.uint64)
        hits = near(left[rows], vertical, radius, passed)
        for r in np.flatnonzero(hits.any(axis=1)):
            i = rows[r]
            js = np.flatnonzero(np.unpackbits(hits[r].view(np.uint8), bitorder="little"))
            roots, first = np.unique(label[js + shift], return_index=True)
            fresh = roots != label[i]
            if fresh.any():
                found += [(int(i), int(js[f])) for f in first[fresh]]
                joined = np.append(roots, label[i])
                label[np.isin(label, joined)] = joined.min()
    return found


def choices(n: int, radius: int) -> list[tuple[np.uint64, int]]:
    """Masks of every choice of b - radius out of b blocks, with b such that a cell holds few of n fingerprints."""
    b = radius + 1
    while b < 2 * radius + 2 and n >> (64 * (b - radius) // b) > 64:
        b += 1
    edges = [64 * i // b for i in range(b + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(block[i] for i in c) for c in combinations(range(b), b - radius)]


def links(classes: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) between representatives whose fingerprints differ in 1 to ``radius`` bits: a spanning set.

    ``classes`` has one row (fp, rep) per fingerprint, stored.
    """
    masks = choices(classes.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    cells = classes.select("fp", "rep", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "bits"))
    sizes = cells.groupBy("choice", "bits").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > CELL).select("choice", "bits", F.ceil(F.col("n") / CELL).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = cells.join(large, ["choice", "bits"], "left").fillna(1, ["parts"]).withColumn("part", part)
    spread = dealt.select(
        "choice", "bits", "fp", "rep", "part",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(F.least("part", q).alias("i"), F.greatest("part", q).alias("j")))).alias("pair"),
    ).select("choice", "bits", "pair.i", "pair.j", "part", "fp", "rep")
    key = ["choice", "bits", "i", "j"]
    ready = spread.repartition(*key).sortWithinPartitions(*key)
    rep = classes.schema["rep"].dataType.simpleString()

    def compare(g: pd.DataFrame) -> pd.DataFrame | None:
        fps, reps, first = g["fp"].to_numpy().view(np.uint64), g["rep"].to_numpy(), g["part"].to_numpy() == g["i"].iloc[0]
        if g["i"].iloc[0] == g["j"].iloc[0]:
            got, mine, theirs = forest(fps, None, radius), reps, reps
        else:
            got, mine, theirs = forest(fps[first], fps[~first], radius), reps[first], reps[~first]
        return pd.DataFrame({"a": mine[[i for i, _ in got]], "b": theirs[[j for _, j in got]]}) if got else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            k = b[key].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], cuts])
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s > 1 and (out := compare(b.iloc[s:e])) is not None:
                    yield out
            rest = b.iloc[starts[-1] :]
        if rest is not None and len(rest) > 1 and (out := compare(rest)) is not None:
            yield out

    return ready.mapInPandas(run, f"a {rep}, b {rep}").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, size: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): the class of near-duplicates of every document, named by its least doc_id."""
    fps = stored(fingerprints(docs, size), "fingerprints")
    classes = stored(fps.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = components(links(classes, radius), "a", "b")
    named = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


# ---- classes by shingle similarity ----


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes((text or "").encode("utf-8", "surrogatepass"), size), np.uint64))


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band of min-hashes of a set that isn't empty."""
    rng = np.random.default_rng(SEED)
    factor, shift = rng.integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
    least = (shingles[None, :] * (factor | np.uint64(1))[:, None] + shift[:, None]).min(axis=1).astype("<u8").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), no) for no, row in enumerate(least)], np.uint64)


def wide_print(shingles: np.ndarray) -> np.ndarray:
    """SimHash of ``BITS`` bits of a set of shingle hashes."""
    out = []
    for k in range(BITS // 64):
        h = (shingles ^ np.uint64(k * 0x9E3779B97F4A7C15 & 2**64 - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out.append(majority(h ^ (h >> np.uint64(29)), np.array([len(h)])))
    return np.concatenate(out)


def reach(least: float) -> int:
    """Bits in which fingerprints of two sets of similarity ``least`` may differ: the mean and 6.2 deviations.

    A bit differs with a chance of acos(cosine) / pi; of all pairs of that similarity the cosine is least where both sets are of one size.
    """
    p = float(np.arccos(2 * least / (1 + least)) / np.pi)
    return int(BITS * p + 6.2 * (BITS * p * (1 - p)) ** 0.5) + 1


def runs_of(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Rows of one key each, out of a partition sorted by it."""
    rest: list[pd.DataFrame] = []
    for b in batches:
        k = b[key].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(b)]])
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if rest and rest[0][key].iloc[0] != k[s]:
                yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
                rest = []
            rest.append(b.iloc[s:e])
    if rest:
        yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]


def close_pairs(groups: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of members of a group in different classes whose fingerprints and sizes allow a similarity of ``least``.

    ``groups``: (group, id, c), of ``GROUP`` members at most each; ``prints``: (id, size, print). All pairs of a group are judged, by bit planes.
    If ``prints`` has the sets too (``shingles``), these pairs are compared by them at once (in groups of less work than ``PLANAR`` all of fitting sizes are), and of pairs that reach ``least`` only one for each two
    classes that it joins is returned: fewer than the group has members.
    """
    kind, exact = groups.schema["id"].dataType.simpleString(), "shingles" in prints.columns
    ready = groups.join(prints, "id").select("group", "id", "c", *[n for n in prints.columns if n != "id"])
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes here are much work
    ready = ready.repartition(parts, F.xxhash64("group")).sortWithinPartitions("group", "id")  # by a key of its own, else a join's coalesced partitions stay
    radius = reach(least)

    def links_of(found: np.ndarray, first: int, label: np.ndarray, size: np.ndarray, flat: np.ndarray, starts: np.ndarray, mark: np.ndarray) -> list[tuple[int, int]]:
        """Links among the pairs found of members ``first`` and on; ``label`` holds the classes and is brought up to date."""
        out = []
        for r in np.flatnonzero(found.any(axis=1)):
            i = first + r
            js = np.flatnonzero(found[r])
            js = js[label[js] != label[i]]
            if len(js) == 0:
                continue
            own = flat[starts[i] : starts[i + 1]]
            mark[own] = 1
            lo = int(js[0])  # what lies between two candidates is read with them
            both = np.add.reduceat(mark[flat[starts[lo] : starts[js[-1] + 1]]], starts[lo : js[-1] + 1] - starts[lo], dtype=np.int64)[js - lo]
            mark[own] = 0
            js = js[both >= least * (size[i] + size[js] - both)]
            roots, at = np.unique(label[js], return_index=True)
            if len(roots):
                out += [(int(i), int(js[k])) for k in at]
                joined = np.append(roots, label[i])
                label[np.isin(label, joined)] = joined.min()
        return out

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        ids, size, n, out = g["id"].to_numpy(), g["size"].to_numpy(), len(g), []
        label = np.unique(g["c"].to_numpy(), return_inverse=True)[1]
        if exact:
            full = np.frombuffer(b"".join(g["shingles"]), "<u8")
            names, flat = np.unique(full, return_inverse=True)
            starts, mark = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), np.zeros(len(names), np.uint8)
        coarse = np.ones(n, bool)
        if not exact or n * len(full) > PLANAR:
            fps = np.frombuffer(b"".join(g["print"]), "<u8").reshape(n, -1)
            vertical, coarse = planes(fps), size < COARSE
        for at in range(0, n, 256):
            rows = np.arange(at, min(n, at + 256))
            asked = (np.arange(n)[None, :] > rows[:, None]) & (label[None, :] != label[rows, None])
            asked &= (size > 0)[None, :] & (size > 0)[rows, None]
            asked &= np.minimum(size[None, :], size[rows, None]) >= least * np.maximum(size[None, :], size[rows, None])
            found = asked & (coarse[None, :] | coarse[rows, None])
            if (asked & ~found).any():
                keep = np.zeros((len(rows), vertical.shape[1] * 64), np.uint8)
                keep[:, :n] = asked & ~found
                hits = near(fps[rows], vertical, radius, ~np.packbits(keep, axis=1, bitorder="little").view(np.uint64))
                found |= np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
            if exact:
                i, j = np.array(links_of(found, at, label, size, flat, starts, mark), int).reshape(-1, 2).T
            else:
                i, j = np.nonzero(found)
                i = rows[i]
            out.append(pd.DataFrame({"a": ids[i], "b": ids[j]}))
        return pd.concat(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got: list[pd.DataFrame] = []
        for g in runs_of(batches, "group"):
            got.append(compare(g))
            if sum(map(len, got)) > 10_000 or len(got) > 1000:
                yield pd.concat(got).drop_duplicates()  # bands of one task often hold the same members
                got = []
        if got:
            yield pd.concat(got).drop_duplicates()

    return ready.mapInPandas(run, f"a {kind}, b {kind}").distinct()


def binned(met: DataFrame) -> DataFrame:
    """Pairs (a, b) dealt to bins (bin, a, b), so that a member comes to few bins: its pairs with others of one cluster lie in one bin.

    A pair lies in the bin of the least member that ``a`` has a pair with. Bins of more than ``PAIRS`` pairs are cut by a hash of the pair.
    """
    ends = met.select("a", F.col("b").alias("other")).unionAll(met.select("b", "a"))
    label = ends.groupBy("a").agg(F.least("a", F.min("other")).alias("of"))
    dealt = met.join(label, "a")
    large = dealt.groupBy("of").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("a", "b"), F.coalesce("parts", F.lit(1)))
    return dealt.join(large, "of", "left").select(F.xxhash64("of", part).alias("bin"), "a", "b")


def reaching(met: DataFrame, whole: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of ``met`` whose sets reach a similarity of ``least``; ``whole``: (id, shingles). A set goes once to each bin that has pairs of it."""
    kind = met.schema["a"].dataType.simpleString()
    dealt = stored(binned(met), "bins")
    asked = dealt.select("bin", F.col("a").alias("id")).unionAll(dealt.select("bin", "b")).distinct()
    have = asked.join(whole, "id").select("bin", F.lit(0).alias("kind"), F.col("id").alias("a"), F.col("id").alias("b"), "shingles")  # a null id would make pandas round all
    rows = have.unionAll(dealt.select("bin", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("shingles")))
    parts = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = rows.repartition(parts, F.xxhash64("bin")).sortWithinPartitions("bin", "kind")

    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= least * max(len(x), len(y)) else 0
        return both >= least * (len(x) + len(y) - both)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep: list[tuple] = []
        for g in runs_of(batches, "bin"):
            sets: dict = {}
            for pair, a, b, shingles in zip(g["kind"], g["a"], g["b"], g["shingles"], strict=True):
                if pair:
                    if any(alike(x, y) for x in sets[a] for y in sets[b]):
                        keep.append((a, b))
                else:
                    sets.setdefault(a, []).append(np.frombuffer(shingles, "<u8"))  # an id may have several texts
            if len(keep) > 10_000:
                yield pd.DataFrame(keep, columns=["a", "b"])
                keep = []
        yield pd.DataFrame(keep, columns=["a", "b"])

    out = stored(ready.mapInPandas(run, f"a {kind}, b {kind}").distinct(), "links")
    forget(dealt)
    return out


def several(groups: DataFrame, joined: DataFrame) -> DataFrame:
    """Groups (group, id, c: its class so far) whose members are not all joined yet; of groups of the same members one."""
    named = groups.select("group", "id").join(joined, groups["id"] == joined["node"], "left").select("group", "id", F.coalesce("component", "id").alias("c"))
    kept = named.groupBy("group").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sign")).filter("lo < hi")
    one = kept.groupBy("n", "sign").agg(F.min("group").alias("group")).select("group")
    return stored(named.join(one, "group"), "several")


def parted(groups: DataFrame, arrays: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to compare, and smaller groups, that together hold all that a group's pairs of similarity ``least`` need.

    H is what more than half of a group's sets have. A set x differs from it by what it lacks, r of its own, and what it has besides, a of its own; its
    weight is r + least * a. Of two sets that share none of their differences the similarity is (|H| - r - r') / (|H| + a + a'), which reaches ``least`` if
    their weights together are at most (1 - least) * |H|. Then each of them reaches it with the member of least weight too, so comparing all with
    that one joins them. Others share differences, (their weights - (1 - least) * |H|) / (1 + least) at least, so two of them meet in one of their
    rarest differences (a prefix filter), and those who share it are a smaller group. No difference is shared by more than half of a group, so there are as many
    rounds at most as halvings.
    """
    sized = groups.groupBy("group").agg(F.count("*").alias("n"))
    whole = groups.join(arrays, "id").join(sized, "group")
    counts = whole.select("group", "n", F.explode("shingles").alias("e")).groupBy("group", "n", "e").agg(F.count("*").alias("c"))
    counts = stored(counts.filter("c > 1"), "counts")  # those of one set are told by their absence
    common = counts.filter(F.col("c") * 2 > F.col("n")).groupBy("group").agg(F.collect_list("e").alias("h"))  # no longer than twice a set
    none = F.array().cast("array<bigint>")
    differ = whole.join(common, "group", "left").select("group", "id", "n", F.size(F.coalesce("h", none)).alias("size"), F.array_except(F.coalesce("h", none), "shingles").alias("r"), F.array_except("shingles", F.coalesce("h", none)).alias("a"))
    differ = stored(differ.withColumn("w", F.size("r") + least * F.size("a")), "differ")
    lightest = differ.groupBy("group").agg(F.min(F.struct("w", "id")).alias("m")).select("group", F.col("m.w").alias("light"), F.col("m.id").alias("hub"))
    weighed = differ.join(lightest, "group")
    pairs = stored(weighed.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "pairs")
    shared = F.greatest(F.ceil((F.col("w") + F.col("light") - (1 - least) * F.col("size")) / (1 + least) - 1e-9), F.lit(1))
    rows = weighed.select("group", "id", "n", (F.size("r") + F.size("a") - shared + 1).alias("prefix"), F.explode(F.concat("r", "a")).alias("e"))
    # how many of the group share the difference: those who have it, or those who lack it
    often = rows.join(counts.drop("n"), ["group", "e"], "left").withColumn("f", F.when(F.col("c") * 2 > F.col("n"), F.col("n") - F.col("c")).otherwise(F.coalesce("c", F.lit(1))))
    rarest = often.withColumn("k", F.row_number().over(Window.partitionBy("group", "id").orderBy("f", "e"))).filter("k <= prefix AND f > 1")
    smaller = stored(rarest.select(F.xxhash64("group", "e").alias("group"), "id"), "smaller")
    forget(counts, differ)
    return pairs, smaller


def similar_documents(docs: DataFrame, least: float = 0.8, size: int = 5) -> DataFrame:
    """(doc_id, component_id): classes joined by pairs whose shingle sets have a Jaccard similarity of ``least`` or more.

    Texts of equal sets are one class at once. Others meet in bands of min-hashes, and each pair that meets is compared
    by its whole sets, if their sizes allow it. In a band of more than ``SMALL_BAND`` classes all are compared with a few of it first, drawn anew in each band, which
    joins near copies at a fixed number of pairs a member. In bands that still hold several classes the fingerprints of all members are
    compared by bit planes, as operator 4 does, and pairs within ``reach`` by their whole sets, which come to the band's task once: no pair leaves it but links that
    join two classes. Bands beyond ``GROUP`` are parted by ``parted`` into such groups first. Rows with a null id have no class.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [shingle_set(t, size) for t in b["text"]]
            same = [xxhash.xxh3_128_hexdigest(g.astype("<u8").tobytes()) for g in got]
            yield pd.DataFrame({"doc_id": b["doc_id"], "same": same, "size": [len(g) for g in got], "bands": [band_hashes(g).view(np.int64) if len(g) else [] for g in got]})

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [shingle_set(t, size).astype("<u8").tobytes() for t in b["text"]]
            yield pd.DataFrame({"id": b["doc_id"], "shingles": got})

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["doc_id"], "shingles": [shingle_set(t, size).view(np.int64) for t in b["text"]]})

    def printed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [shingle_set(t, size) for t in b["text"]]
            yield pd.DataFrame({"id": b["doc_id"], "size": [len(g) for g in got], "print": [wide_print(g).astype("<u8").tobytes() for g in got], "shingles": [g.astype("<u8").tobytes() for g in got]})

    def compared(met: DataFrame) -> DataFrame:
        """Pairs of (a, b) that reach ``least``. Sets are made anew for the documents that meet another, which is far less to move than all sets."""
        asked = met.select(F.col("a").alias("id")).unionAll(met.select("b")).distinct()
        whole = stored(texts.join(asked, texts["doc_id"] == asked["id"], "left_semi").mapInPandas(sets, f"id {kind}, shingles binary").distinct(), "sets")
        out = reaching(met, whole, least)
        forget(whole)
        return out

    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    own = stored(texts.mapInPandas(signed, f"doc_id {kind}, same string, size int, bands array<long>"), "signed")
    named = stored(own.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands")), "classes")
    dealt = named.select("rep", "size", F.explode("bands").alias("band"))
    shared = dealt.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("band")
    some = stored(dealt.join(shared, "band"), "shared")
    drawn = some.withColumn("nth", F.row_number().over(Window.partitionBy("band").orderBy(F.xxhash64("rep", "band"), "rep"))).filter(F.col("nth") <= SMALL_BAND + 1)
    sized = drawn.withColumn("n", F.max("nth").over(Window.partitionBy("band"))).filter((F.col("n") <= SMALL_BAND) | (F.col("nth") <= HUBS))
    hubs = stored(sized.select("band", F.col("rep").alias("hub"), F.col("size").alias("hub_size")), "hubs")
    alike = F.least("size", "hub_size") >= least * F.greatest("size", "hub_size")
    met = some.join(hubs, "band").filter(alike & (F.col("rep") != F.col("hub"))).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    met = stored(met, "met")
    links = compared(met)
    forget(met)
    # Bands of more members than were drawn, in which the links so far leave several classes.
    large = some.join(sized.filter(F.col("n") > SMALL_BAND).select("band").distinct(), "band").select(F.col("band").alias("group"), F.col("rep").alias("id"))
    joined = components(links, "a", "b")
    groups = several(large, joined)
    if groups.isEmpty():
        found = joined
    else:
        ids = groups.select("id").distinct()
        asked = texts.join(ids, texts["doc_id"] == ids["id"], "left_semi")
        prints = stored(asked.mapInPandas(printed, f"id {kind}, size int, print binary, shingles binary").dropDuplicates(["id"]), "prints")
        arrays = None
        while not groups.isEmpty():
            within = groups.join(prints.select("id", "size"), "id").groupBy("group").agg(F.count("*").alias("n"), F.sum("size").alias("all"))
            within = within.select("group", ((F.col("n") <= GROUP) & (F.col("all") <= GROUP_SHINGLES)).alias("fits"))
            few = stored(close_pairs(groups.join(within.filter("fits").select("group"), "group"), prints, least), "links")
            large = stored(groups.join(within.filter("NOT fits").select("group"), "group"), "large")
            joined = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(few)
            if large.isEmpty():
                joined = components(joined, "a", "b")
                forget(groups, few, large)
                break
            if arrays is None:
                ids = large.select("id").distinct()
                arrays = stored(texts.join(ids, texts["doc_id"] == ids["id"], "left_semi").mapInPandas(listed, f"id {kind}, shingles array<long>").dropDuplicates(["id"]), "arrays")
            met, smaller = parted(large.select("group", "id"), arrays, least)
            fresh = compared(met)
            joined = components(joined.unionAll(fresh), "a", "b")
            forget(groups, large, met, few, fresh)
            groups = several(smaller, joined)
            forget(smaller)
        forget(prints)
        found = joined
    classes = named.join(found, named["rep"] == found["node"], "left").select("same", F.coalesce("component", "rep").alias("component_id"))
    return own.select("doc_id", "same").join(classes, "same").select("doc_id", "component_id")
