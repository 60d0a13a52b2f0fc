"""Operator 10: passages that repeat across documents, by collinear chaining.

1. Seeds are hashes of five-word shingles, one of each ``WINDOW`` in a row (the least hash: a minimizer), so any
   run of ``WINDOW`` + 4 equal words shares a seed. That choice depends on the words alone, not on the row. With each
   seed goes its run: the hash of the ``MIN_WORDS`` words that start there.
2. Where an earlier document holds the run too, the place is tied to the run's first holder. That document holds a passage
   itself, so any ``WINDOW`` + ``MIN_WORDS`` - 1 = 51 equal words are found however common they are, and copies cost each
   document one pair. Every other place is tied to the first holder of its seed and to the first holders of its pairs: the seed
   together with the first seed that starts ``REACH`` words or more behind it, whatever lies between. A document that holds
   a piece of a passage too short for both seeds of a pair can't hide one that holds both, however many such pieces there are.
3. For each document and earlier document, runs of seeds on one diagonal become fragments, and a Fenwick tree over the
   earlier document's places finds the best chain of fragments in order, less a gap cost.
4. Chains are aligned word by word: both ends are extended over equal words and single changes, and longest common
   subsequences between the runs of equal words give the similarity. Chains of 0.8 or more are kept; others are split
   at their widest gap, between fragments or inside one, until each part reaches 0.8 or is one run of equal words.
5. Aligned stretches of a document that overlap or touch are one passage, whichever earlier documents they
   came from; passages of ``MIN_WORDS`` words or more are returned.

The first document keeps its passage; later ones are listed. What is tied by seed is a partial aggregate and joins that
adaptive execution splits; no order of a seed's holders is needed, so results don't turn on how many there are. Each text goes to Python three
times: twice for its seeds, which are too many to store, and for all of its stretches at once.

Defined cases: null or empty texts have no seed; rows with a null id are left out; repeated rows of one id count as
one document, of which the longest text is aligned; passages repeated inside one document only are not reported; words
are compared with A-Z in lower case; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored

SHINGLE, WINDOW = 5, 12
MIN_WORDS = 40
#: Least words from the first to the second seed of a pair; the longest pair spans MIN_WORDS words or more.
REACH = (12, 18, 24, MIN_WORDS - SHINGLE)
PAIRS = [f"pair{n}" for n in range(len(REACH))]
#: Score of a fragment's first seed, and cost of each word between two fragments, on either side.
SEED_SCORE, GAP = 5.0, 0.1
#: Words between anchors of one fragment, and words on both sides of a chain that its alignment may reach.
MARGIN, AROUND = 32, 64
#: An extension gains 1 for an equal word, loses CHANGE for a changed one and ends when it has lost DROP.
CHANGE, DROP = 2, 12
#: Words of a gap between equal runs beyond which it is aligned only if the chain may still be similar enough.
WIDE = 256
#: Words from the first to the last shingle of a run.
LONG = MIN_WORDS - SHINGLE
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def winnowed(k: np.ndarray, window: int) -> np.ndarray:
    """Places of the minimizers of ``k``."""
    if len(k) <= window:
        return np.array([k.argmin()])
    v = np.lib.stride_tricks.sliding_window_view(k, window)
    return np.unique(v.argmin(axis=1) + np.arange(len(v)))


def mixed(k: np.ndarray) -> np.ndarray:
    k = (k ^ (k >> np.uint64(32))) * M2
    return k ^ (k >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of a text's shingles, in order."""
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()], np.uint64)
    if len(h) < SHINGLE:
        return np.zeros(0, np.uint64)
    k = h[: len(h) - SHINGLE + 1].copy()
    for j in range(1, SHINGLE):
        k = (k ^ (k >> np.uint64(31))) * M1 + h[j : len(h) - SHINGLE + 1 + j]
    return mixed(k)


def keys(text: str | None) -> tuple[np.ndarray, ...]:
    """Seeds of a text, the words they start at, and the hash of the run at each (0 where fewer words are left)."""
    k = shingles(text)
    if len(k) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    at = winnowed(k, WINDOW)
    whole = at[at + LONG < len(k)]
    h = k[whole]
    for j in range(SHINGLE, LONG + 1, SHINGLE):
        h = (h ^ (h >> np.uint64(31))) * M1 + k[whole + j]
    run = np.zeros(len(at), np.int32)
    run[: len(whole)] = (mixed(h) | np.uint64(1)).astype(np.uint32).view(np.int32)
    return k[at], at.astype(np.int32), run


def pairs_of(seed: np.ndarray, pos: np.ndarray, counts: list[int]) -> list[np.ndarray]:
    """Pairs of the seeds of many texts, ``counts`` seeds of each: 24 bits of the second seed's hash and 8 of its distance in words, or 0."""
    text = np.repeat(np.arange(len(counts)), counts)
    at = pos.astype(np.int64) + text * (1 << 32)
    out = []
    for least in REACH:
        second = np.minimum(np.searchsorted(at, at + least), len(at) - 1)
        far = at[second] - at
        code = ((seed[second] >> np.uint64(8)).astype(np.uint32) | np.uint32(1)) << np.uint32(8) | far.astype(np.uint32)
        out.append(np.where((far >= least) & (text[second] == text), code, np.uint32(0)).view(np.int32))
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, seed, pos, run, pairs) of all documents; a run or pair is known by its seed and its hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["pos", "run", *PAIRS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 1000):
                part = b.iloc[lo : lo + 1000]
                got = [keys(t) for t in part["text"]]
                seed, pos, runs = (np.concatenate(c) for c in zip(*got, strict=True))
                counts = [len(g[0]) for g in got]
                ids = np.repeat(part["doc_id"].to_numpy(), counts)
                rest = [pos, runs, *pairs_of(seed, pos, counts)]
                yield pd.DataFrame({"doc_id": ids, "seed": seed.view(np.int64)} | dict(zip(names, rest, strict=True)))

    schema = ", ".join([f"doc_id {kind}", "seed long", *[f"{n} int" for n in names]])
    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInPandas(run, schema)


def ties(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, ref, pos, rpos, span): places of documents that an earlier document ``ref`` holds too, and the tables behind them.

    ``span`` is the words from the first to the last shingle of what is held: ``LONG`` for a run, 0 for a seed. A pair gives the places of both its seeds.
    """

    def holders(rows: DataFrame, name: str, *key: str) -> DataFrame:
        """First holder of each key that several documents have, stored: joins with it are plain exchanges, which can be split."""
        own = rows.groupBy(*key).agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.max("doc_id").alias("last"), F.count("*").cast("int").alias(f"{name}_n"))
        return stored(own.filter("f.doc_id < last").select(*key, F.col("f.doc_id").alias(f"{name}_ref"), F.col("f.pos").alias(f"{name}_pos"), f"{name}_n"), name)

    seeds = sketch(docs)  # made twice and not stored: most seeds are of one document and would take more disk than the texts
    firsts = holders(seeds, "seed", "seed")
    some = stored(seeds.join(firsts, "seed"), "some")
    forget(firsts)
    runs = holders(some.filter("run <> 0"), "run", "seed", "run")
    tied = F.coalesce(F.col("run_ref") < F.col("doc_id"), F.lit(False))
    known = stored(some.join(runs.drop("run_n"), ["seed", "run"], "left").withColumn("tied", tied).drop("run"), "known")
    forget(some, runs)

    def tie(rows: DataFrame, name: str, span: int) -> DataFrame:
        return rows.filter(F.col(f"{name}_ref") < F.col("doc_id")).select("doc_id", F.col(f"{name}_ref").alias("ref"), "pos", F.col(f"{name}_pos").alias("rpos"), F.lit(span).alias("span"))

    pair = F.explode(F.array(*[F.struct(F.lit(n).alias("no"), F.col(c).alias("key")) for n, c in enumerate(PAIRS)])).alias("p")
    long = known.filter("seed_n > 2").select("doc_id", "seed", "pos", "tied", "seed_ref", pair).filter("p.key <> 0")
    long = long.select("doc_id", "seed", "pos", "tied", "seed_ref", "p.no", F.expr("shiftrightunsigned(p.key, 8)").alias("pair"), F.expr("p.key & 255").alias("far"))
    own = long.groupBy("seed", "no", "pair").agg(F.min(F.struct("doc_id", "pos", "far")).alias("f"), F.max("doc_id").alias("last"))
    pairs = stored(own.filter("f.doc_id < last").select("seed", "no", "pair", "f"), "pairs")
    met = long.filter("NOT tied").join(pairs, ["seed", "no", "pair"]).filter("f.doc_id < doc_id AND f.doc_id <> seed_ref")
    ends = F.explode(F.array(F.struct("pos", F.col("f.pos").alias("rpos")), F.struct((F.col("pos") + F.col("far")).alias("pos"), (F.col("f.pos") + F.col("f.far")).alias("rpos")))).alias("x")
    by_pair = met.select("doc_id", F.col("f.doc_id").alias("ref"), ends).select("doc_id", "ref", "x.pos", "x.rpos", F.lit(0).alias("span"))
    return tie(known.filter("tied"), "run", LONG).unionAll(tie(known.filter("NOT tied"), "seed", 0)).unionAll(by_pair), [known, pairs]


# ---- chains ----


def fragments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows (x0, x1, y0, y1, seeds): runs of anchors on one diagonal, at most a margin apart; ends are exclusive."""
    order = np.lexsort((x, y - x))
    x, d = x[order], (y - x)[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] - x[:-1] > MARGIN)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x)) - 1
    x0, x1 = x[first], x[last] + SHINGLE
    f = np.stack([x0, x1, x0 + d[first], x1 + d[first], last - first + 1], axis=1)
    return f[np.lexsort((f[:, 2], f[:, 0]))]


def chains(f: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Ends (x0, x1, y0, y1) of the best chains of fragments."""
    return [(c[0][0], c[-1][1], c[0][2], c[-1][3]) for c in linked(f)]


def linked(f: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """Best chains, the fragments (x0, x1, y0, y1) of each in order, every fragment in at most one.

    Fragments come in order of their start in x and are opened to later ones when the sweep has passed their end.
    The Fenwick tree holds, by end in y, the greatest score plus the gap cost up to there; what a later fragment
    pays is then the cost at its own start.
    """
    n = len(f)
    if n == 1:
        return [[tuple(int(v) for v in f[0, :4])]]
    ys = np.unique(f[:, 3])
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ys) + 1)
    rank = np.searchsorted(ys, f[:, 3]) + 1
    ask = np.searchsorted(ys, f[:, 2] + SHINGLE - 1, side="right")  # ends may overlap by less than a shingle
    score, back = [0.0] * n, [-1] * n
    ends = sorted(range(n), key=lambda i: f[i, 1])
    opened = 0
    rows = f.tolist()
    for i, (x0, x1, y0, _, seeds) in enumerate(rows):
        while opened < n and rows[ends[opened]][1] <= x0 + SHINGLE - 1:
            j = ends[opened]
            opened += 1
            if j >= i:
                continue
            v = (score[j] + GAP * (rows[j][1] + rows[j][3]), j)
            k = int(rank[j])
            while k < len(tree):
                if v[0] > tree[k][0]:
                    tree[k] = v
                k += k & -k
        best, k = (-1e18, -1), int(ask[i])
        while k > 0:
            if tree[k][0] > best[0]:
                best = tree[k]
            k -= k & -k
        gain = best[0] - GAP * (x0 + y0)
        own = SEED_SCORE + (seeds - 1)
        if gain > 0:
            score[i], back[i] = own + gain, best[1]
        else:
            score[i] = own
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        if used[i]:
            continue
        k, chain = i, []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(tuple(rows[k][:4]))
            k = back[k]
        out.append(chain[::-1])
    return out


def anchors_of(x: np.ndarray, y: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal shingles on both sides: the first and last of each key, and one between in long keys."""
    step = np.concatenate([np.zeros(len(x), np.int64), span[span > 0], span[span > MARGIN] // 2])
    both = [np.concatenate([v, v[span > 0], v[span > MARGIN]]) + step for v in (x, y)]
    return tuple(np.unique(np.stack(both), axis=1))


def inside(x: np.ndarray) -> Callable[[int, int], bool]:
    """Whether words first to end lie within the runs of MIN_WORDS words that start at ``x``, where these overlap or touch."""
    x = np.sort(x)
    new = np.flatnonzero(np.concatenate([[True], x[1:] - x[:-1] > MIN_WORDS])) if len(x) else np.zeros(0, int)
    begin = x[new]
    stop = x[np.append(new[1:], len(x)) - 1] + MIN_WORDS if len(x) else x

    def ask(first: int, end: int) -> bool:
        k = int(np.searchsorted(begin, first, "right")) - 1
        return k >= 0 and end <= stop[k]

    return ask


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal keys out of a partition sorted by them."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        k = b[key].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1])
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            yield b.iloc[s:e]
        rest = b.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def chained(anchors: DataFrame, kind: str) -> DataFrame:
    """Chains (doc_id, ref, s, e, rs, re, fragments) of the anchors (doc_id, ref, pos, rpos, span) that may lie in a passage.

    ``fragments`` has four numbers for each: x0, x1, y0, y1. Left out are chains without a run of MIN_WORDS words that
    lie within the runs which the document shares with others.
    """
    names = ["doc_id", "ref", "s", "e", "rs", "re", "fragments"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for b in _chunks(batches):
            doc, ref, x, y, span = (b[c].to_numpy() for c in ("doc_id", "ref", "pos", "rpos", "span"))
            starts = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1])) + 1, [len(doc)]])
            own, covered = None, None
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if own is None or doc[s] != own:
                    own, last = doc[s], int(np.searchsorted(doc, doc[s], "right"))
                    covered = inside(x[s:last][span[s:last] == LONG])
                for c in linked(fragments(*anchors_of(x[s:e], y[s:e], span[s:e]))) if e - s > 1 or span[s] else ():
                    first, end = c[0][0], c[-1][1]
                    if end - first > SHINGLE and not (covered(first, end) and not ((span[s:e] == LONG) & (x[s:e] >= first) & (x[s:e] < end)).any()):
                        rows.append((doc[s], ref[s], first, end, c[0][2], c[-1][3], [v for g in c for v in g]))
            if len(rows) > 20_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The partition in parts that end where a document ends."""
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            last = int(np.searchsorted(b["doc_id"].to_numpy(), b["doc_id"].iloc[-1], "left"))
            if last:
                yield b.iloc[:last]
            rest = b.iloc[last:]
        if rest is not None and len(rest):
            yield rest

    ready = anchors.repartition("doc_id").sortWithinPartitions("doc_id", "ref", "pos", "rpos", "span")
    return ready.mapInPandas(run, f"doc_id {kind}, ref {kind}, s int, e int, rs int, re int, fragments array<int>")


# ---- alignment ----


def common_length(x: list, y: list) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    where: dict = {}
    for i, w in enumerate(x):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(x)) - 1
    v = full
    for w in y:
        u = v & where.get(w, 0)
        v = (v + u | v - u) & full
    return len(x) - v.bit_count()


def extend(x: list, y: list, at: int, to: int, step: int) -> tuple[int, int]:
    """Words by which equal words go on in one direction, with single changes between them, and how many of them are equal."""
    best = run = score = top = 0
    while 0 <= at < len(x) and 0 <= to < len(y):
        score += 1 if x[at] == y[to] else -CHANGE
        run += 1
        if score > top:
            best, top = run, score
        elif score < top - DROP:
            break
        at, to = at + step, to + step
    return best, (top + CHANGE * best) // (1 + CHANGE)


def equal_runs(x: list, y: list, parts: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs of a shingle or more equal words on the diagonals of a chain's fragments, in order."""
    out = []
    for x0, x1, y0, _ in parts:
        start = x0
        if x[x0:x1] == y[y0 : y0 + x1 - x0]:
            out.append((x0, x1, y0, y0 + x1 - x0))
            continue
        for i in range(x0, x1 + 1):
            if i == x1 or x[i] != y[y0 + i - x0]:
                if i - start >= SHINGLE:
                    out.append((start, i, y0 + start - x0, y0 + i - x0))
                start = i + 1
    return out


class Chain:
    """Equal runs of a chain, cut where they overlap, and the equal words of any part of it in constant time.

    Words between two runs count by their longest common subsequence; that of a gap beyond ``WIDE`` words is found only
    once it can matter.
    """

    def __init__(self, x: list, y: list, runs: list[tuple[int, int, int, int]]) -> None:
        self.x, self.y, self.runs = x, y, []
        for a, b, c, d in runs:
            skip = max(0, self.runs[-1][1] - a, self.runs[-1][3] - c) if self.runs else 0
            if a + skip < b:
                self.runs.append((a + skip, b, c + skip, d))
        self.between = [(r[0] - q[1], r[2] - q[3]) for q, r in zip(self.runs, self.runs[1:], strict=False)]
        self.width = [max(g) for g in self.between]
        self.wide = [k for k, w in enumerate(self.width) if w > WIDE]
        self.met: dict[int, int] = {}
        same = [0 if w > WIDE else self._gap(k) for k, w in enumerate(self.width)] + [0]
        self.upto = list(accumulate((b - a + s for (a, b, _, _), s in zip(self.runs, same, strict=False)), initial=0))

    def _gap(self, k: int) -> int:
        q, r = self.runs[k], self.runs[k + 1]
        return common_length(self.x[q[1] : r[0]], self.y[q[3] : r[2]]) if min(self.between[k]) else 0

    def common(self, i: int, j: int, enough: float) -> int:
        """Equal words from run i to run j, or less than ``enough`` if they can't be as many."""
        first, last = self.runs[i], self.runs[j]
        # the words of gap j are in the sum up to run j + 1, so run j is added by itself
        total = self.upto[j] - self.upto[i] + last[1] - last[0]
        wide = self.wide[bisect_left(self.wide, i) : bisect_left(self.wide, j)]
        if total + sum(min(self.between[k]) for k in wide) < enough:
            return total
        for k in wide:
            if k not in self.met:
                self.met[k] = self._gap(k)
            total += self.met[k]
        return total

    def extended(self, i: int, j: int, least: float) -> tuple[int, int, float] | None:
        """Ends in x and similarity from run i to run j, extended where it stays similar enough; None if it isn't."""
        (s, _, rs, _), (_, e, _, re) = self.runs[i], self.runs[j]
        words = max(e - s, re - rs)
        same = self.common(i, j, least * words)
        if same < least * words:
            return None
        left, a = extend(self.x, self.y, s - 1, rs - 1, -1)
        right, b = extend(self.x, self.y, e, re, 1)
        more = a + b
        if same + more >= least * (words + left + right):
            return s - left, e + right, (same + more) / (words + left + right)
        return s, e, same / words

    def widest(self) -> tuple[list[int], list[int], int]:
        """Gaps as a tree, each wider than those below it on both sides: left and right gap below each, and the top."""
        left, right, stack = [-1] * len(self.width), [-1] * len(self.width), []
        for k, w in enumerate(self.width):
            last = -1
            while stack and self.width[stack[-1]] < w:
                last = stack.pop()
            left[k] = last
            if stack:
                right[stack[-1]] = k
            stack.append(k)
        return left, right, stack[0] if stack else -1


def align(x: list, y: list, runs: list[tuple[int, int, int, int]]) -> tuple[int, int, float]:
    """A chain of equal runs, extended: its ends in x, and the similarity."""
    chain = Chain(x, y, runs)
    return chain.extended(0, len(chain.runs) - 1, 0)


def stretches(x: list, y: list, parts: list[tuple[int, int, int, int]], least: float) -> list[tuple[int, int, float]]:
    """Aligned stretches of a chain: the whole, or what is left when it is split at its widest gaps until similar enough.

    The words between runs are aligned once and each part is judged by sums, so a chain of n runs takes n steps.
    """
    chain, out = Chain(x, y, equal_runs(x, y, parts)), []
    left, right, top = chain.widest()
    todo = [(0, len(chain.runs) - 1, top)] if chain.runs else []
    while todo:
        i, j, k = todo.pop()
        got = chain.extended(i, j, least)
        if got is not None:
            out.append(got)
        else:
            todo += [(i, k, left[k]), (k + 1, j, right[k])]
    return out


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _cut(asked: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """(id, first, end, part): words first to end of the documents, for each distinct row asked.

    A document's text and what is asked of it come to one task in order, so that each text is split once.
    """
    none = F.lit(None)
    want = asked.distinct().select("id", F.lit(1).alias("kind"), "first", "end", none.cast("string").alias("text"))
    have = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text").join(asked.select("id").distinct(), "id", "left_semi")
    have = have.select("id", F.lit(0).alias("kind"), none.cast("int").alias("first"), none.cast("int").alias("end"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, words = None, []
        for b in batches:
            rows = []
            for id_, kind_, first, end, text in b.itertuples(index=False):
                if kind_ == 0:
                    own = split(text)
                    if last is None or id_ != last or len(own) > len(words):  # repeated rows of an id: the longest text
                        last, words = id_, own
                else:
                    rows.append((id_, int(first), int(end), b" ".join(words[int(first) : int(end)])))
            yield pd.DataFrame(rows, columns=["id", "first", "end", "part"])

    ordered = want.unionAll(have).repartition("id").sortWithinPartitions("id", "kind", "first", "end")
    return ordered.mapInPandas(run, f"id {kind}, first int, end int, part binary")


def passages(docs: DataFrame, least: float = 0.8, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first_word, words, ref_doc_id, similarity): passages that an earlier document holds too.

    ``ref_doc_id`` and ``similarity`` are those of the longest aligned stretch in the passage.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    anchors, behind = ties(docs)
    low = lambda c: F.greatest(F.col(c) - AROUND, F.lit(0))
    spans = chained(anchors, kind).withColumns({"lo": low("s"), "hi": F.col("e") + AROUND, "rlo": low("rs"), "rhi": F.col("re") + AROUND})
    spans = stored(spans, "chains")
    forget(*behind)
    asked = spans.select(F.col("doc_id").alias("id"), F.col("lo").alias("first"), F.col("hi").alias("end")).unionAll(spans.select("ref", "rlo", "rhi"))
    parts = stored(_cut(asked, docs, kind), "parts")  # as above: many copies share a stretch
    mine = parts.select(F.col("id").alias("doc_id"), F.col("first").alias("lo"), F.col("end").alias("hi"), F.col("part").alias("x"))
    theirs = parts.select(F.col("id").alias("ref"), F.col("first").alias("rlo"), F.col("end").alias("rhi"), F.col("part").alias("y"))
    both = spans.join(theirs, ["ref", "rlo", "rhi"]).join(mine, ["doc_id", "lo", "hi"]).select("doc_id", "ref", "lo", "rlo", "fragments", "x", "y")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, ref, lo, rlo, at, x, y in b.itertuples(index=False):
                at = (np.asarray(at).reshape(-1, 4) - [lo, lo, rlo, rlo]).tolist()
                x, y = bytes(x).split(), bytes(y).split()
                if at[-1][1] > len(x) or at[-1][3] > len(y):
                    continue  # a place in another text of a repeated id
                for first, end, similarity in stretches(x, y, at, least):
                    rows.append((doc_id, lo + first, lo + end, ref, similarity))
            yield pd.DataFrame(rows, columns=["doc_id", "s", "e", "ref", "similarity"])

    aligned = both.mapInPandas(compare, f"doc_id {kind}, s int, e int, ref {kind}, similarity double")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        now: list | None = None

        def close() -> None:
            if now is not None and now[2] - now[1] >= min_words:
                rows.append((now[0], now[1], now[2] - now[1], now[4], round(now[5], 6)))

        for b in batches:
            for doc_id, s, e, ref, similarity in b.itertuples(index=False):
                if now is not None and now[0] == doc_id and s <= now[2] + 1:
                    now[2] = max(now[2], e)
                    if e - s > now[3]:
                        now[3:] = [e - s, ref, similarity]
                else:
                    close()
                    now = [doc_id, s, e, e - s, ref, similarity]
            yield pd.DataFrame(rows, columns=["doc_id", "first_word", "words", "ref_doc_id", "similarity"])
            rows = []
        close()
        yield pd.DataFrame(rows, columns=["doc_id", "first_word", "words", "ref_doc_id", "similarity"])

    ordered = aligned.repartition("doc_id").sortWithinPartitions("doc_id", "s", "e", "ref")
    return ordered.mapInPandas(merge, f"doc_id {kind}, first_word int, words int, ref_doc_id {kind}, similarity double")
