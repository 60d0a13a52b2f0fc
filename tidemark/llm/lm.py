"""Operator 6: language-model scoring by context-tree weighting.

The model is a context tree over bytes. A byte is eight binary choices; at each depth 0 to ``DEPTH`` the context of the
last bytes has a Krichevsky-Trofimov estimator for each choice, and context-tree weighting mixes all depths:
a node's weighted probability is half its own estimate plus half the product of its children's, and the shares that follow
from it weigh the depths when a byte is predicted. What is coded is the running text: its words, a space behind each, and
the end, so contexts reach across words. Before a text's first byte stand spaces.

A byte with its context is a window of ``DEPTH`` + 1 bytes:

1. each task counts the windows of its texts and deals them by hash of the context, packed, to the tasks that sum them up;
2. sums are dealt by the last two context bytes, so that all nodes of depth two or more of a context lie together;
   what depths 0 and 1 need is a table of at most 256 x 256 sums;
3. texts are scored where they are read. Of the windows and tokens the commonest, ``SHARED`` and ``COMMON`` at most, are
   broadcast; all others are joined.

Defined cases: a null or empty text is one end token; rows with a null id are scored, and taught from only if ``teach`` is
true for them; repeated rows give one result row each; with nothing to learn from all tokens are unknown and bits are
even; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import stored

DEPTH = 6
#: Tokens and windows that are broadcast, the commonest, at most.
COMMON, SHARED = 1 << 16, 5 << 18
#: Bytes of text whose windows are listed at once, and windows that a task holds before it passes them on.
PIECE, HELD = 1 << 19, 700_000
#: Bytes that no text holds: the end, and what stands before a window where it is joined like a token.
END, MARK = b"\xff", b"\xfe"
LN10 = math.log(10)


def tokens(text: str | None) -> list[bytes]:
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


# ---- windows ----


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The window of every byte of some texts: the byte in the low bits, its context above, the last byte lowest; and the texts' sizes."""
    gap = b" " * DEPTH
    a = np.frombuffer(gap + gap.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    n = len(a) - DEPTH
    w = np.zeros(n, np.int64)
    for k in range(DEPTH, -1, -1):
        w <<= 8
        w |= a[DEPTH - k : DEPTH - k + n]
    between = np.ones(n, bool)
    for at in np.cumsum(sizes + DEPTH)[:-1].tolist():
        between[at - DEPTH : at] = False
    return w[between], sizes


def summed(w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows in order, and the sums of their counts."""
    if len(w) == 0:
        return w, n
    order = np.argsort(w, kind="stable")
    w = w[order]
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    return w[first], np.add.reduceat(n[order], first)


def counted(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of some texts, and their counts by the texts' weights."""
    parts = []
    for weight in np.unique(weights):
        w = np.sort(windows([texts[i] for i in np.flatnonzero(weights == weight)])[0])
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        parts.append((w[first], np.diff(np.append(first, len(w))) * weight))
    return summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def pack(values: np.ndarray) -> bytes:
    """Numbers as eight planes of bytes, which are compressed well where high bytes are equal."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


class Lookup:
    """Scores of windows, asked for by arrays; the first to ask in a process has the table of open addresses made."""

    def __init__(self, window: np.ndarray, lp: np.ndarray) -> None:
        self.rows, self.bits = (window, lp), 0

    def _open(self) -> None:
        window, lp = self.rows
        self.bits = max(4, (3 * len(window) // 2).bit_length())
        self.key, self.lp = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.float32)
        slot = self._slot(window)
        while len(window):
            free = np.flatnonzero(self.key[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            own = free[first]
            self.key[taken], self.lp[taken] = window[own], lp[own]
            rest = np.ones(len(window), bool)
            rest[own] = False
            window, lp, slot = window[rest], lp[rest], self._next(slot[rest])
        self.rows = None

    def _slot(self, window: np.ndarray) -> np.ndarray:
        return ((window.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def ask(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each window, 0 where it has none here; and the places of those."""
        if not self.bits:
            self._open()
        slot = self._slot(window)
        got = self.key[slot]
        out = self.lp[slot].astype(float)
        todo = np.flatnonzero(got != window)
        out[todo] = 0
        missing = [todo[got[todo] < 0]]
        todo = todo[got[todo] >= 0]
        slot = slot[todo]
        while len(todo):
            slot = self._next(slot)
            got, want = self.key[slot], window[todo]
            hit = got == want
            out[todo[hit]] = self.lp[slot[hit]]
            missing.append(todo[got < 0])
            rest = ~hit & (got >= 0)
            todo, slot = todo[rest], slot[rest]
        return out, np.concatenate(missing)


# ---- the tree ----

_LOG = np.array([math.lgamma(k + 0.5) for k in range(4096)])
_LOGF = np.array([math.lgamma(k + 1.0) for k in range(4096)])


def _lgamma(x: np.ndarray, small: np.ndarray, shift: float) -> np.ndarray:
    """log gamma of counts + shift: a table for small counts, Stirling's series beyond."""
    z = np.maximum(x, 16) + shift
    big = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3)
    return np.where(x < len(small), small[np.minimum(x, len(small) - 1)], big)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _lgamma(a, _LOG, 0.5) + _lgamma(b, _LOG, 0.5) - math.log(math.pi) - _lgamma(a + b, _LOGF, 1.0)


def log_own(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability of a zeros and b ones under a node's own estimator.

    Half Krichevsky-Trofimov, a quarter each for a source of zeros only and of ones only: the usual refinement that keeps
    contexts with one continuation from paying for the other at each of eight choices.
    """
    return np.where((a > 0) & (b > 0), log_kt(a, b) - math.log(2), np.log(np.exp(log_kt(a, b)) / 2 + np.where(a + b > 0, 0.25, 0.5)))


def next_bit(a: np.ndarray, b: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Probability of a bit after a zeros and b ones."""
    n = a + b
    mixed = (np.where(bit == 1, b, a) + 0.5) / (n + 1)
    kt = np.exp(log_kt(n, np.zeros_like(n)))  # of n equal bits
    other = kt * 0.5 / (n + 1) / (kt + 0.5)
    same = np.where(b > 0, 1, 0) == bit
    return np.where(n == 0, 0.5, np.where((a > 0) & (b > 0), mixed, np.where(same, 1 - other, other)))


def choices(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node (1 to 255) and bit of the eight choices of each byte, shape (8, n)."""
    i = np.arange(8)[:, None]
    return (1 << i) | (symbol >> (8 - i)), (symbol >> (7 - i)) & 1


class Level:
    """Nodes of one depth: zero and one counts, and log weighted probability."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
        self.key, self.at = np.unique(key, return_inverse=True)
        self.at = self.at.reshape(key.shape).astype(np.int32)
        self.a = np.bincount(self.at.ravel(), zeros.ravel(), len(self.key)).astype(np.int64)
        self.b = np.bincount(self.at.ravel(), ones.ravel(), len(self.key)).astype(np.int64)
        self.own = log_own(self.a, self.b)
        self.seen = self.a + self.b > 0
        self.next = np.stack([next_bit(self.a, self.b, np.full(len(self.key), bit)) for bit in (0, 1)], axis=1).ravel()

    def weigh(self, below: np.ndarray | None) -> None:
        """below: sum of the children's log weighted probabilities; None for the deepest level."""
        self.log_w = self.own if below is None else np.logaddexp(self.own, below) - math.log(2)
        self.share = np.ones(len(self.key)) if below is None else np.exp(np.minimum(0, self.own - math.log(2) - self.log_w))

    def mix(self, rows: slice, bit: np.ndarray, deeper: np.ndarray | None, seen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each bit of some windows from this level and the one below it, and whether this level has been seen."""
        at = self.at[:, rows]
        own = self.next[2 * at + bit]
        if deeper is None:
            return own, self.seen[at]
        s = self.share[at]
        return np.where(seen, s * own + (1 - s) * deeper, own), self.seen[at]


def _levels(window: np.ndarray, count: np.ndarray, least: int, most: int) -> tuple[list[Level], np.ndarray]:
    """Levels of depth least to most over windows whose contexts of the least depth are complete here, and the bits."""
    node, bit = choices(window & 255)
    zeros, ones = np.where(bit == 0, count, 0), np.where(bit == 1, count, 0)
    levels = []
    for d in range(least, most + 1):
        context = (window >> 8) & ((1 << (8 * d)) - 1)
        levels.append(Level((context << 8) | node, zeros, ones))
    for d in range(len(levels) - 1, -1, -1):
        if d == len(levels) - 1:
            levels[d].weigh(None)
        else:
            child = levels[d + 1]
            depth = least + d
            parent = ((child.key >> 8) & ((1 << (8 * depth)) - 1)) << 8 | (child.key & 255)
            levels[d].weigh(np.bincount(np.searchsorted(levels[d].key, parent), child.log_w, len(levels[d].key)))
    return levels, bit


class Top:
    """Depths 0 and 1 from counts of (last byte, byte) and the sums of depth 2 by (last byte, node)."""

    def __init__(self, pair: np.ndarray, count: np.ndarray, key: np.ndarray, log_w: np.ndarray) -> None:
        node, bit = choices(pair & 255)
        zeros, ones = np.where(bit == 0, count, 0), np.where(bit == 1, count, 0)
        self.a, self.b = np.zeros((2, 65536), np.int64), np.zeros((2, 65536), np.int64)
        for d, context in ((0, np.zeros_like(pair)), (1, pair >> 8)):
            k = (context << 8 | node).ravel()
            self.a[d] = np.bincount(k, zeros.ravel(), 65536)
            self.b[d] = np.bincount(k, ones.ravel(), 65536)
        below = np.zeros(65536)
        below[key] = log_w
        own1 = log_own(self.a[1], self.b[1])
        log1 = np.logaddexp(own1, below) - math.log(2)
        own0 = log_own(self.a[0], self.b[0])
        sum0 = np.zeros(65536)
        sum0[:256] = log1.reshape(256, 256).sum(axis=0)
        log0 = np.logaddexp(own0, sum0) - math.log(2)
        self.share = np.exp(np.minimum(0, np.stack([own0 - log0, own1 - log1]) - math.log(2)))

    def finish(self, window: np.ndarray, bit: np.ndarray, deeper: np.ndarray, seen: np.ndarray) -> np.ndarray:
        node, _ = choices(window & 255)
        for d in (1, 0):
            k = node if d == 0 else ((window >> 8) & 255) << 8 | node
            a, b = self.a[d][k], self.b[d][k]
            own = next_bit(a, b, bit)
            s = self.share[d][k]
            deeper, seen = np.where(seen, s * own + (1 - s) * deeper, own), a + b > 0
        return np.log(deeper).sum(axis=0) / LN10


def window_scores(window: np.ndarray, count: np.ndarray, top: Top) -> np.ndarray:
    """log10 probability of each window's byte."""
    levels, bit = _levels(window, count, 2, DEPTH)
    out = np.empty(len(window))
    for lo in range(0, len(window), 10_000):
        rows = slice(lo, lo + 10_000)
        p = seen = None
        for level in reversed(levels):
            p, seen = level.mix(rows, bit[:, rows], p, seen)
        out[rows] = top.finish(window[rows], bit[:, rows], p, seen)
    return out


def _whole_contexts(batches: Iterator[pd.DataFrame], rows: int = 40_000) -> Iterator[pd.DataFrame]:
    """Runs of whole contexts of two bytes out of a partition sorted by ``deal``."""
    rest: list[pd.DataFrame] = []
    size, need = 0, rows
    for b in batches:
        rest.append(b)
        size += len(b)
        if size >= need:
            g = pd.concat(rest, ignore_index=True)
            last = int(np.searchsorted(g["deal"].to_numpy(), g["deal"].iloc[-1], "left"))
            if last:
                yield g.iloc[:last]
            rest, size = [g.iloc[last:]], len(g) - last
            need = max(rows, 2 * size)
    if size:
        yield pd.concat(rest, ignore_index=True)


# ---- jobs ----


def token_counts(docs: DataFrame, teach: Column) -> DataFrame:
    """(token, c): distinct tokens of all documents with their count in those that are taught from."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taught: Counter = Counter()
        other: set = set()

        def rows() -> pd.DataFrame:
            fresh = [t for t in other if t not in taught]
            return pd.DataFrame({"token": [*taught, *fresh], "c": [*taught.values(), *[0] * len(fresh)]})

        for b in batches:
            for text, learn in zip(b["text"], b["teach"], strict=True):
                (taught if learn else other).update(tokens(text))
            if len(taught) + len(other) > 300_000:
                yield rows()
                taught.clear()
                other.clear()
        yield rows()

    some = docs.select("text", F.coalesce(teach, F.lit(False)).alias("teach")).mapInPandas(run, "token binary, c long")
    return some.groupBy("token").agg(F.sum("c").alias("c"))


def pieces(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of ``PIECE`` bytes or one text."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            yield slice(lo, i)
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield slice(lo, len(texts))


def window_sums(rows: DataFrame, coded: Callable) -> DataFrame:
    """(window, n): the distinct windows of all rows with the sums of their weights. ``coded`` gives a batch's texts as bytes and their weights."""
    parts = max(4, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = 8 * parts

    def dealt(w: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        bucket = ((w >> 8).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).view(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        w, n, bucket = w[order], n[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(w) else np.zeros(0, np.int64)
        spans = list(zip(first, [*first[1:], len(w)][: len(first)], strict=True))
        return pd.DataFrame({"bucket": bucket[first], "w": [pack(np.diff(w[s:e], prepend=0)) for s, e in spans], "n": [pack(n[s:e]) for s, e in spans]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, fresh, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for b in (whole.iloc[lo : lo + 200] for whole in batches for lo in range(0, len(whole), 200)):
            texts, weights = coded(b)
            for part in pieces(texts):
                fresh.append(counted(texts[part], weights[part]))
                size += len(fresh[-1][0])
                if size > HELD:
                    held, fresh, size = summed(*(np.concatenate(x) for x in zip(held, *fresh, strict=True))), [], 0
                    if len(held[0]) > 3 * HELD:
                        yield dealt(*held)
                        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield dealt(*summed(*(np.concatenate(x) for x in zip(held, *fresh, strict=True))))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, fresh, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for b in batches:
            for w, n in zip(b["w"], b["n"], strict=True):
                fresh.append((np.cumsum(unpack(w)), unpack(n)))
                size += len(fresh[-1][0])
                if size > HELD:
                    held, fresh, size = summed(*(np.concatenate(x) for x in zip(held, *fresh, strict=True))), [], 0
        w, n = summed(*(np.concatenate(x) for x in zip(held, *fresh, strict=True)))
        for lo in range(0, len(w), 200_000):
            yield pd.DataFrame({"window": w[lo : lo + 200_000], "n": n[lo : lo + 200_000]})

    return rows.mapInPandas(count, "bucket long, w binary, n binary").repartition(parts, "bucket").mapInPandas(merge, "window long, n long")


def scored_windows(sums: DataFrame) -> DataFrame:
    """(window, n, lp): log10 probability of each window's byte under the context tree. ``sums`` is a stored table."""
    spark = sums.sparkSession
    deal = F.shiftright("window", 8).bitwiseAND(F.lit(65535)).cast("int")
    ordered = sums.withColumn("deal", deal).repartition("deal").sortWithinPartitions("deal")

    def depth_two(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _whole_contexts(batches):
            levels, _ = _levels(g["window"].to_numpy(), g["n"].to_numpy(), 2, DEPTH)
            two = levels[0]
            yield pd.DataFrame({"key": (two.key >> 8 & 255) << 8 | two.key & 255, "log_w": two.log_w}).groupby("key", as_index=False).sum()

    two = ordered.mapInPandas(depth_two, "key long, log_w double").groupBy("key").agg(F.sum("log_w").alias("log_w")).toPandas()  # at most 65,536 rows
    pair = F.col("window").bitwiseAND(F.lit(65535))
    pairs = sums.groupBy(pair.alias("pair")).agg(F.sum("n").alias("n")).toPandas()  # at most 65,536 rows
    top = spark.sparkContext.broadcast(Top(pairs["pair"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64), two["key"].to_numpy(np.int64), two["log_w"].to_numpy(float)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _whole_contexts(batches):
            w, n = g["window"].to_numpy(), g["n"].to_numpy()
            yield pd.DataFrame({"window": w, "n": n, "lp": window_scores(w, n, top.value)})

    return ordered.mapInPandas(score, "window long, n long, lp double")


def commonest(table: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the greatest counts, ``most`` at most; rows of nearly one count go together."""
    bins = table.filter(F.col(count) > 0).groupBy(F.floor(F.log2(count) * 8).alias("bin")).agg(F.count("*").alias("rows"), F.min(count).alias("least"))
    total, least = 0, None
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):  # at most 512 rows
        total += r["rows"]
        if total > most:
            break
        least = r["least"]
    return table.filter(F.lit(False) if least is None else F.col(count) >= least)


def _window_model(rows: DataFrame, coded: Callable) -> tuple[DataFrame, Broadcast]:
    """Scores of all windows as (token, lp), named so that they can be joined like tokens; and those of the commonest, broadcast."""
    table = stored(scored_windows(stored(window_sums(rows, coded), "sums")), "windows")
    some = commonest(table, "n", SHARED).select("window", F.col("lp").cast("float")).toArrow()  # at most SHARED rows
    shared = rows.sparkSession.sparkContext.broadcast(Lookup(some["window"].to_numpy(), some["lp"].to_numpy()))
    name = F.concat(F.lit(bytearray(MARK)), F.unhex(F.lpad(F.hex("window"), 16, "0")))
    return table.select(name.alias("token"), "lp"), shared


def text_scores(texts: list[bytes], table: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores of texts by the windows in a table; and text, window and count of those that aren't there."""
    w, sizes = windows(texts)
    lp, missing = table.ask(w)
    total = np.add.reduceat(lp, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    text, w = np.repeat(np.arange(len(texts)), sizes)[missing], w[missing]
    order = np.lexsort((w, text))
    text, w = text[order], w[order]
    first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (text[1:] != text[:-1])])) if len(w) else np.zeros(0, np.int64)
    return total, text[first], w[first], np.diff(np.append(first, len(w)))


def names(window: np.ndarray) -> pa.Array:
    """Windows as they are joined like tokens: ``MARK`` and eight bytes."""
    data = np.empty((len(window), 9), np.uint8)
    data[:, 0] = MARK[0]
    data[:, 1:] = window.astype(">i8").view(np.uint8).reshape(-1, 8)
    return pa.Array.from_buffers(pa.binary(), len(window), [None, pa.py_buffer(np.arange(len(window) + 1, dtype=np.int32) * 9), pa.py_buffer(data)])


def token_scores(counts: DataFrame) -> DataFrame:
    """(token, c, lp): log10 probability of each token as a text of its own, in a tree of all tokens by their counts."""

    def bytes_of(b: pd.DataFrame) -> tuple[list[bytes], np.ndarray]:
        return [bytes(t) if bytes(t) == END else bytes(t) + b" " for t in b["token"]], b["c"].to_numpy(np.int64)

    table, shared = _window_model(counts, bytes_of)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, _ = bytes_of(b)
            for part in pieces(texts):
                total, at, w, k = text_scores(texts[part], shared.value)
                own = b["token"].to_numpy()[part]
                yield pd.DataFrame({"own": own, "token": own, "k": 0, "lm": total})
                yield pd.DataFrame({"own": own[at], "token": names(w).to_pylist(), "k": k, "lm": 0.0})

    parts = counts.mapInPandas(run, "own binary, token binary, k long, lm double")
    lp = F.sum(F.col("lm") + F.when(F.col("k") > 0, F.col("k") * F.col("lp")).otherwise(0.0)).alias("lp")
    total = parts.join(table, "token", "left").groupBy("own").agg(lp)
    return counts.join(total, F.col("token") == F.col("own")).select("token", "c", "lp")


def lm_scores(docs: DataFrame, teach: Column) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    spark = docs.sparkSession
    counts = stored(token_counts(docs, teach), "tokens")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = whole["n"], whole["v"]
    common = commonest(counts, "c", COMMON).toPandas()  # at most COMMON rows
    below = math.log10(n + 0.5 * (v + 1))
    known = spark.sparkContext.broadcast({bytes(t): math.log10(c + 0.5) - below for t, c in zip(common["token"], common["c"], strict=True)})
    kind = docs.schema["doc_id"].dataType.simpleString()

    def bytes_of(b: pd.DataFrame) -> tuple[list[bytes], np.ndarray]:
        return [b" ".join(tokens(t)) for t in b["text"]], b["teach"].to_numpy(np.int64)

    model, shared = _window_model(docs.select("text", F.coalesce(teach, F.lit(False)).alias("teach")), bytes_of)
    scored = counts.select("token", "c", F.lit(None).cast("double").alias("lp")).unionAll(model.select("token", F.lit(None).cast("long").alias("c"), "lp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = known.value
        for b in (whole.slice(lo, 200) for whole in batches for lo in range(0, len(whole), 200)):
            own = [tokens(t) for t in b.column("text").to_pylist()]
            texts, number = [b" ".join(t) for t in own], b.column("row").to_numpy()
            score = np.zeros(len(texts))
            for part in pieces(texts):
                score[part], at, w, k = text_scores(texts[part], shared.value)
                yield rows(number[part][at], names(w), k)
            rare, often, size, nk, bs = [], [], [], [], []
            for words in own:
                known_, sum_, before = 0, 0.0, len(rare)
                for t, k in Counter(words).items():
                    if (hit := base.get(t)) is not None:
                        known_ += k
                        sum_ += k * hit
                    else:
                        rare.append(t)
                        often.append(k)
                size.append(len(rare) - before)
                nk.append(known_)
                bs.append(sum_)
            yield rows(np.repeat(number, size), pa.array(rare, pa.binary()), np.array(often, np.int64))
            mark = [END + r.to_bytes(8, "big") for r in number.tolist()]
            yield rows(number, pa.array(mark, pa.binary()), np.zeros(len(own), np.int64), b.column("doc_id"), pa.array([len(t) for t in own]), pa.array(nk), pa.array(bs), pa.array(score))

    kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "lm": pa.float64()}

    def rows(number: np.ndarray, token: pa.Array, k: np.ndarray, *whole: pa.Array) -> pa.RecordBatch:
        """Rows of tokens and windows to be joined, or of documents: doc_id, n_tokens, n_known, base and lm."""
        rest = whole or [pa.nulls(len(number), t) for t in (id_type, *kinds.values())]
        return pa.RecordBatch.from_arrays([pa.array(number), pa.array(k), token, *[c.cast(t) for c, t in zip(rest, (id_type, *kinds.values()), strict=True)]], ["row", "k", "token", "doc_id", *kinds])

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    parts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, f"row long, k long, token binary, doc_id {kind}, n_tokens long, n_known long, base double, lm double")
    joined = parts.join(scored, "token", "left")
    k = F.col("k")
    own = F.log10(F.col("c") + 0.5) - F.lit(below)
    return (
        joined.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.coalesce("n_known", F.lit(0)) + F.when(F.col("c") > 0, k).otherwise(0)).cast("long").alias("n_known"),
            F.sum(F.coalesce("base", F.lit(0.0)) + F.when(F.col("c").isNotNull(), k * own).otherwise(0.0)).alias("base_score"),
            F.sum(F.coalesce("lm", F.lit(0.0)) + F.when(F.col("lp").isNotNull(), k * F.col("lp")).otherwise(0.0)).alias("score"),
        )
        .select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
    )
