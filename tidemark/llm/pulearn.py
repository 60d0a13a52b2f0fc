"""Operator 11: quality classifier by positive-unlabelled learning.

Learned from are trusted positives (rows labelled 1) and unlabelled texts (rows without a label); labels of 0 are never read. A
linear model f minimises the non-negative unbiased risk

    prior * mean_P loss(f) + max(0, mean_U loss(-f) - prior * mean_P loss(-f))

with the logistic loss; a minibatch in which the second part falls below zero takes a step back along it alone.

The class prior, the share of positives among unlabelled texts, is estimated first. Two classifiers of positives against
unlabelled texts are fitted, each on one half of the sample, and every teaching row of the corpus is scored by the one that hasn't seen its half.
The prior is the least ratio of unlabelled to positive rows above a score, taken where its upper confidence bound is
least; the histograms behind it are counted by Spark over all rows.

Features are shares of hashed byte and shape trigrams, in steps of 1/255 of their roots, and ``STATS`` of the whole text, each
cut into bins. The models are fitted on at most ``MOST_ROWS`` positives and as many unlabelled rows, those with the least hash of
their id (a row of the sample is 2 kB of features, whatever the text's length); the prior and the scores cover every row.

Defined cases: a null text counts as an empty one and is scored like any other; rows with a null id are scored but teach
nothing; null labels are none; of label rows of one id the greatest holds; without a positive row every score is 0.5;
without an unlabelled row the prior is 1; repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Bound of the sample: so many positives, and so many unlabelled rows.
MOST_ROWS = 8_000
HALF = 1024
BINS = 16
#: The penalty is L2 over the rows of the sample; scales say how much of the model the standardised columns may carry.
EPOCHS, BATCH, RATE, L2 = 60, 512, 0.05, 2.0
GRAM_SCALE, STAT_SCALE = 4.0, 30.0
#: Confidence of the prior's bound, and scores' bins.
DELTA, SLACK = 0.1, 0.01
SCORE_BINS = 1024

STATS = ["letters", "words", "word_length", "distinct_words", "distinct_share", "repeated", "upper", "lower", "symbols", "digits", "repeated_lines", "bare_words"]
_LETTERS = [*range(65, 91)], [*range(97, 123)], [*range(48, 58)]
_SHAPE = bytearray(range(256))
for _of, _to in zip(_LETTERS, b"Aa0", strict=True):
    for _c in _of:
        _SHAPE[_c] = _to
for _c in range(0xC0, 256):
    _SHAPE[_c] = ord("a")
_INNER = bytes(range(0x80, 0xC0))
_SHAPE = bytes(_SHAPE)
_SIGNS = bytes(c for c in range(128) if chr(c) not in "Aa0 \t\n\v\f\r")


def _grams(raw: bytes) -> np.ndarray:
    """Roots of the shares of hashed trigrams in steps of 1/255."""
    c = np.frombuffer(raw, np.uint8).astype(np.uint16)
    if len(c) < 3:
        return np.zeros(HALF, np.uint8)
    key = c[:-2] * np.uint16(0x9E37)
    key += c[1:-1] * np.uint16(0x79B1)
    key += c[2:] * np.uint16(0x85EB)
    n = np.bincount(key >> np.uint16(6), minlength=HALF)
    return np.round(255 * np.sqrt(n / n.sum())).astype(np.uint8)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams (bytes and shapes) and the stats of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    shape = raw.translate(_SHAPE, _INNER)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size, distinct = len(words), max(1, len(shape)), len(set(words))
    upper, lower, digits = shape.count(b"A"), shape.count(b"a"), shape.count(b"0")
    blank = sum(shape.count(x) for x in b" \t\n\r")
    bare = n - len(shape.translate(None, _SIGNS).split())
    stats = (
        np.log1p(upper + lower), np.log1p(n), (len(shape) - blank) / max(1, n), np.log1p(distinct) / np.log(n + 2), distinct / max(1, n),
        sum(map(operator.eq, words, words[1:])) / max(1, n), upper / size, lower / size, (len(shape) - blank - upper - lower - digits) / size, digits / size,
        1 - len(set(lines)) / max(1, len(lines)), bare / max(1, n),
    )
    return np.concatenate([_grams(raw), _grams(shape)]), np.array(stats, np.float32)


class Linear:
    """A linear model over hashed trigrams and binned stats, as arrays to send."""

    def __init__(self, weights: np.ndarray, bins: np.ndarray, edges: np.ndarray, bias: float) -> None:
        self.weights, self.bins, self.edges, self.bias = weights, bins, edges, bias

    def logit(self, grams: np.ndarray, stats: np.ndarray) -> float:
        at = (stats[:, None] > self.edges).sum(axis=1)
        return float(grams @ self.weights + self.bins[np.arange(len(STATS)), at].sum() + self.bias)


def _design(grams: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Standardised columns of a sample, with what turns weights of them into those of the raw features."""
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T.astype(np.float32)
    at = (stats[:, :, None] > edges[None]).sum(axis=2)
    x = np.empty((len(grams), grams.shape[1] + len(STATS) * BINS), np.float32)
    x[:, : grams.shape[1]] = grams
    x[:, grams.shape[1] :] = 0
    x[np.arange(len(x))[:, None], grams.shape[1] + np.arange(len(STATS)) * BINS + at] = 1
    mean, scale = x.mean(axis=0), x.std(axis=0)
    gram = np.arange(len(scale)) < grams.shape[1]
    scale = (np.maximum(scale, np.where(gram, 1.0, 0.1)) * x.shape[1] ** 0.5 / np.where(gram, GRAM_SCALE, STAT_SCALE)).astype(np.float32)
    x -= mean
    x /= scale
    return x, edges, mean, scale


def _raw(w: np.ndarray, b: float, edges: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Linear:
    w = w / scale
    k = len(w) - len(STATS) * BINS
    return Linear(w[:k].astype(np.float32), w[k:].reshape(len(STATS), BINS), edges, float(b - (w * mean).sum()))


class _Adam:
    def __init__(self, n: int) -> None:
        self.m, self.v, self.t = np.zeros(n), np.zeros(n), 0

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def non_negative_risk(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the risk of logits of positives and unlabelled rows: the positive one and, before its max with zero, the negative one."""
    loss = lambda z: float(np.logaddexp(0, -z).mean()) if len(z) else 0.0
    return prior * loss(p), loss(-u) - prior * loss(-p)


def _minimise(x: np.ndarray, positive: np.ndarray, prior: float | None) -> tuple[np.ndarray, float]:
    """Weights and bias: of the non-negative risk, or without a prior of positives against unlabelled rows."""
    rng = np.random.default_rng(7)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    adam = _Adam(x.shape[1] + 1)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    steps = EPOCHS * max(1, -(-max(len(p), len(u)) // BATCH))
    l2 = np.float32(L2 / len(x))
    late, late_b, averaged = np.zeros(x.shape[1]), 0.0, 0
    for k in range(steps):
        i = rng.choice(p, min(BATCH, len(p)), replace=False)
        j = rng.choice(u, min(BATCH, len(u)), replace=False) if len(u) else u
        xi, xj = x[i], x[j]
        zi, zj = xi @ w + b, xj @ w + b
        up, un, unlabelled = -_sigmoid(-zi) / len(i), _sigmoid(zi) / len(i), _sigmoid(zj) / max(1, len(j))
        if prior is None:
            gi, gj = up, unlabelled
        elif non_negative_risk(zi, zj, prior)[1] >= 0:
            gi, gj = prior * (up - un), unlabelled
        else:  # the second part is overfitted: climb along it
            gi, gj = prior * un, -unlabelled
        g = np.append(xi.T @ gi + xj.T @ gj + l2 * w, gi.sum() + gj.sum())
        d = adam.step(g)
        w, b = (w - d[:-1]).astype(np.float32), b - d[-1]
        if 2 * k >= steps:
            late, late_b, averaged = late + w, late_b + b, averaged + 1
    return late / max(1, averaged), late_b / max(1, averaged)


def fit(sample: DataFrame, prior: float | None) -> list[Linear]:
    """Models of a sample (order, half, positive, grams, stats): one of each half without a prior, else one of all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        if not len(rows) or not rows["positive"].any():
            return
        grams = np.stack([np.frombuffer(x, np.uint8) for x in rows["grams"]])
        stats = np.stack(rows["stats"].tolist()).astype(np.float32)
        positive, half = rows["positive"].to_numpy(bool), rows["half"].to_numpy()
        x, edges, mean, scale = _design(grams, stats)
        for own in [np.ones(len(x), bool)] if prior is not None else [half == 0, half == 1]:
            if positive[own].any():
                m = _raw(*_minimise(x[own], positive[own], prior), edges, mean, scale)
            else:
                m = _raw(np.zeros(x.shape[1]), 0.0, edges, mean, scale)
            yield pd.DataFrame({"part": ["weights", "bins", "edges", "bias"], "value": [np.asarray(v, np.float64).ravel().tobytes() for v in (m.weights, m.bins, m.edges, m.bias)]})

    got = sample.repartition(1).sortWithinPartitions("order", "positive").mapInPandas(run, "part string, value binary").toPandas()["value"].tolist()
    arrays = [np.frombuffer(v) for v in got]
    return [Linear(w.astype(np.float32), t.reshape(len(STATS), BINS), e.reshape(len(STATS), BINS - 1).astype(np.float32), float(b[0])) for w, t, e, b in zip(*[iter(arrays)] * 4, strict=True)]


def _batches(b: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return (features(t) for t in b["text"])


def best_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from both histograms of scores: the ratio of the shares above a score where its upper bound is least."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 1.0
    q_p, q_u = np.cumsum(positive[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    width = np.sqrt(np.log(4 / DELTA) / (2 * n_p)) + np.sqrt(np.log(4 / DELTA) / (2 * n_u))
    ok = q_p > 0
    bound = np.full(len(q_p), np.inf)
    bound[ok] = q_u[ok] / q_p[ok] + (1 + SLACK) / q_p[ok] * width
    k = int(bound.argmin())
    return float(np.clip(q_u[k] / q_p[k], 0.0, 1.0))


def class_prior(docs: DataFrame, known: DataFrame, models: list[Linear]) -> float:
    """Share of positives among unlabelled rows of docs (doc_id, text), from histograms over all of them; known: doc_id, label."""
    sent = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            # half h is scored by the model of the other half
            z = np.array([sent.value[1 - h].logit(*f) for h, f in zip(b["half"], _batches(b), strict=True)])
            yield pd.DataFrame({"doc_id": b["doc_id"], "half": b["half"], "bin": np.clip((z + 8) * (SCORE_BINS / 16), 0, SCORE_BINS - 1).astype(np.int32)})

    scored = docs.select("doc_id", "text", _half().alias("half")).mapInPandas(run, f"doc_id {kind}, half int, bin int")
    counts = (
        scored.join(known, "doc_id", "left").filter("label IS NULL OR label = 1")
        .groupBy("half", F.col("label").isNotNull().alias("positive"), "bin").agg(F.count("*").alias("n")).toPandas()
    )  # at most 4 * SCORE_BINS rows
    out, weight = 0.0, 0
    for h in (0, 1):
        own = counts[counts["half"] == h]
        hist = [np.bincount(x["bin"], x["n"], SCORE_BINS) for x in (own[own["positive"]], own[~own["positive"]])]
        n = min(hist[0].sum(), hist[1].sum())
        out, weight = out + best_ratio(*hist) * n, weight + n
    return out / weight if weight else 1.0


def _half() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int")


def sample_of(docs: DataFrame, known: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Features of at most ``most_rows`` positives and as many unlabelled rows: order, half, positive, grams, stats."""
    first = lambda df, positive: df.select("doc_id", F.lit(positive).alias("positive"), F.xxhash64("doc_id").alias("order")).orderBy("order").limit(most_rows)
    positives = first(known.filter("label = 1"), True)
    unlabelled = first(docs.select("doc_id").distinct().join(known, "doc_id", "left_anti"), False)
    chosen = F.broadcast(positives.unionAll(unlabelled))  # at most 2 * most_rows rows of numbers
    rows = docs.join(chosen, "doc_id").groupBy("doc_id", "order", "positive").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).withColumn("half", _half())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = list(_batches(b))
            yield pd.DataFrame({"order": b["order"], "half": b["half"], "positive": b["positive"], "grams": [g.tobytes() for g, _ in got], "stats": [s for _, s in got]})

    return stored(rows.select("order", "half", "positive", "text").mapInPandas(run, "order long, half int, positive boolean, grams binary, stats array<float>"), "pu-sample")


def pu_quality(docs: DataFrame, labels: DataFrame, teach: Column, label: str = "quality", most_rows: int = MOST_ROWS) -> DataFrame:
    """One row per document: doc_id, score (the probability of label 1) and prior; ``teach`` says of a doc_id whether it may be learned from."""
    docs = docs.select("doc_id", "text")
    own = docs.filter(F.col("doc_id").isNotNull() & teach)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & teach).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sample = sample_of(own, known, most_rows)
    models, prior, model = fit(sample, None), 1.0, None
    if models:
        prior = class_prior(own, known, models)
        model = fit(sample, prior)[0]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            score = _sigmoid(np.array([m.logit(*f) for f in _batches(b)])) if m else np.full(len(b), 0.5)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": score})

    return docs.mapInPandas(run, f"doc_id {kind}, score double").withColumn("prior", F.lit(prior))
