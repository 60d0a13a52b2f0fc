"""Operator 3: toxicity by FTRL-proximal logistic regression.

Features are hashed word n-grams (one and two words) and skip-grams (two words with one between). Each
coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero, so what is broadcast is a
short list of (feature, weight), bounded by the number of hash buckets.

Training reads at most ``MOST_ROWS`` labelled documents, those with the least hash of their id; scoring reads every
word of every document. Long texts are scored in one pass over their words.

Defined cases: a null or empty text has no feature and gets the model's prior; null labels and rows with a null id
teach nothing; without any training row the prior is 1 in 20; repeated rows are scored one by one; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20
#: Bound of the training sample.
MOST_ROWS = 12_000
EPOCHS = 8
#: Rates and penalties. L1 grows with the sample, as a weight's evidence does, between its two ends.
ALPHA, BETA, L2 = 2.0, 1.0, 0.1
L1_A_ROW, L1_LEAST, L1_MOST = 0.0025, 0.5, 8.0
STRIP = b".,;:!?\"'()[]|"
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def word_hashes(text: str | None) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w.strip(STRIP)) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()], np.uint64)


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * M1
    return (x >> np.uint64(44)).astype(np.int32)


def features(h: np.ndarray) -> list[np.ndarray]:
    """Buckets of single words, pairs and pairs with a gap; element i of each starts at word i."""
    return [_bucket(h), _bucket(h[:-1] * M2 + h[1:]), _bucket(h[:-2] * M3 + h[2:])]


class Ftrl:
    """FTRL-proximal with per-coordinate rates over binary features; the bias is not regularised by L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(BUCKETS), np.zeros(BUCKETS)
        self.bias_z = self.bias_n = 0.0
        self.prior, self.l1 = np.log(1 / 19), L1_LEAST

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        w = (np.sign(z) * self.l1 - z) / ((BETA + np.sqrt(self.n[i])) / ALPHA + L2)
        w[np.abs(z) <= self.l1] = 0
        return w

    def bias(self) -> float:
        return self.prior - self.bias_z / ((BETA + self.bias_n**0.5) / ALPHA + L2)

    def learn(self, i: np.ndarray, y: int) -> None:
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias(), -35, 35)))
        g = p - y
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g
        b = self.bias() - self.prior
        self.bias_z += g - ((self.bias_n + g * g) ** 0.5 - self.bias_n**0.5) / ALPHA * b
        self.bias_n += g * g


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero weights of a model of the rows (text, label, order): buckets, weights and bias."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen, positive = Ftrl(), [], 0
        for b in batches:
            for text, label in zip(b["text"], b["label"], strict=True):
                h = word_hashes(text)
                seen.append((np.unique(np.concatenate(features(h))), int(label)))
                positive += int(label)
        model.prior = np.log((positive + 1) / (len(seen) - positive + 19))
        model.l1 = min(L1_MOST, max(L1_LEAST, L1_A_ROW * len(seen)))
        for _ in range(EPOCHS):
            for i, y in seen:
                model.learn(i, y)
        i = np.flatnonzero(np.abs(model.z) > model.l1)
        yield pd.DataFrame({"bucket": np.append(i, -1).astype(np.int32), "weight": np.append(model.weights(i), model.bias())})

    got = rows.repartition(1).sortWithinPartitions("order").select("text", "label").mapInPandas(run, "bucket int, weight double").toPandas()
    bias = got.loc[got["bucket"] < 0, "weight"]
    got = got[got["bucket"] >= 0]
    return got["bucket"].to_numpy(), got["weight"].to_numpy(), float(bias.iloc[0]) if len(bias) else float(np.log(1 / 19))


def scores_of(texts: list[str | None], table: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(texts))
    for k, t in enumerate(texts):
        total = bias
        hit = np.concatenate([i[table[i] != 0] for i in features(word_hashes(t))])
        if len(hit):
            total += table[np.unique(hit)].sum()
        out[k] = total
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, teach: Column, most_rows: int = MOST_ROWS) -> DataFrame:
    """At most ``most_rows`` labelled rows (text, label, order); ``teach`` says of a doc_id whether it may be learned from."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & teach)
        .groupBy("doc_id").agg(F.max(label).alias("label")).withColumn("order", F.xxhash64("doc_id"))
        .orderBy("order").limit(most_rows)
    )
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most most_rows rows of numbers
    return own.groupBy("order").agg(F.first("label").alias("label"), F.min("text").alias("text"))


def toxicity(docs: DataFrame, labels: DataFrame, teach: Column, label: str = "toxic", most_rows: int = MOST_ROWS) -> DataFrame:
    """One row per document: doc_id and score, the probability of label 1."""
    buckets, weights, bias = fit(training_rows(docs, labels, label, teach, most_rows))
    model = docs.sparkSession.sparkContext.broadcast((buckets, weights.astype(np.float32), bias))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, w, b0 = model.value
        table = np.zeros(BUCKETS, np.float32)
        table[i] = w
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": scores_of(b["text"].tolist(), table, b0)})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double")
