"""Sentiment: scoring, labels of several sources, and how far they agree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import MODELS, PRIMARY_MODEL
from tidemark.functions.expressions import agrees, normal_label, strings, tone_label, vendor_label

#: Words of the built-in scorer; a user passes others or a model of their own.
POSITIVE = ["beat", "gain", "gains", "growth", "profit", "record", "rise", "rises", "strong", "surge", "up"]
NEGATIVE = ["decline", "down", "drop", "fall", "falls", "loss", "lawsuit", "miss", "slump", "weak"]
MOST_CHARS = 512


def unscored(news: DataFrame, scores: DataFrame, model: str = PRIMARY_MODEL) -> DataFrame:
    """Articles that the primary model has not scored."""
    done = scores.filter(F.col("model") == model).select(F.col("source_dedup_key").alias("dedup_key")).distinct()
    return news.join(done, "dedup_key", "left_anti")


def word_scores(text: Column, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> Column:
    """Built-in scorer: (label, confidence, positive words, negative words) of the first 512 letters."""
    w = F.split(F.lower(F.substring(text, 1, MOST_CHARS)), r"[^\p{L}]+")
    p, n = F.size(F.filter(w, lambda x: x.isin(positive))), F.size(F.filter(w, lambda x: x.isin(negative)))
    label = F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")
    confidence = F.round(0.5 + F.abs(p - n) / (2.0 * (p + n + 1)), 4)
    return F.struct(label.alias("label"), confidence.alias("confidence"), p.alias("n_positive"), n.alias("n_negative"))


def _time(scored_at: str | None) -> Column:
    return (F.lit(scored_at).cast("timestamp") if scored_at else F.current_timestamp()).alias("scored_at")


def score_articles(news: DataFrame, models: list[str] | None = None, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE, scored_at: str | None = None) -> DataFrame:
    """One score per model and titled article, by the built-in scorer, with the time of scoring (the current one if not given)."""
    s = news.filter("title <> ''").select("ticker", "dedup_key", "title", F.explode(strings(models or list(MODELS))).alias("model"))
    s = s.withColumn("s", word_scores(F.col("title"), positive, negative))
    return s.select(
        "ticker", F.col("dedup_key").alias("source_dedup_key"), F.substring("title", 1, MOST_CHARS).alias("text_scored"), "model",
        normal_label(F.col("s.label"), F.col("model").isin(list(MODELS))).alias("label"), F.col("s.confidence").alias("confidence"),
        F.concat_ws("|", "dedup_key", "model").alias("dedup_key"), _time(scored_at),
    )


def score_with(news: DataFrame, model: str, load: Callable[[], Callable[[list[str]], list[tuple[str, float] | None]]], batch: int = 16, scored_at: str | None = None) -> DataFrame:
    """Scores by a user's model: ``load`` runs once per Python worker, its result takes texts in batches; None is no score."""
    rows = news.filter("title <> ''").select("ticker", F.col("dedup_key").alias("source_dedup_key"), F.substring("title", 1, MOST_CHARS).alias("text_scored"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for b in batches:
            got: list = []
            texts = b["text_scored"].tolist()
            for i in range(0, len(texts), batch):
                got += scorer(texts[i : i + batch])
            b["raw_label"] = [None if g is None else g[0] for g in got]
            b["confidence"] = [None if g is None else round(float(g[1]), 4) for g in got]
            yield b

    scored = rows.mapInPandas(run, "ticker string, source_dedup_key string, text_scored string, raw_label string, confidence double")
    known = F.lit(model in MODELS or model in MODELS.values())
    return scored.filter("raw_label IS NOT NULL").select(
        "ticker", "source_dedup_key", "text_scored", F.lit(model).alias("model"), normal_label(F.col("raw_label"), known).alias("label"), "confidence",
        F.concat_ws("|", "source_dedup_key", F.lit(model)).alias("dedup_key"), _time(scored_at),
    )


def labelled(news: DataFrame) -> DataFrame:
    """Articles with the vendor's label and the label of their tone."""
    v = F.col("vendor_sentiment")
    return news.withColumns({"vendor": vendor_label(v["pos"], v["neg"], v["neu"], v.isNotNull()), "open": tone_label(F.col("tone_score"))})


def compared(scores: DataFrame, news: DataFrame) -> DataFrame:
    """Scores with the vendor's and the tone's label and whether each agrees; an absent label agrees with nothing."""
    n = labelled(news).select(F.col("dedup_key").alias("source_dedup_key"), "vendor", "open")
    s = scores.join(n, "source_dedup_key", "left")
    return s.withColumns({"vendor_agrees": agrees(F.col("label"), F.col("vendor")), "open_agrees": agrees(F.col("label"), F.col("open"))})


def by_model(scores: DataFrame) -> DataFrame:
    """One row per article with the two models' labels and confidences."""
    pick = lambda c, m: F.max(F.when(F.col("model") == m, F.col(c)))
    return scores.groupBy("source_dedup_key").agg(*[pick(c, m).alias(f"{m}_{c}") for m in MODELS for c in ("label", "confidence")])


def four_way(news: DataFrame, scores: DataFrame) -> DataFrame:
    """Labels of the four sources of each article, their votes and agreements; ties of the vote go to positive, then neutral."""
    n = labelled(news).join(by_model(scores).withColumnRenamed("source_dedup_key", "dedup_key"), "dedup_key", "left")
    all_ = F.filter(F.array("finbert_label", "roberta_label", "vendor", "open"), lambda x: x.isNotNull())
    p, u, g = (_votes(all_, v) for v in ("positive", "neutral", "negative"))
    modal = F.when(p + u + g == 0, None).when((p >= u) & (p >= g), "positive").when(u >= g, "neutral").otherwise("negative")
    return n.select(
        "dedup_key", F.col("finbert_label").alias("finbert"), F.col("roberta_label").alias("roberta"), "vendor", "open",
        ((F.size(all_) > 1) & (F.size(F.array_distinct(all_)) == 1)).alias("all_agree"), agrees(F.col("finbert_label"), F.col("roberta_label")).alias("transformers_agree"),
        agrees(F.col("vendor"), F.col("open")).alias("commercial_vs_open_agree"), modal.alias("modal_label"), p.alias("n_positive"), u.alias("n_neutral"), g.alias("n_negative"),
    )


def _votes(labels: Column, label: str) -> Column:
    return F.size(F.filter(labels, lambda x: x == label))


def batch_stats(compared_scores: DataFrame) -> DataFrame:
    """Per model: scores, each label's count, comparisons with the vendor, agreements and their share in per cent."""
    n, ok = F.count("vendor"), F.count_if(F.col("vendor_agrees"))
    return compared_scores.groupBy("model").agg(
        F.count("*").alias("scores"), *[F.count_if(F.col("label") == x).alias(x) for x in ("positive", "negative", "neutral")],
        n.alias("compared"), ok.alias("agreed"), F.round(100.0 * ok / n, 2).alias("agreed_pct"),
    )


def enrich(fused_flat: DataFrame, scores: DataFrame) -> DataFrame:
    """Flat context items with both models' labels and confidences; labels that are there already stay."""
    s = by_model(scores).withColumnRenamed("source_dedup_key", "article")
    out = fused_flat.join(s, "article", "left")
    for m in MODELS:
        if f"{m}_before" in fused_flat.columns:
            out = out.withColumn(f"{m}_label", F.coalesce(f"{m}_before", f"{m}_label")).drop(f"{m}_before")
    return out


def enrich_fused(fused: DataFrame, scores: DataFrame) -> DataFrame:
    """Nested events whose context items carry ``finbert`` and ``roberta`` structs; labels that are there already stay.

    Items are taken apart, joined and put together in order.
    """
    key = ["ticker", "interval", "timestamp_ms"]
    there = fused.schema["news_context"].dataType.elementType.names
    items = fused.select(*key, F.posexplode("news_context").alias("pos", "x"))
    s = by_model(scores).select(F.col("source_dedup_key"), *[F.when(F.col(f"{m}_label").isNotNull(), F.struct(F.col(f"{m}_label").alias("label"), F.col(f"{m}_confidence").alias("confidence"))).alias(m) for m in MODELS])
    joined = items.join(s, F.col("x.dedup_key") == F.col("source_dedup_key"), "left")
    own = [F.col(f"x.{c}") for c in there if c not in MODELS]
    labels = [(F.coalesce(f"x.{m}", m) if m in there else F.col(m)).alias(m) for m in MODELS]
    wide = joined.select(*key, "pos", F.struct(*own, *labels).alias("item"))
    back = wide.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda z: z["item"]).alias("enriched"))
    return fused.join(back, key, "left").withColumn("news_context", F.coalesce("enriched", F.array().cast(back.schema["enriched"].dataType))).drop("enriched")
