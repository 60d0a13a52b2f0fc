"""Audit and evidence queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import DAY_MS, page_of_url
from tidemark.operators.sentiment import labelled


def interval_ranges(bars: DataFrame) -> DataFrame:
    return bars.groupBy("interval").agg(F.count("*").alias("rows"), F.countDistinct("ticker").alias("tickers"), F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"))


def top_tickers(rows: DataFrame, most: int = 10) -> DataFrame:
    return rows.groupBy("ticker").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "ticker").limit(most)


def without_prices(companies: DataFrame, bars: DataFrame) -> DataFrame:
    return companies.filter("is_active").join(bars.select("ticker").distinct(), "ticker", "left_anti").select("ticker", "company_name")


def null_prices(bars: DataFrame) -> DataFrame:
    gap = F.lit(False)
    for c in ("open", "high", "low", "close", "volume"):
        gap = gap | F.col(c).isNull()
    return bars.agg(F.count("*").alias("rows"), F.count_if(gap).alias("with_null"), F.count_if(F.col("high") < F.col("low")).alias("high_below_low"))


def news_by_source(news: DataFrame) -> DataFrame:
    return news.groupBy("source").agg(F.count("*").alias("rows"), F.min("published_ms").alias("first_ms"), F.max("published_ms").alias("last_ms"))


def news_quality(news: DataFrame) -> DataFrame:
    vendor = F.col("source") == "eodhd"
    return news.agg(
        F.countDistinct("ticker").alias("tickers"), F.count_if(vendor & (F.col("title") == "")).alias("vendor_untitled"),
        F.count_if(vendor & F.col("vendor_sentiment").isNotNull()).alias("vendor_with_sentiment"), F.count_if(~vendor & F.col("tone_score").isNotNull()).alias("open_with_tone"),
    )


def fused_by_interval(events: DataFrame) -> DataFrame:
    return events.groupBy("interval").agg(F.count("*").alias("events"), F.round(F.avg("news_count"), 4).alias("mean_news"), F.max("news_count").alias("most_news"))


def _bucket(value: Column, edges: list[float], other: str) -> Column:
    out = F.lit(other)
    for lo, hi in reversed(list(zip(edges, edges[1:], strict=False))):
        out = F.when((value >= lo) & (value < hi), F.lit(f"[{lo:g},{hi:g})")).otherwise(out)
    return out


def attachment_tiers(events: DataFrame) -> DataFrame:
    return events.groupBy(_bucket(F.col("news_count"), [0, 1, 3, 10, 999], "other").alias("tier")).agg(F.count("*").alias("events"))


def confidence_tiers(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model", _bucket(F.col("confidence"), [0, 0.5, 0.75, 0.9, 1], "other").alias("tier")).agg(F.count("*").alias("scores"))


def _has(source: str) -> Column:
    return F.exists("news_context", lambda x: x["source"] == source)


def attached_sources(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if(_has("gdelt")).alias("with_open"), F.count_if(_has("eodhd")).alias("with_vendor"), F.count_if(_has("gdelt") & _has("eodhd")).alias("with_both"))


def open_attached_by_ticker(events: DataFrame) -> DataFrame:
    return events.filter(_has("gdelt")).groupBy("ticker").agg(F.count("*").alias("events"))


def scores_by_model(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(F.count("*").alias("scores"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def label_histogram(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model", "label").agg(F.count("*").alias("scores"))


def agreement(compared: DataFrame) -> DataFrame:
    """Comparisons with the vendor per model and over both, with the share that agrees."""
    return (
        compared.filter("vendor IS NOT NULL").rollup("model").agg(F.count("*").alias("compared"), F.count_if("vendor_agrees").alias("agreed"))
        .select(F.coalesce("model", F.lit("all")).alias("model"), "compared", "agreed", F.round(100.0 * F.col("agreed") / F.col("compared"), 2).alias("agreed_pct"))
    )


def score_range(scores: DataFrame) -> DataFrame:
    return scores.agg(F.unix_millis(F.min("scored_at")).alias("first_ms"), F.unix_millis(F.max("scored_at")).alias("last_ms"), F.count("*").alias("scores"))


def duplicate_surfaces(bars: DataFrame, news: DataFrame, events: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows and surplus rows per key of each table."""

    def one(name: str, df: DataFrame, *key: str) -> DataFrame:
        per = df.groupBy(*key).agg(F.count("*").alias("n"))
        return per.agg(F.lit(name).alias("surface"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))

    return one("prices", bars, "ticker", "timestamp_ms", "interval").unionAll(one("news", news, "dedup_key")).unionAll(one("fused", events, "ticker", "timestamp_ms", "interval")).unionAll(one("scores", scores, "dedup_key"))


def null_volume_share(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("interval") == "5m").agg(F.count("*").alias("bars"), F.count_if(F.col("volume").isNull()).alias("without_volume"), F.round(100.0 * F.count_if(F.col("volume").isNull()) / F.count("*"), 4).alias("pct"))


def key_overlap(news: DataFrame, of: Column) -> DataFrame:
    """Values of ``of`` that articles of both sources have, out of all."""
    per = news.groupBy(of.alias("u")).agg(F.countDistinct("source").alias("n"))
    return per.agg(F.count("*").alias("values"), F.count_if(F.col("n") > 1).alias("shared"), F.round(100.0 * F.count_if(F.col("n") > 1) / F.count("*"), 4).alias("pct"))


def url_overlap(news: DataFrame) -> DataFrame:
    """Pages that articles of both sources link to, out of all that are linked to."""
    return key_overlap(news.withColumn("_page", page_of_url(F.col("url"))).filter("_page IS NOT NULL"), F.col("_page"))


def daily_agreement(news: DataFrame) -> DataFrame:
    """Agreement of both sources' most frequent label per ticker and day; ties go to positive, then neutral."""
    rows = labelled(news).select("ticker", F.floor(F.col("published_ms") / DAY_MS).cast("long").alias("day"), F.when(F.col("source") == "eodhd", "vendor").otherwise("open").alias("side"), F.coalesce("vendor", "open").alias("label")).filter("label IS NOT NULL")
    n = {x: F.count_if(F.col("label") == x) for x in ("positive", "neutral", "negative")}
    modal = F.when((n["positive"] >= n["neutral"]) & (n["positive"] >= n["negative"]), "positive").when(n["neutral"] >= n["negative"], "neutral").otherwise("negative")
    per = rows.groupBy("ticker", "day", "side").agg(modal.alias("label"))
    wide = per.groupBy("ticker", "day").agg(F.max(F.when(F.col("side") == "vendor", F.col("label"))).alias("v"), F.max(F.when(F.col("side") == "open", F.col("label"))).alias("o"))
    return wide.filter("v IS NOT NULL AND o IS NOT NULL").groupBy("ticker").agg(F.count("*").alias("days"), F.count_if(F.col("v") == F.col("o")).alias("agreed"))


def open_concentration(events: DataFrame, companies: DataFrame, most: int = 5) -> DataFrame:
    """Tickers with attached open-data articles, active ones without, and the share of the largest ``most``."""
    per = open_attached_by_ticker(events)
    ranked = per.withColumn("r", F.row_number().over(Window.orderBy(F.desc("events"), "ticker")))  # one row per ticker
    head = ranked.agg(F.count("*").alias("tickers_with"), F.round(100.0 * F.sum(F.when(F.col("r") <= most, F.col("events")).otherwise(0)) / F.sum("events"), 4).alias("top_pct"))
    none = companies.filter("is_active").join(per, "ticker", "left_anti").agg(F.count("*").alias("active_without"))
    return head.crossJoin(none)
