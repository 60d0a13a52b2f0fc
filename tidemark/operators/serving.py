"""Read queries over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import MODELS


def _limit(n: int, most: int) -> int:
    if not 1 <= n <= most:
        raise ValueError(f"limit must lie between 1 and {most}")
    return n


def prices(bars: DataFrame, ticker: str, interval: str = "1d", start_ms: int | None = None, end_ms: int | None = None, limit: int = 100) -> DataFrame:
    """Newest bars of a ticker first; both bounds are inclusive."""
    out = bars.filter((F.col("ticker") == ticker.upper()) & (F.col("interval") == interval))
    if start_ms is not None:
        out = out.filter(F.col("timestamp_ms") >= start_ms)
    if end_ms is not None:
        out = out.filter(F.col("timestamp_ms") <= end_ms)
    return out.orderBy(F.desc("timestamp_ms")).limit(_limit(limit, 5000))


def news(articles: DataFrame, ticker: str, limit: int = 20) -> DataFrame:
    out = articles.filter(F.col("ticker") == ticker.upper()).orderBy(F.desc_nulls_last("published_ms"), "dedup_key").limit(_limit(limit, 500))
    return out.drop("dedup_key")


def fused(events: DataFrame, ticker: str, limit: int = 20) -> DataFrame:
    return events.filter(F.col("ticker") == ticker.upper()).orderBy(F.desc("timestamp_ms"), "interval").limit(_limit(limit, 500))


def sentiment(scores: DataFrame, ticker: str, model: str | None = None, limit: int = 50) -> DataFrame:
    """Scores of a ticker, newest first; short and full model names both work."""
    out = scores.filter(F.col("ticker") == ticker.upper())
    if model:
        short = next((k for k, v in MODELS.items() if model.lower() in (k, v.lower())), model)
        out = out.filter(F.col("model") == short)
    return out.orderBy(F.desc_nulls_last("scored_at"), "dedup_key").limit(_limit(limit, 500))


def stats(bars: DataFrame, companies: DataFrame, articles: DataFrame, events: DataFrame, scores: DataFrame) -> DataFrame:
    """One row of table sizes."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = bars.agg(F.count("*").alias("price_rows"), F.countDistinct("ticker").alias("tickers_with_prices"))
    parts = [companies.agg(F.count("*").alias("companies"), F.count_if("is_active").alias("active")), n(articles, "news"), n(events, "fused"), n(scores, "scores")]
    for p in parts:
        one = one.crossJoin(p)  # of single rows
    return one
