"""As-of match: the latest article at or before each bar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.fusion import BAR_KEY, with_windows

DAY_MS = 86_400_000


def latest_before(bars: DataFrame, news: DataFrame, bucket_ms: int = DAY_MS, within_ms: int | None = None) -> DataFrame:
    """Bar keys with dedup_key, published_ms and age_ms of the ticker's latest article at or before the bar's reference time; null where there is none.

    Bars and articles go in order of time together and the last article is carried forward. A ticker is cut into buckets of time that are
    sorted apart; what a bucket starts with is handed over from the last article of the buckets before, of which there is one row each, so neither a popular
    ticker nor a long history meets in one task. Of articles of one moment the greatest key is taken. ``within_ms``: older articles don't count.
    """
    article = F.struct("published_ms", "dedup_key")
    b = with_windows(bars).select(*BAR_KEY, F.col("ref_ms").alias("at"), F.lit(1).alias("kind"))
    n = news.filter("published_ms IS NOT NULL AND ticker IS NOT NULL").select("ticker", F.col("published_ms").alias("at"), F.lit(0).alias("kind"), article.alias("article"))
    rows = b.unionByName(n, allowMissingColumns=True).withColumn("bucket", F.floor(F.col("at") / bucket_ms).cast("long"))
    own = Window.partitionBy("ticker", "bucket").orderBy("at", "kind", "article").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.withColumn("article", F.last("article", True).over(own)).filter("kind = 1")
    earlier = Window.partitionBy("ticker").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("ticker", "bucket").agg(F.max("article").alias("last"))
    handed = ends.select("ticker", "bucket", F.last("last", True).over(earlier).alias("handed")).filter("handed IS NOT NULL")
    out = carried.join(handed, ["ticker", "bucket"], "left").withColumn("article", F.coalesce("article", "handed"))
    age = F.col("at") - F.col("article.published_ms")
    keep = lambda c: F.when(age <= within_ms, c) if within_ms is not None else c
    return out.select(*BAR_KEY, keep(F.col("article.dedup_key")).alias("dedup_key"), keep(F.col("article.published_ms")).alias("published_ms"), keep(age).alias("age_ms"))
