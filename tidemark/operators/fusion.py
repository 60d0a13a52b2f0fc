"""Temporal fusion: every bar with the news nearest to it in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import FUSION_WINDOWS, MOST_NEWS_PER_BAR
from tidemark.functions.expressions import reference_ms, window_minutes
from tidemark.operators import versions

BAR_KEY = ["ticker", "interval", "timestamp_ms"]
MINUTE = 60_000


def with_windows(bars: DataFrame) -> DataFrame:
    """Bars with their reference time and window."""
    return bars.withColumns({
        "ref_ms": reference_ms(F.col("interval"), F.col("timestamp_ms")),
        "lookback_min": window_minutes(F.col("interval"), 0),
        "lookahead_min": window_minutes(F.col("interval"), 1),
    })


def interval_pairs(bars: DataFrame, news: DataFrame, intervals: list[str] | None = None) -> DataFrame:
    """Bar keys with every article of the ticker published in the closed window, and the signed offset in minutes.

    A range join as an equi-join: time is cut into buckets as wide as a window, so a bar's window touches the bucket of
    its start and the next one. The article is written to the two buckets whose bars can reach it, once for each
    window width in use; bars are never multiplied. ``intervals``: those present in the bars; all known ones if not given.
    """
    widths = sorted({sum(FUSION_WINDOWS[i]) for i in intervals or FUSION_WINDOWS})
    b = _spans(with_windows(bars).select(*BAR_KEY, "ref_ms", "lookback_min", "lookahead_min"))
    n = _articles(news)
    n = n.select("*", _spots("published_ms", widths).alias("at")).select("ticker", "published_ms", "dedup_key", "is_foreign", "at.width", "at.bucket")
    return _offsets(b.join(n, ["ticker", "width", "bucket"]).filter(F.col("published_ms").between(F.col("from_ms"), F.col("to_ms"))))


def _articles(news: DataFrame) -> DataFrame:
    foreign = F.col("is_foreign") if "is_foreign" in news.columns else F.lit(False)
    return news.filter("published_ms IS NOT NULL").select("ticker", "published_ms", "dedup_key", foreign.alias("is_foreign"))


def _spans(bars: DataFrame, more: int = 0) -> DataFrame:
    """Bars with the ends of their window and the bucket that it starts in; buckets are ``more`` minutes wider than the window."""
    start, width = F.col("ref_ms") - F.col("lookback_min") * MINUTE, F.col("lookback_min") + F.col("lookahead_min") + more
    return bars.withColumns({"from_ms": start, "to_ms": F.col("ref_ms") + F.col("lookahead_min") * MINUTE, "width": width, "bucket": F.floor(start / (width * MINUTE)).cast("long")})


def _spots(time_ms: str, widths: list[int]) -> Column:
    """The buckets of each width whose bars can reach a time: its own and the one before."""
    own = lambda w: F.floor(F.col(time_ms) / (w * MINUTE)).cast("long")
    return F.explode(F.array(*[F.struct(F.lit(w).alias("width"), (own(w) - s).alias("bucket")) for w in widths for s in (0, 1)]))


def _offsets(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        *BAR_KEY, "dedup_key", "is_foreign", "published_ms",
        (F.col("published_ms") - F.col("ref_ms")).alias("offset_ms"),
        F.round((F.col("published_ms") - F.col("ref_ms")) / MINUTE, 2).alias("offset_min"),
    )


def near_pairs(bars: DataFrame, news: DataFrame, intervals: list[str] | None = None, most: int = MOST_NEWS_PER_BAR) -> DataFrame:
    """Those of ``interval_pairs`` that can be among the ``most`` nearest of their bar, in work that grows with bars and news and not with their pairs.

    Bars first meet the number of articles in each minute. The nearest whole minutes that hold ``most`` articles together bound how
    far the nearest ones can be: a bar then meets the articles of the minutes within that distance, and all of its window if it has fewer.
    """
    widths = sorted({sum(FUSION_WINDOWS[i]) + 1 for i in intervals or FUSION_WINDOWS})
    n = _articles(news).withColumn("minute", F.floor(F.col("published_ms") / MINUTE).cast("long"))
    counts = n.groupBy("ticker", "minute").agg(F.count("*").alias("n")).withColumn("end_ms", F.col("minute") * MINUTE + (MINUTE - 1))
    counts = counts.select("*", _spots("end_ms", widths).alias("at")).select("ticker", "minute", "end_ms", "n", "at.width", "at.bucket")
    # repeated bars are one here, so that their articles count once, and as many again at the end
    each = with_windows(bars.groupBy(*BAR_KEY).agg(F.count("*").cast("int").alias("copies")))
    b = _spans(each.select(*BAR_KEY, "ref_ms", "lookback_min", "lookahead_min", "copies"), more=1)
    first, last = F.col("minute") * MINUTE, F.col("end_ms")
    met = b.join(counts, ["ticker", "width", "bucket"]).filter((last >= F.col("from_ms")) & (first <= F.col("to_ms")))
    whole = (first >= F.col("from_ms")) & (last <= F.col("to_ms"))
    met = met.select(
        *BAR_KEY, "ref_ms", "from_ms", "to_ms", "copies", "minute", F.when(whole, F.col("n")).otherwise(0).alias("n"),
        F.greatest(F.lit(0), first - F.col("ref_ms"), F.col("ref_ms") - last).alias("near"), F.greatest(last - F.col("ref_ms"), F.col("ref_ms") - first).alias("far"),
    )
    bar = Window.partitionBy(*BAR_KEY)
    met = met.withColumn("held", F.sum("n").over(bar.orderBy("far", "minute").rowsBetween(Window.unboundedPreceding, 0)))
    met = met.withColumn("cut", F.min(F.when(F.col("held") >= most, F.col("far"))).over(bar)).filter("cut IS NULL OR near <= cut")
    inside = F.col("published_ms").between(F.col("from_ms"), F.col("to_ms")) & (F.col("cut").isNull() | (F.abs(F.col("published_ms") - F.col("ref_ms")) <= F.col("cut")))
    pairs = met.drop("n", "near", "far", "held").join(n, ["ticker", "minute"]).filter(inside)
    return _offsets(pairs.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")))


def nearest(pairs: DataFrame, most: int = MOST_NEWS_PER_BAR) -> DataFrame:
    """The articles nearest to each bar, ranked; ties go to the bar's own articles, then the earlier one, then by key."""
    order = Window.partitionBy(*BAR_KEY).orderBy(F.abs("offset_ms"), "is_foreign", "published_ms", "dedup_key")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def relevant(news: DataFrame, mapping: DataFrame) -> DataFrame:
    """Articles that are mapped to their own row's ticker, with relevance and match type."""
    return news.join(mapping.select("dedup_key", "ticker", "relevance", "match_type"), ["dedup_key", "ticker"])


def news_pool(news: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each ticker's own articles and those mapped to it from other tickers; an article once per ticker, its own row first."""
    own = news.withColumn("is_foreign", F.lit(False))
    other = mapping.select("dedup_key", F.col("ticker").alias("mapped")).join(news, "dedup_key").filter("mapped <> ticker")
    foreign = other.withColumn("ticker", F.col("mapped")).withColumn("is_foreign", F.lit(True)).select(*own.columns)
    first = Window.partitionBy("ticker", "dedup_key").orderBy("is_foreign", "published_ms")
    return own.unionByName(foreign).withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def fuse(bars: DataFrame, news: DataFrame, most: int = MOST_NEWS_PER_BAR, intervals: list[str] | None = None) -> DataFrame:
    """One nested event per bar: price, window, and its nearest articles in order; bars without news have none."""
    top = nearest(near_pairs(bars, news, intervals, most), most)
    own = [c for c in ("title", "source", "url", "vendor_sentiment", "relevance", "match_type") if c in news.columns]
    detail = news.select("ticker", "dedup_key", *own)
    items = top.join(detail, ["ticker", "dedup_key"]).groupBy(*BAR_KEY).agg(
        F.array_sort(F.collect_list(F.struct("rank", "dedup_key", "published_ms", "offset_min", *own))).alias("news_context")  # at most ``most``
    )
    empty = F.array().cast(items.schema["news_context"].dataType)
    price = F.struct("open", "high", "low", "close", "volume").alias("price")
    return (
        with_windows(bars).join(items, BAR_KEY, "left")
        .select(
            *BAR_KEY, F.timestamp_millis("timestamp_ms").alias("datetime_utc"), price,
            F.struct("lookback_min", "lookahead_min").alias("fusion_window"),
            F.when(F.col("news_context").isNull(), 0).otherwise(F.size("news_context")).alias("news_count"),
            F.coalesce("news_context", empty).alias("news_context"),
            F.concat_ws("|", "ticker", "timestamp_ms", "interval").alias("dedup_key"),
        )
    )


def flat(fused: DataFrame) -> DataFrame:
    """One row per bar and attached article; bars without news have one row with nulls."""
    return fused.select("ticker", "interval", "timestamp_ms", "news_count", F.explode_outer("news_context").alias("x")).select(
        "ticker", "interval", "timestamp_ms", "news_count", F.col("x.rank").alias("rank"), F.col("x.dedup_key").alias("article"), F.col("x.offset_min").alias("offset_min")
    )


def fuse_incremental(bars: DataFrame, news: DataFrame, fused_before: DataFrame, refresh_from_ms: int | None = None, intervals: list[str] | None = None) -> DataFrame:
    """Events of bars not fused before; with ``refresh_from_ms`` also of all bars from that time on.

    Bars are cut down before the join, so the work grows with the new bars. The caller writes the result: appended, or
    in place of the refreshed partitions in a new version of the table.
    """
    done = fused_before.select(*BAR_KEY)
    if refresh_from_ms is not None:
        done = done.filter(F.col("timestamp_ms") < refresh_from_ms)
    return fuse(bars.join(done, BAR_KEY, "left_anti"), news, intervals=intervals)


def refresh_fused(bars: DataFrame, news: DataFrame, root: str, from_ms: int, intervals: list[str] | None = None) -> int:
    """Fuse the bars of whole days from ``from_ms`` on (midnight UTC) again, and those not fused before, as a new version of a table by day.

    Days before that keep their frozen events and gain those of bars that came since; a day without either keeps its files.
    """
    spark, event = bars.sparkSession, fuse(bars, news, intervals=intervals)
    before = versions.read(spark, root, StructType(list(event.schema.fields)).add("day", "string"))
    fresh = with_day(fuse_incremental(bars, news, before, refresh_from_ms=from_ms, intervals=intervals))
    frozen = before.filter(F.col("timestamp_ms") < from_ms)
    # days that gain events: read from the bars, so that neither side is fused for it
    gaining = with_day(bars.filter(F.col("timestamp_ms") < from_ms).join(frozen.select(*BAR_KEY), BAR_KEY, "left_anti")).select("day").distinct()
    kept = frozen.join(gaining, "day", "left_semi").select(*fresh.columns)
    ended = before.filter(F.col("timestamp_ms") >= from_ms).select("day").distinct()
    return versions.refresh(fresh.unionByName(kept), root, "day", ended)


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.date_format(F.timestamp_millis("timestamp_ms"), "yyyy-MM-dd"))


def fusion_stats(fused: DataFrame) -> DataFrame:
    return fused.agg(
        F.countDistinct("ticker").alias("tickers"), F.count("*").alias("events"), F.count_if(F.col("news_count") > 0).alias("events_with_news"),
        F.sum("news_count").alias("attached"), F.max("news_count").alias("most"),
    )
