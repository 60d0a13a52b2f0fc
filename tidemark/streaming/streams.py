"""Streaming forms of ingestion, deduplication, fusion and enrichment. Every sink is idempotent, so a replayed batch adds nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.config import FUSION_WINDOWS
from tidemark.functions.expressions import reference_ms, window_minutes
from tidemark.operators import articles, fusion, sentiment, store
from tidemark.sources import readers
from tidemark.streaming.ledger import committed, stored_rows, write_tables

MINUTE = 60_000
#: Windows that a bucket of time is wide in a join of streams: an article is held 1 + 1 / SPAN times on average.
SPAN = 4


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, file_format: str = "parquet") -> DataFrame:
    """A directory of landed files as a stream."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).format(file_format).load(path)


def insert_stream(stream: DataFrame, target: str, checkpoint: str, new_rows: Callable[[DataFrame, DataFrame], DataFrame], once: bool = True) -> StreamingQuery:
    """Append to ``target`` what ``new_rows(batch, stored)`` finds new in each micro-batch."""

    def write(batch: DataFrame, _: int) -> None:
        new_rows(batch, stored_rows(batch.sparkSession, target, batch.schema)).write.mode("append").parquet(target)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def deduplicated(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def fuse_stream(bars: DataFrame, news: Callable[[], DataFrame], target: str, checkpoint: str, intervals: list[str] | None = None, once: bool = True) -> StreamingQuery:
    """Fuse each micro-batch of bars with the news stored by then; bars fused before stay as they are."""

    def write(batch: DataFrame, _: int) -> None:
        fused = fusion.fuse(batch, news(), intervals=intervals)
        done = stored_rows(batch.sparkSession, target, fused.schema)
        fusion.fuse_incremental(batch, news(), done, intervals=intervals).write.mode("append").parquet(target)

    w = bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def fuse_join(bars: DataFrame, news: DataFrame, late: str = "10 minutes", intervals: list[str] | None = None) -> DataFrame:
    """Flat pairs of two streams: a left outer join on the ticker and the bar's window, with watermarks on both sides.

    A bar without news comes out once, when the watermark has passed the end of its window; later news is dropped. State is held for the
    widest window of ``intervals`` (of all known ones if not given), so streams of short bars hold little.

    Time is cut into buckets of ``SPAN`` windows, which are part of the key: a row meets what is held of its ticker in a bucket, not all of it. A bar
    goes to the bucket that its window starts in, an article to those whose bars can reach it: its own, and the one before if it lies less than a window behind the edge.
    """
    known = {i: FUSION_WINDOWS[i] for i in intervals or FUSION_WINDOWS}
    back, ahead = (max(w[side] for w in known.values()) for side in (0, 1))
    ref = reference_ms(F.col("interval"), F.col("timestamp_ms"))
    start = ref - F.least(window_minutes(F.col("interval"), 0), F.lit(back)) * MINUTE
    end = ref + F.least(window_minutes(F.col("interval"), 1), F.lit(ahead)) * MINUTE
    width = F.lit(back + ahead)  # of bars of other intervals, whose windows are cut to the widest
    for i, both in known.items():
        width = F.when(F.col("interval") == i, F.lit(sum(both))).otherwise(width)
    bucket = lambda ms, width: F.floor(ms / (width.cast("long") * SPAN * MINUTE)).cast("long")
    b = bars.select(
        F.col("ticker").alias("b_ticker"), "interval", "timestamp_ms", F.timestamp_millis(ref).alias("bar_time"), F.timestamp_millis(start).alias("from_time"), F.timestamp_millis(end).alias("to_time"),
        width.alias("b_width"), bucket(start, width).alias("b_bucket"),
    ).withWatermark("bar_time", late)
    at, widths = F.col("published_ms"), sorted({back + ahead, *map(sum, known.values())})

    def reached(w: int) -> Column:
        return F.transform(F.sequence(bucket(at - w * MINUTE, F.lit(w)), bucket(at, F.lit(w))), lambda x: F.struct(F.lit(w).alias("width"), x.alias("bucket")))

    n = news.select(F.col("ticker").alias("n_ticker"), "dedup_key", F.timestamp_millis(at).alias("news_time"), F.explode(F.flatten(F.array(*map(reached, widths)))).alias("spot"))
    n = n.select("n_ticker", "dedup_key", "news_time", F.col("spot.width").alias("n_width"), F.col("spot.bucket").alias("n_bucket")).withWatermark("news_time", late)
    near = F.expr(
        f"b_ticker = n_ticker AND b_width = n_width AND b_bucket = n_bucket AND news_time >= bar_time - INTERVAL {back} MINUTES AND news_time <= bar_time + INTERVAL {ahead} MINUTES"
        " AND news_time >= from_time AND news_time <= to_time"
    )
    return b.join(n, near, "leftOuter").select(F.col("b_ticker").alias("ticker"), "interval", "timestamp_ms", "dedup_key", ((F.unix_millis("news_time") - F.unix_millis("bar_time")) / 60_000).alias("offset_min"))


def enrich_stream(events: DataFrame, news: Callable[[], DataFrame], scores: str, enriched: str, ledger: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Score the articles of each micro-batch of fused events that have no score yet, then write the events with all scores of their articles.

    Both tables get each micro-batch exactly once (``ledger.write_tables``); read them with ``ledger.committed``.
    """
    kept = sentiment.score_articles(news()).schema

    def of(batch: DataFrame) -> DataFrame:
        return batch.select(F.explode("news_context.dedup_key").alias("dedup_key")).distinct()

    def stored(batch: DataFrame) -> DataFrame:
        all_ = committed(batch.sparkSession, "scores", scores, ledger, kept)
        return all_.join(of(batch).withColumnRenamed("dedup_key", "source_dedup_key"), "source_dedup_key", "left_semi")

    def new_scores(batch: DataFrame) -> DataFrame:
        own = store.first_of_key(news().join(of(batch), "dedup_key", "left_semi"), ["dedup_key"])
        return sentiment.score_articles(sentiment.unscored(own, stored(batch)))

    return write_tables(events, [("scores", scores, new_scores), ("enriched", enriched, lambda batch: sentiment.enrich_fused(batch, stored(batch)))], ledger, checkpoint, once)


def bar_stream(spark: SparkSession, path: str, interval: str = "5m", files_per_batch: int | None = None) -> DataFrame:
    """Landed polls of bars, daily ones by date and others by epoch seconds, through the same projection as the batch readers."""
    read = readers.eod_bars if interval == "1d" else readers.intraday_bars
    more = {} if interval == "1d" else {"interval": interval}
    return read(spark, path, multi_line=False, stream_files=files_per_batch or 0, **more)


def record_stream(spark: SparkSession, path: str, names: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """Landed open-data records as articles; a row of the stream is taken alone, as a stream has no joins with itself."""
    lines = table_stream(spark, path, StructType().add("line", "string"), files_per_batch, "text")
    return articles.articles_by_row(articles.split_records(lines), names)


def sink(stream: DataFrame, target: str, checkpoint: str, once: bool = True, idle: bool = True) -> StreamingQuery:
    """Append to a table with Spark's file sink, each micro-batch once.

    ``idle``: whether batches without data may run. Joins need them to let go of what the watermark has passed; keyed state
    with a time to live asks for one after the other, so that a run over what has landed would never end.
    """
    w = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    conf.set(key, before if idle else "false")
    try:
        return (w.trigger(availableNow=True) if once else w).start()  # the query keeps the setting that it starts with
    finally:
        conf.set(key, before)


def score_stream(news: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Score articles that have no score yet and append the scores."""

    def new_rows(batch: DataFrame, _: int) -> None:
        fresh = sentiment.score_articles(batch)
        done = stored_rows(batch.sparkSession, target, fresh.schema)
        store.new_documents(sentiment.score_articles(sentiment.unscored(batch, done)), done).write.mode("append").parquet(target)

    w = news.writeStream.foreachBatch(new_rows).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def tone_windows(news: DataFrame, time: str = "published", width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Articles and mean tone per ticker and window of time."""
    return (
        news.withWatermark(time, late).groupBy("ticker", F.window(time, width).alias("w"))
        .agg(F.count("*").alias("articles"), F.count("tone_score").alias("with_tone"), F.round(F.avg("tone_score"), 6).alias("mean_tone"))
        .select("ticker", F.unix_millis("w.start").alias("window_ms"), "articles", "with_tone", "mean_tone")
    )


def sessions(news: DataFrame, time: str = "published", gap: str = "2 hours", late: str = "1 hour") -> DataFrame:
    """Runs of a ticker's articles with at most ``gap`` between neighbours; a run comes out when the watermark has passed its end by the gap, rows later than that are dropped."""
    return (
        news.withWatermark(time, late).groupBy("ticker", F.session_window(time, gap).alias("w")).agg(F.count("*").alias("articles"), F.max(time).alias("last"))
        .select("ticker", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("last").alias("last_ms"), "articles")
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows of the query's recent micro-batches that came behind the watermark and were dropped by its stateful operators (those merged before an operator count once)."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
