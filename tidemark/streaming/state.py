"""Insert-if-absent on a stream by keyed state with a time to live, in place of an anti-join with all that is stored.

Keys are kept in buckets (a ticker, interval and day of bars; a ticker and hour of articles), so a micro-batch reads and writes a
state once a bucket and not once a row. A bucket whose keys haven't been added to for the time to live is forgotten: the state holds the
buckets of that time and no more, and a key that is delivered again later than that passes again. The sink may then be Spark's
file sink, which writes each micro-batch once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS, HOUR_MS = 86_400_000, 3_600_000


class FirstOfKey(StatefulProcessor):
    """Passes the first row of each key. Of several in one micro-batch it is the one of the least ``order`` value."""

    def __init__(self, key: str, order: str, columns: list[str], live_ms: int) -> None:
        self.key, self.order, self.columns, self.live_ms = key, order, columns, live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "keys array<string>", self.live_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = list(self.seen.get()[0]) if self.seen.exists() else []
        batch = pd.concat(list(rows))  # a bucket's rows of one micro-batch
        fresh = batch[~batch[self.key].isin(known)].sort_values([self.key, self.order]).drop_duplicates(self.key)
        if len(fresh):
            self.seen.update((known + fresh[self.key].tolist(),))
        yield fresh[self.columns]

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """The state store that keyed state needs; a setting of the user's stays."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def first_rows(stream: DataFrame, key: list[str], bucket: list[Column], live_ms: int) -> DataFrame:
    """Rows whose key hasn't been seen within the time to live. ``bucket``: what the key's rows have in common, such as a ticker and a day."""
    use_state_store(stream.sparkSession)
    columns = stream.columns
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    wide = stream.select("*", text.alias("row_key"), F.xxhash64(*columns).alias("row_order"), *[b.cast("string").alias(f"row_bucket{i}") for i, b in enumerate(bucket)])
    return wide.groupBy(*[f"row_bucket{i}" for i in range(len(bucket))]).transformWithStateInPandas(
        FirstOfKey("row_key", "row_order", columns, live_ms), outputStructType=stream.schema, outputMode="Append", timeMode="ProcessingTime"
    )


def new_bars(bars: DataFrame, live_ms: int = 14 * DAY_MS) -> DataFrame:
    """Bars of a stream that haven't come before; those without a whole key are dropped, as their table needs it."""
    own = bars.filter("ticker IS NOT NULL AND interval IS NOT NULL AND timestamp_ms IS NOT NULL")
    day = F.floor(F.col("timestamp_ms") / DAY_MS)
    return first_rows(own, ["timestamp_ms"], [F.col("ticker"), F.col("interval"), day], live_ms)


def new_articles(news: DataFrame, live_ms: int = 14 * DAY_MS) -> DataFrame:
    """Articles of a stream that haven't come before, by ``dedup_key``; buckets are a ticker's hours."""
    hour = F.floor(F.col("published_ms") / HOUR_MS)
    return first_rows(news.filter("dedup_key IS NOT NULL"), ["dedup_key"], [F.coalesce("ticker", F.lit("")), F.coalesce(hour, F.lit(-1))], live_ms)
