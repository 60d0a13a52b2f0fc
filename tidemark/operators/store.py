"""Table maintenance over parquet: insert-if-absent, versions, run log. One writer per table at a time."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas

PRICE_KEY = ["ticker", "timestamp_ms", "interval"]


def _dealt(batch: DataFrame, key: list[str]) -> DataFrame:
    """The batch with a column that is 0 where the key is whole and a number of its own elsewhere, so that rows without a key meet nobody."""
    return batch.withColumn("_row", F.when(_whole(key), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1))


def _whole(key: list[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).isNotNull()
    return out


def _known(existing: DataFrame, key: list[str]) -> DataFrame:
    """Stored keys with the same column; not a literal, which the optimizer would take out of the join and shuffle the batch again."""
    return existing.select(*key, F.when(_whole(key), F.lit(0).cast("long")).otherwise(F.lit(1).cast("long")).alias("_row"))


def _first(dealt: DataFrame, key: list[str], order: tuple[str, ...]) -> DataFrame:
    """One row per key and number, by the caller's order and then by a hash of the row."""
    sortable = [f.name for f in dealt.schema.fields if f.name not in (*key, "_row") and "map" not in f.dataType.simpleString()]
    w = Window.partitionBy(*key, "_row").orderBy(*order, F.xxhash64(*sortable) if sortable else F.lit(0))
    return dealt.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_of_key(batch: DataFrame, key: list[str], *order: str) -> DataFrame:
    """One row per key, the first by ``order`` and then by a hash of the row; rows whose key is null all pass."""
    return _first(_dealt(batch, key), key, order).drop("_row")


def absent(batch: DataFrame, existing: DataFrame, key: list[str], *order: str) -> DataFrame:
    """Rows of the batch whose key is neither stored nor earlier in the batch; stored rows never change. One plan, one shuffle of the batch."""
    return _first(_dealt(batch, key), key, order).join(_known(existing, key), [*key, "_row"], "left_anti").select(*batch.columns)


def new_prices(batch: DataFrame, existing: DataFrame, interval: str = "1d", source: str = "eodhd", *order: str) -> DataFrame:
    """Price rows to append: defaults filled in, prices to four places. Of different rows of a key the first by ``order`` is kept, then by a hash of the row."""
    return absent(_filled(batch, interval, source), existing, PRICE_KEY, *order)


def _filled(batch: DataFrame, interval: str, source: str) -> DataFrame:
    return batch.withColumns({
        "interval": F.coalesce("interval", F.lit(interval)) if "interval" in batch.columns else F.lit(interval),
        "source": F.coalesce("source", F.lit(source)) if "source" in batch.columns else F.lit(source),
        **{c: F.col(c).cast(schemas.PRICE) for c in ("open", "high", "low", "close")},
    })


def new_documents(batch: DataFrame, existing: DataFrame, *order: str) -> DataFrame:
    """Documents to append; those without a key always pass."""
    return absent(batch, existing, ["dedup_key"], *order)


def append(rows: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Append rows to a table and return their number, observed while writing."""
    from pyspark.sql import Observation

    seen = Observation()
    w = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return int(seen.get["n"])


def insert_partitioned(batch: DataFrame, path: str, key: list[str], by: list[str], *order: str) -> int:
    """Append the batch's new rows to a table partitioned by ``by`` (part of each row, and equal for equal keys) and return their number.

    The batch is computed once, into a table of its own next to the target. Its partitions, as many at most as the table's folders, then
    select what is read of the stored side, so the time doesn't depend on the history that the batch doesn't touch.
    """
    spark = batch.sparkSession
    staged_path = f"{path}_staged_{uuid.uuid4().hex}"
    first_of_key(batch, key, *order).write.partitionBy(*by).parquet(staged_path)
    staged = spark.read.schema(batch.schema).parquet(staged_path)
    touched = staged.select(*by).distinct().collect()
    try:
        stored = spark.read.schema(batch.schema).parquet(path)
    except Exception as e:  # only a table that has not been written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], batch.schema)
    n = append(missing(staged, partitions_of(stored, by, touched), key), path, by)
    _delete(spark, staged_path)
    return n


def partitions_of(stored: DataFrame, by: list[str], touched: list) -> DataFrame:
    """Rows of the given partitions, by one condition on the first column's values for each combination of the others."""
    *others, last = by
    groups: dict[tuple, list] = {}
    for row in touched:
        groups.setdefault(tuple(row[c] for c in others), []).append(row[last])
    wanted = F.lit(False)
    for head, values in groups.items():
        own = F.col(last).isin([v for v in values if v is not None])
        if None in values:
            own = own | F.col(last).isNull()
        for c, v in zip(others, head, strict=True):
            own = own & F.col(c).eqNullSafe(F.lit(v))
        wanted = wanted | own
    return stored.filter(wanted)


def missing(staged: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a batch without repeated keys whose key isn't stored; rows without a key all pass and meet nobody."""
    return _dealt(staged, key).join(_known(stored, key), [*key, "_row"], "left_anti").select(*staged.columns)


def insert_prices(batch: DataFrame, path: str, interval: str = "1d", source: str = "eodhd", *order: str) -> int:
    """Append new bars to the table partitioned by interval and day; the number of new rows."""
    day = F.date_format(F.timestamp_millis("timestamp_ms"), "yyyy-MM-dd")
    filled = _filled(batch, interval, source).withColumn("day", day)
    return insert_partitioned(filled, path, PRICE_KEY, ["interval", "day"], *order)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace_version(rows: DataFrame, root: str, version: int) -> str:
    """Write a whole table as a new version directory; readers switch to the path returned."""
    path = f"{root}/v={version:010d}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def log_run(spark: SparkSession, path: str, job: str, run_id: str, start_s: float, end_s: float, records: int, status: str = "ok", error: str | None = None) -> None:
    """Append one run record."""
    from datetime import datetime, timezone
    from decimal import Decimal

    at = lambda s: datetime.fromtimestamp(s, timezone.utc)
    row = (job, run_id, at(start_s), at(end_s), records, Decimal(f"{end_s - start_s:.2f}"), status, error)
    spark.createDataFrame([row], schemas.RUNS).write.mode("append").parquet(path)


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def delta(now: DataFrame, before: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key was not there before."""
    return now.join(before.select(*key), key, "left_anti")


def unprocessed(batch: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows still to be processed after a restart."""
    return batch.join(done.select(key), key, "left_anti")
