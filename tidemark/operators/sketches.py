"""Counts and quantiles that are kept by day as mergeable sketches, so that a report reads the sketches and a new day reads itself alone.

The table is a versioned one by day (``versions``): a day that is sketched again takes the place of what it was. Distinct counts are
HyperLogLog sketches (standard error 1.04 / sqrt(2 ** ``LOG``), 0.8 % here), quantiles KLL sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import versions

LOG = 14


def by_day(rows: DataFrame, group: list[str], distinct: str, value: str, time_ms: str) -> DataFrame:
    """(day, group..., n, distinct, values): a row for each day and group."""
    day = F.date_format(F.timestamp_millis(time_ms), "yyyy-MM-dd")
    return rows.filter(F.col(time_ms).isNotNull()).groupBy(day.alias("day"), *group).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(distinct, LOG).alias("distinct"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("values")
    )


def schema(rows: DataFrame, group: list[str], distinct: str, value: str, time_ms: str) -> StructType:
    return by_day(rows, group, distinct, value, time_ms).schema


def refresh(rows: DataFrame, root: str, group: list[str], distinct: str, value: str, time_ms: str, from_ms: int | None = None, to_ms: int | None = None) -> int:
    """Sketch the rows' days, or those of a half-open range of time only, in place of what the table has of them."""
    own = rows
    if from_ms is not None:
        own = own.filter(F.col(time_ms) >= from_ms)
    if to_ms is not None:
        own = own.filter(F.col(time_ms) < to_ms)
    return versions.refresh(by_day(own, group, distinct, value, time_ms), root, "day")


def report(spark: SparkSession, root: str, kind: StructType, group: list[str], ranks: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """For each group over all days: rows, estimated distinct values, and the value at each rank (``q50`` ...)."""
    merged = versions.read(spark, root, kind).groupBy(*group).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct").alias("d"), F.kll_merge_agg_double("values").alias("v"))
    at: list[Column] = [F.kll_sketch_get_quantile_double("v", F.lit(r)).alias(f"q{round(100 * r)}") for r in ranks]
    return merged.select(*group, "n", F.hll_sketch_estimate("d").alias("distinct"), *at)
