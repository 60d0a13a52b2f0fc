"""The universe of companies: constituents, three-way merge, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The demo universe.
SEED = [
    ("AAPL", "Apple Inc."), ("MSFT", "Microsoft Corporation"), ("GOOGL", "Alphabet Inc."), ("AMZN", "Amazon.com Inc."), ("NVDA", "NVIDIA Corporation"),
    ("TSLA", "Tesla Inc."), ("META", "Meta Platforms Inc."), ("JPM", "JPMorgan Chase & Co."), ("V", "Visa Inc."), ("JNJ", "Johnson & Johnson"),
]


def seed(spark) -> DataFrame:
    rows = ", ".join(f"('{t}', '{n}')" for t, n in SEED)
    return spark.sql(f"SELECT ticker, company_name, true AS is_active FROM VALUES {rows} AS t(ticker, company_name)")


def merge(stored: DataFrame, fetched: DataFrame, now: str | None = None) -> DataFrame:
    """The new version of the company table, with what happened to each row in ``status``.

    New tickers are added as active; present ones take the fetched name, sector and number (``cik``, null where the table has none) and become
    active again without ``removed_at``; missing active ones are deactivated with ``removed_at`` set to ``now`` (a timestamp, the
    current one if not given); nothing is deleted. An empty fetch is an error, as it would deactivate all.
    """
    if fetched.isEmpty():
        raise ValueError("no constituents fetched")
    text, time = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    s = stored.withColumns({c: v for c, v in (("cik", text), ("removed_at", time)) if c not in stored.columns}).alias("s")
    f = (fetched if "cik" in fetched.columns else fetched.withColumn("cik", text)).alias("f")
    j = s.join(f, F.col("s.ticker") == F.col("f.ticker"), "full_outer")
    there, got, active = F.col("s.ticker").isNotNull(), F.col("f.ticker").isNotNull(), F.coalesce("s.is_active", F.lit(False))
    fields = ("company_name", "sector", "cik")
    same = F.lit(True)
    for c in fields:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}"))
    status = (
        F.when(~there, "added").when(got & ~active, "reactivated").when(got & ~same, "updated")
        .when(got, "unchanged").when(active, "deactivated").otherwise("inactive")
    )
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return j.select(
        F.coalesce("s.ticker", "f.ticker").alias("ticker"), *[F.when(got, F.col(f"f.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in fields],
        got.alias("is_active"), F.when(got, time).when(active, at).otherwise(F.col("s.removed_at")).alias("removed_at"), status.alias("status"),
    )


def report(merged: DataFrame) -> DataFrame:
    """(status, ticker): what happened to each ticker; those stored and not fetched are listed as ``missing`` too."""
    return merged.select(F.explode(F.when(F.col("status").isin("deactivated", "inactive"), F.array("status", F.lit("missing"))).otherwise(F.array("status"))).alias("status"), "ticker")


def active(companies: DataFrame, only: str | None = None, most: int | None = None) -> DataFrame:
    """Active companies by ticker; ``only`` is a comma-separated list that replaces them, ``most`` cuts the list short."""
    if only is not None:
        wanted = companies.sparkSession.range(1).select(F.explode(F.split(F.lit(only), ",")).alias("t")).select(F.upper(F.trim("t")).alias("ticker")).filter("ticker <> ''").distinct()
        out = wanted.join(companies, "ticker", "left")
    else:
        out = companies.filter("is_active")
    out = out.select("ticker", "company_name", "sector").orderBy("ticker")
    return out.limit(most) if most else out


def membership_counts(companies: DataFrame) -> DataFrame:
    return companies.agg(F.count("*").alias("total"), F.count_if("is_active").alias("active"), F.count_if(~F.col("is_active")).alias("inactive"))
