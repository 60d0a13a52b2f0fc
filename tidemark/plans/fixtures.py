"""Domain tables made by Spark from the given star-schema tables, so that every query's work grows with them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The companies of the fixtures.
COMPANIES = [
    ("T00", "Northwind Metals Inc.", "Materials", True), ("T01", "Harbor Freight Systems Corporation", "Industrials", True), ("T02", "Quantia Corp.", "Technology", True),
    ("T03", "Bluepeak Energy Holdings", "Energy", True), ("T04", "Harbor Mutual Group", "Financials", True), ("T05", "Celestra Foods Company", "Staples", True),
    ("T06", "Ovid & Co.", "Communication", True), ("T07", "Merrow Therapeutics Ltd.", "Health Care", True), ("T08", "Pinecrest Homes plc", "Real Estate", True),
    ("T09", "Zephyr Airlines Inc", "Industrials", False), ("T10", "Unpriced Utilities Limited", "Utilities", True),
]
INTERVALS = ["5m", "1d"]


class Tables:
    """The domain tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def company(self) -> DataFrame:
        rows = ", ".join(f"('{t}', '{n}', '{s}', {str(a).lower()})" for t, n, s, a in COMPANIES)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(ticker, company_name, sector, is_active)")

    @cached_property
    def event(self) -> DataFrame:
        seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
        return self.raw("events").select(
            "event_id", F.concat(F.lit("T"), F.lpad((F.col("user_id") % 10).cast("string"), 2, "0")).alias("ticker"), "event_type", "value",
            (seconds * 1000).cast("long").alias("ms"), F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @cached_property
    def price(self) -> DataFrame:
        e = self.event.filter(F.col("event_type").isin("view", "purchase"))
        at = F.explode(F.array(*[F.struct(F.lit(i).alias("interval"), (F.floor(F.col("ms") / w).cast("long") * w).alias("timestamp_ms")) for i, w in (("5m", 300_000), ("1d", 86_400_000))]))
        b = e.select("ticker", at.alias("b"), "value", "event_id").select("ticker", "b.*", "value", "event_id")
        return b.groupBy("ticker", "interval", "timestamp_ms").agg(
            F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
            F.when(F.max("event_id") % 70 != 0, F.count("*")).alias("volume"),
        )

    @cached_property
    def news(self) -> DataFrame:
        e = self.event.filter(F.col("event_type").isin("click", "signup", "error"))
        docs = self.raw("documents").select("doc_id", "text")
        n_docs = max(1, docs.count())  # a number and not a joined row, so that the join below keeps its equal key
        c = self.company.select(F.col("ticker").alias("c_ticker"), "company_name")
        j = (
            e.join(docs, F.col("doc_id") == F.col("event_id") % F.lit(n_docs))
            .join(c, F.col("c_ticker") == F.concat(F.lit("T"), F.lpad((F.col("k") % 10).cast("string"), 2, "0")))
        )
        err, four = F.col("event_type") == "error", F.col("event_id") % 4
        line = lambda *x: F.concat(F.col("text"), F.lit("\n"), *x)
        share = lambda m: (F.col("k") % m) / F.lit(10.0)
        return j.select(
            "ticker", F.col("ms").alias("published_ms"), "event_id", "k", F.when(err, "gdelt").otherwise("eodhd").alias("source"),
            F.when(err, "").when(F.col("event_id") % 3 == 0, F.concat("company_name", F.lit(" "), F.substring("text", 1, 40))).otherwise(F.substring(F.get(F.split("text", "\n"), F.lit(0)), 1, 100)).alias("title"),
            F.when(err, "").when(four == 0, line(F.lit("VIEW COMMENTS about "), F.col("company_name"))).when(four == 1, line(F.lit("Shares of "), F.col("company_name"), F.lit(" moved."))).otherwise(F.col("text")).alias("content"),
            F.array(F.concat("ticker", F.lit(".US")), F.col("c_ticker")).alias("symbols_mentioned"),
            F.when(err, F.slice(F.array(F.lit("ECON_INFLATION"), F.lit("ECON_TRADE"), F.lit("MERGER")), F.lit(1), F.col("k") % 4)).otherwise(F.array(F.lit("news"))).alias("tags"),
            F.when(~err & (F.col("k") % 11 != 0), F.struct(share(7).alias("pos"), share(5).alias("neg"), share(3).alias("neu"))).alias("vendor_sentiment"),
            F.when(err, (F.col("k") % 13) / F.lit(2.0) - 3).alias("tone_score"),
            F.concat(F.lit("N|"), F.col("event_id"), F.lit("|"), F.col("ticker")).alias("dedup_key"),
            F.when(err, F.concat(F.lit("http://n.example/"), "ticker", F.lit("/"), "k")).otherwise(F.concat(F.lit("https://WWW.N.example/"), "ticker", F.lit("/"), "k", F.lit("/?ref="), "event_id")).alias("url"),
        )

    @cached_property
    def score(self) -> DataFrame:
        n = self.news.filter("title <> '' AND event_id % 9 <> 0")
        m = F.explode(F.array(*[F.struct(F.lit(a).alias("model"), F.lit(b).alias("m")) for a, b in (("finbert", 7), ("roberta", 11))]))
        x = n.select("dedup_key", "ticker", "event_id", "k", "published_ms", m.alias("x")).select("*", "x.*")
        label = F.get(F.array(F.lit("positive"), F.lit("negative"), F.lit("neutral")), ((F.col("event_id") * F.col("m") + F.col("k")) % 3).cast("int"))
        return x.select(
            F.col("dedup_key").alias("source_dedup_key"), "ticker", "model", F.concat_ws("|", "dedup_key", "model").alias("dedup_key"), label.alias("label"),
            F.round(0.4 + ((F.col("event_id") * F.col("m")) % 61) / 100.0, 4).alias("confidence"),
            F.timestamp_millis(F.col("published_ms") + (F.col("event_id") * F.col("m")) % 1000 * 60_000).alias("scored_at"),
        )

    @cached_property
    def gkg_line(self) -> DataFrame:
        e = self.event.filter("event_type = 'error'")
        eid, k = F.col("event_id"), F.col("k")
        pick = lambda n, *v: F.get(F.array(*[F.lit(x) for x in v]), k % n)
        themes = pick(3, "TAX_X;ECON_TRADE;MERGER;", "ECON_INFLATION", "TAX_X;")
        orgs = pick(4, "Northwind Metals; quantia corp", "zephyr airlines inc;Zephyr Airlines", "unknown org", "Merrow Therapeutics")
        tone = F.when(eid % 40 == 0, "1.5,abc,2").otherwise(F.concat((k / 10.0).cast("string"), F.lit(",2.5,1.25,3.75,10.5,0.5,"), (100 + k).cast("string"), F.lit(".0")))
        fields = [
            F.concat(F.lit("G"), eid), F.when(eid % 50 == 0, "bad").otherwise(F.date_format(F.timestamp_millis("ms"), "yyyyMMddHHmmss")), F.lit("1"),
            F.concat(F.lit("pub"), (k % 5).cast("string"), F.lit(".example")), F.when(eid % 45 == 0, "").otherwise(F.concat(F.lit("http://e.example/"), eid)), F.lit(""), F.lit(""), themes,
            F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), orgs, F.lit(""), tone,
        ]
        tail = F.when(eid % 60 == 0, "").otherwise("\t" * 11)
        return e.select(eid.alias("line_no"), F.concat(F.concat_ws("\t", *fields), tail).alias("line"))
