"""Open-data records to articles, and the organisation name map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import GKG_FIELDS
from tidemark.functions.expressions import financial_themes, parse_compact_time, parse_tone, strip_name_suffix
from tidemark.operators.store import new_documents


def org_name_map(companies: DataFrame) -> DataFrame:
    """(name, ticker): lower-case company names, and those without their suffix if three letters or more are left.

    Where two companies share a name the first ticker wins, a full name before a cut one of the same company.
    """
    full = F.lower(F.trim("company_name"))
    named = companies.filter("company_name IS NOT NULL AND ticker IS NOT NULL").select(F.col("ticker"), full.alias("full"), strip_name_suffix(full).alias("cut"))
    both = named.select("ticker", F.explode(F.array(F.struct(F.lit(0).alias("no"), F.col("full").alias("name")), F.struct(F.lit(1).alias("no"), F.col("cut").alias("name")))).alias("v"))
    rows = both.select("ticker", "v.no", "v.name").filter((F.length("name") >= 3) | (F.col("no") == 0)).filter("name <> ''")
    return rows.groupBy("name").agg(F.min(F.struct("ticker", "no")).alias("w")).select("name", F.col("w.ticker").alias("ticker"))


# Places of the fields in use.
PLACES = {"record_id": 0, "date": 1, "publisher": 3, "url": 4, "themes": 7, "orgs": 13, "tone_field": 15}


def split_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Fields in use of tab-separated records; shorter records are dropped."""
    return field_records(lines.withColumn("fields", F.split(F.col(line), "\t")).drop(line))


def field_records(rows: DataFrame) -> DataFrame:
    """The same of records whose ``fields`` have been told apart."""
    f = rows.filter(F.size("fields") >= GKG_FIELDS)
    return f.select(*[c for c in rows.columns if c != "fields"], *[F.get("fields", F.lit(i)).alias(k) for k, i in PLACES.items()])


def staged(records: DataFrame, names: DataFrame) -> DataFrame:
    """Records with their financial themes and matched tickers, not yet filtered."""
    r = records.withColumn("tags", financial_themes(F.col("themes")))
    org = r.filter(F.size("tags") > 0).select("record_id", F.explode(F.array_distinct(F.transform(F.split("orgs", ";"), lambda o: F.lower(F.trim(o))))).alias("name"))
    found = org.join(names, "name").groupBy("record_id").agg(F.array_sort(F.collect_set("ticker")).alias("symbols_mentioned"))
    return r.join(found, "record_id", "left")


def to_articles(records: DataFrame, names: DataFrame, source: str = "gdelt", keep: tuple[str, ...] = ()) -> DataFrame:
    """One article per record and matched ticker; records without a financial theme, a known organisation or a readable time are dropped."""
    return _articles(staged(_whole(records), names), source, keep)


def articles_by_row(records: DataFrame, names: DataFrame, source: str = "gdelt", keep: tuple[str, ...] = ()) -> DataFrame:
    """The same by looking each row's organisations up in a map, for streams: no row meets another.

    The map is one row, aggregated from the names (a few for each company) and broadcast to the records.
    """
    one = F.broadcast(names.agg(F.map_from_entries(F.collect_list(F.struct("name", "ticker"))).alias("_names")))
    r = _whole(records).withColumn("tags", financial_themes(F.col("themes"))).filter(F.size("tags") > 0).crossJoin(one)
    found = F.transform(F.split("orgs", ";"), lambda o: F.element_at("_names", F.lower(F.trim(o))))
    return _articles(r.withColumn("symbols_mentioned", F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))), source, keep)


def _whole(records: DataFrame) -> DataFrame:
    return records.filter("url <> '' AND date <> '' AND record_id <> ''")


def _articles(s: DataFrame, source: str, keep: tuple[str, ...]) -> DataFrame:
    ms = parse_compact_time(F.col("date"))
    kept = s.filter(F.size("symbols_mentioned") > 0).withColumn("published_ms", ms).filter("published_ms IS NOT NULL")
    return kept.select(
        F.explode("symbols_mentioned").alias("ticker"), F.lit("").alias("title"), F.lit("").alias("content"), "published_ms", "url", "publisher",
        "symbols_mentioned", "tags", parse_tone(F.col("tone_field")).alias("tone"), "record_id", F.lit(source).alias("source"), *keep,
    ).withColumn("dedup_key", F.concat_ws("|", F.lit("gdelt"), "record_id", "ticker"))


def counters(records: DataFrame, names: DataFrame) -> DataFrame:
    """Records seen, with a financial theme, with a known organisation too, and articles made."""
    s = staged(records.filter("url <> '' AND date <> '' AND record_id <> ''"), names)
    known = F.coalesce(F.size("symbols_mentioned"), F.lit(-1)) > 0
    return s.agg(
        F.count("*").alias("seen"), F.count_if(F.size("tags") > 0).alias("with_theme"), F.count_if(known).alias("with_org"),
        F.coalesce(F.sum(F.when(known & parse_compact_time(F.col("date")).isNotNull(), F.size("symbols_mentioned"))), F.lit(0)).cast("long").alias("articles"),
    )


def historical(records: DataFrame, names: DataFrame, existing: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """Articles of many snapshots that are not stored yet, with their snapshot; an article in several comes from the first."""
    return new_documents(to_articles(records, names, "gdelt_historical", (snapshot,)), existing, snapshot)


def snapshot_articles(files: DataFrame, names: DataFrame, existing: DataFrame) -> DataFrame:
    """New articles of landed snapshots (rows of the ``record_files`` source), with their file; broken archives give none."""
    records = field_records(files.filter("error IS NULL").select("file", "fields"))
    return historical(records, names, existing, "file")


def snapshot_totals(files: DataFrame, new: DataFrame) -> DataFrame:
    """For each file: records read and those of full width, new articles, and why it was skipped if it was."""
    read = files.groupBy("file").agg(
        F.count("fields").alias("records"), F.count_if(F.size("fields") >= GKG_FIELDS).alias("full"), F.max("error").alias("error"),
    )
    return read.join(new.groupBy("file").agg(F.count("*").alias("articles")), "file", "left").fillna(0, ["articles"])


def cap_pages(pages: DataFrame, page_size: int = 1000, most_pages: int = 50) -> DataFrame:
    """Rows of (ticker, page, n) up to and including the first short or empty page of each ticker, at most ``most_pages``."""
    w = Window.partitionBy("ticker").orderBy("page")
    before = F.coalesce(F.sum(F.when(F.col("n") < page_size, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pages.withColumn("_short", before).withColumn("_no", F.row_number().over(w)).filter(f"_short = 0 AND _no <= {most_pages} AND n > 0").drop("_short", "_no")


def snapshots(index: DataFrame, first: str, last: str, most: int | None = None) -> DataFrame:
    """(line_no, stamp, url) of index lines ``size hash url`` whose file is a record snapshot between two stamps, in order of time."""
    url = F.element_at(F.split(F.trim("line"), r"\s+"), -1)
    s = index.select("line_no", F.regexp_extract(url, r"(\d{14})\.gkg\.csv\.zip$", 1).alias("stamp"), url.alias("url")).filter("stamp <> ''").filter(F.col("stamp").between(first, last))
    return s.orderBy("stamp", "line_no").limit(most) if most else s


def latest_snapshot(index: DataFrame) -> DataFrame:
    """The URL of the first index line that names a record snapshot."""
    url = F.element_at(F.split(F.trim("line"), r"\s+"), -1)
    return index.select("line_no", url.alias("url")).filter(F.col("url").endswith("gkg.csv.zip")).agg(F.min_by("url", "line_no").alias("url"))
