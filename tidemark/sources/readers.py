"""Landed files to typed tables. Schemas are given; unreadable fields become null and their rows are dropped where they are needed."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions.expressions import parse_published


def _with_ticker(raw: DataFrame) -> DataFrame:
    """The ticker out of folders named ``ticker=...``, or else out of the file's name."""
    return raw.withColumn("ticker", F.upper("ticker")) if "ticker" in raw.columns else raw.withColumn("ticker", _ticker_of_file())


def _ticker_of_file() -> Column:
    return F.upper(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.US)?\.json(?:l)?(?:\.gz)?$", 1))


def _bars(df: DataFrame, interval: str, source: str) -> DataFrame:
    cols = [F.col(c).cast(schemas.PRICE).alias(c) for c in ("open", "high", "low", "close")]
    return df.select("ticker", "timestamp_ms", F.timestamp_millis("timestamp_ms").alias("datetime_utc"), *cols, "volume", F.lit(interval).alias("interval"), F.lit(source).alias("source"))


def _json(spark: SparkSession, path: str, schema: StructType, multi_line: bool, stream_files: int | None) -> DataFrame:
    """Landed JSON with its ticker, as a table or, with ``stream_files`` (0: no limit of files a batch), as a stream over folders named ``ticker=...``."""
    if stream_files is None:
        return _with_ticker(spark.read.schema(schema).option("multiLine", multi_line).json(path))
    r = spark.readStream.schema(StructType(list(schema.fields)).add("ticker", "string")).option("multiLine", multi_line)
    return _with_ticker((r.option("maxFilesPerTrigger", stream_files) if stream_files else r).json(path))


def eod_bars(spark: SparkSession, path: str, source: str = "eodhd", multi_line: bool = True, stream_files: int | None = None) -> DataFrame:
    """Daily bars from one JSON array per ticker; rows with an unreadable date are dropped, times are midnight UTC."""
    raw = _json(spark, path, schemas.EOD_BAR, multi_line, stream_files)
    ms = F.unix_millis(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")))
    return _bars(raw.withColumn("timestamp_ms", ms).filter("timestamp_ms IS NOT NULL"), "1d", source)


def intraday_bars(spark: SparkSession, path: str, interval: str = "5m", source: str = "eodhd", multi_line: bool = True, stream_files: int | None = None) -> DataFrame:
    """Intraday bars from epoch seconds; null and zero times are dropped."""
    raw = _json(spark, path, schemas.INTRADAY_BAR, multi_line, stream_files)
    return _bars(raw.filter("timestamp <> 0").withColumn("timestamp_ms", F.col("timestamp") * 1000), interval, source)


def bounded_history(bars: DataFrame, from_ms: int, to_ms: int, source: str = "eodhd_historical") -> DataFrame:
    """Bars of a closed range of time under a source name of their own."""
    return bars.filter(F.col("timestamp_ms").between(from_ms, to_ms)).withColumn("source", F.lit(source))


def vendor_news(spark: SparkSession, path: str, source: str = "eodhd", multi_line: bool = True) -> DataFrame:
    """Vendor articles from one JSON array per ticker."""
    raw = _with_ticker(spark.read.schema(schemas.VENDOR_ARTICLE).option("multiLine", multi_line).json(path))
    return raw.select(
        "ticker", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("content", F.lit("")).alias("content"), F.col("date").alias("published_at"), parse_published(F.col("date")).alias("published_ms"),
        F.col("link").alias("url"), F.col("symbols").alias("symbols_mentioned"), "tags", F.col("sentiment").alias("vendor_sentiment"), F.lit(source).alias("source"),
        F.concat_ws("|", F.coalesce("date", F.lit("")), F.substring(F.coalesce("title", F.lit("")), 1, 100), "ticker").alias("dedup_key"),
    )


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain tab-separated record files, with the file they come from."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("file"))


def zipped_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of zipped record snapshots; undecodable bytes are left out and broken archives skipped. One task reads one archive as a stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                for member in archive.namelist():
                    lines: list[str] = []
                    with archive.open(member) as f:
                        for raw in f:
                            lines.append(raw.rstrip(b"\r\n").decode("utf-8", "ignore"))
                            if len(lines) == 20_000:
                                yield pd.DataFrame({"line": lines, "file": file})
                                lines = []
                    yield pd.DataFrame({"line": lines, "file": file})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInPandas(run, "line string, file string")


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a snapshot index with their number in order of the file."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    return lines.filter("line <> ''")


def constituents(pages: DataFrame, html: str = "html") -> DataFrame:
    """(ticker, company_name, sector, cik) from the table with id ``constituents``, columns taken by the names in its first row.

    Rows are what lies between row ends, cells what follows each cell's start tag up to the next one; entities and markup inside
    cells are left out. Dots of tickers become dashes and numbers get leading zeros up to ten digits.
    """
    plain = lambda c: F.trim(F.regexp_replace(F.replace(F.regexp_replace(c, "<[^>]*>", " "), F.lit("&amp;"), F.lit("&")), r"\s+", " "))
    body = F.get(F.split(F.get(F.split(F.col(html), r"(?i)<table[^>]*\bid=[\"']?constituents\b[^>]*>", 2), F.lit(1)), "(?i)</table", 2), F.lit(0))
    lines = F.filter(F.split(body, r"(?i)<tr\b[^>]*>"), lambda r: r.rlike(r"(?i)<t[dh]\b"))
    cells = F.transform(lines, lambda r: F.transform(F.slice(F.split(r, r"(?i)<t[dh]\b[^>]*>"), 2, 1000), plain))
    table = pages.select(cells.alias("rows")).filter(F.size("rows") > 0).withColumn("head", F.transform(F.element_at("rows", 1), F.lower))
    rows = table.select("head", F.explode(F.slice("rows", 2, 2**31 - 1)).alias("row"))

    def cell(place: int, *names: str) -> Column:
        """The cell under the first heading of one of the names, or at the usual place if no heading says so; null for an empty or missing one."""
        at = [F.nullif(F.array_position("head", F.lit(n)), F.lit(0)).cast("int") - 1 for n in names]
        return F.nullif(F.get("row", F.coalesce(*at, F.lit(place))), F.lit(""))

    number = cell(6, "cik")
    return rows.select(
        F.replace(cell(0, "symbol", "ticker"), F.lit("."), F.lit("-")).alias("ticker"), cell(1, "security", "company", "company_name").alias("company_name"), cell(2, "gics sector", "sector").alias("sector"),
        F.when(number.rlike(r"^\d+$"), F.lpad(number, 10, "0")).alias("cik"),
    ).filter("ticker IS NOT NULL")


def write_universe(companies: DataFrame, path: str) -> None:
    """One JSON object a company; ``cik`` goes with it where the table has it."""
    companies.select("ticker", "company_name", "sector", *[c for c in ("cik",) if c in companies.columns]).write.mode("overwrite").json(path)
