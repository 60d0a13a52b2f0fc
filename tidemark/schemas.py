"""Schemas of the domain tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PRICE = T.DecimalType(12, 4)
VENDOR_SENTIMENT = struct(polarity=D, neg=D, neu=D, pos=D)
TONE = struct(tone_score=D, positive=D, negative=D, polarity=D, activity_ref_density=D, word_count=T.IntegerType())

COMPANIES = struct(ticker=S, company_name=S, sector=S, industry=S, exchange=S, cik=S, is_active=B, added_at=TS, removed_at=TS, updated_at=TS)
PRICES = struct(ticker=S, timestamp_ms=L, datetime_utc=TS, open=PRICE, high=PRICE, low=PRICE, close=PRICE, volume=L, interval=S, source=S)
NEWS = struct(
    ticker=S, title=S, content=S, published_at=S, published_ms=L, url=S, publisher=S, symbols_mentioned=T.ArrayType(S), tags=T.ArrayType(S),
    vendor_sentiment=VENDOR_SENTIMENT, tone=TONE, record_id=S, dedup_key=S, source=S,
)
SCORES = struct(ticker=S, source_dedup_key=S, text_scored=S, model=S, label=S, confidence=D, raw_label=S, raw_score=D, dedup_key=S, scored_at=TS)
RUNS = struct(job=S, run_id=S, start_time=TS, end_time=TS, records=L, latency_seconds=T.DecimalType(10, 2), status=S, error_message=S)

EOD_BAR = struct(date=S, open=D, high=D, low=D, close=D, volume=L)
INTRADAY_BAR = struct(timestamp=L, open=D, high=D, low=D, close=D, volume=L)
VENDOR_ARTICLE = struct(date=S, title=S, content=S, link=S, symbols=T.ArrayType(S), tags=T.ArrayType(S), sentiment=VENDOR_SENTIMENT)
