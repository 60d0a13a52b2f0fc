"""Streams: unmatched bars and late news, two tables written once, keyed state with a time to live."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fusion, sentiment
from tidemark.streaming import ledger, state, streams

T0, MINUTE, HOUR = 1_704_200_100_000, 60_000, 3_600_000
BAR, NEWS = "ticker string, interval string, timestamp_ms long", "ticker string, dedup_key string, published_ms long"
PRICED = f"{BAR}, open double, high double, low double, close double, volume long"


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_bars_without_news_come_out_once_and_late_news_is_dropped(spark, tmp_path):
    bars, news, target, check = (str(tmp_path / x) for x in ("bars", "news", "pairs", "check"))

    def poll(bar_rows, news_rows):
        land(spark, bars, bar_rows, BAR)
        land(spark, news, news_rows, NEWS)
        kinds = [spark.createDataFrame([], s).schema for s in (BAR, NEWS)]
        pairs = streams.fuse_join(streams.table_stream(spark, bars, kinds[0]), streams.table_stream(spark, news, kinds[1]), intervals=["5m"])
        q = streams.sink(pairs, target, check)
        q.awaitTermination()
        got = spark.read.schema(pairs.schema).parquet(target).collect()
        return sorted((r.ticker, r.timestamp_ms - T0, r.dedup_key or "") for r in got), q

    got, _ = poll([("A", "5m", T0), ("B", "5m", T0)], [("B", "n1", T0 - 30 * MINUTE), ("B", "n0", T0 - 31 * MINUTE), ("B", "n2", T0 + 5 * MINUTE)])
    assert got == [("B", 0, "n1"), ("B", 0, "n2")]  # both ends of the window are closed; A may still get news
    got, _ = poll([("C", "5m", T0 + 2 * HOUR)], [("C", "n3", T0 + 2 * HOUR)])
    once = [("A", 0, ""), ("B", 0, "n1"), ("B", 0, "n2"), ("C", 2 * HOUR, "n3")]
    assert got == once  # the watermark has passed A's window
    got, q = poll([("D", "5m", T0 + 2 * HOUR)], [("A", "late", T0)])
    assert got == once
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 1
    held = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]][-1]
    assert held <= 3  # C, D and their news; what the watermark has passed is gone


def test_joined_streams_meet_by_ticker_and_time(spark):
    """Both ends of windows at and beside the edges of buckets, and bars of unlisted intervals, equal a plain range join; the key has the time in it."""
    edge, rows, articles = streams.SPAN * 35 * MINUTE * 200_000, [], []
    for k, off in enumerate((-36, -35, -30, -5, -1, 0, 1, 5, 30, 35, 36)):
        for name in ("5m", "1d", "15m", "other", None):
            rows.append(("A", name, edge + off * MINUTE))
        articles += [("A", f"n{k}{d}", edge + off * MINUTE + d) for d in (-1, 0, 1)]
    rows += [("A", "5m", None), (None, "5m", edge), ("B", "5m", edge)]
    articles += [("A", "none", None), (None, "nobody", edge)]
    bars, news = spark.createDataFrame(rows, BAR), spark.createDataFrame(articles, NEWS)
    for intervals in (["5m"], ["5m", "1d"], None):
        back, ahead = (max(fusion.FUSION_WINDOWS[i][side] for i in intervals or fusion.FUSION_WINDOWS) for side in (0, 1))
        b = fusion.with_windows(bars).alias("b")
        first, last = (F.least(c, F.lit(most)) * MINUTE for c, most in (("lookback_min", back), ("lookahead_min", ahead)))
        near = (F.col("b.ticker") == F.col("n.ticker")) & F.col("published_ms").between(F.col("ref_ms") - first, F.col("ref_ms") + last)
        want = b.join(news.alias("n"), near, "left").select("b.ticker", "interval", "timestamp_ms", "dedup_key", ((F.col("published_ms") - F.col("ref_ms")) / MINUTE).alias("offset_min"))
        got = streams.fuse_join(bars, news, intervals=intervals)
        assert got.count() > 60 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        keys = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in line]
        assert keys and all("bucket" in line for line in keys)


def test_two_tables_get_a_batch_once_though_it_fails_between_them(spark, tmp_path):
    landed, a, b, book, check = (str(tmp_path / x) for x in ("in", "a", "b", "ledger", "check"))
    land(spark, landed, [("A", "5m", T0), ("B", "5m", T0)], BAR)
    kind = spark.read.parquet(landed).schema
    ran, broken = [], [True]

    def second(batch):
        if broken[0]:
            raise RuntimeError("lost between both")
        return batch

    def run():
        tables = [("a", a, lambda batch: ran.append(1) or batch), ("b", b, second)]
        ledger.write_tables(streams.table_stream(spark, landed, kind), tables, book, check).awaitTermination()

    with pytest.raises(Exception, match="lost between both"):
        run()
    assert ledger.committed(spark, "a", a, book, kind).count() == 2 and ledger.committed(spark, "b", b, book, kind).count() == 0
    broken[0] = False
    run()
    assert len(ran) == 1  # the batch ran again, the table that had it did not
    assert all(ledger.committed(spark, n, p, book, kind).count() == 2 for n, p in (("a", a), ("b", b)))
    land(spark, landed, [("C", "5m", T0)], BAR)
    run()
    spark.createDataFrame([("D", "5m", T0)], BAR).write.parquet(f"{b}/query=other/batch=7")  # left behind by an attempt that never came through
    found = ledger.committed(spark, "b", b, book, kind)
    assert sorted(r.ticker for r in found.collect()) == ["A", "B", "C"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_enriched_events_after_a_failure_between_scores_and_events(spark, tmp_path, monkeypatch):
    landed, scores, enriched, book, check = (str(tmp_path / x) for x in ("fused", "scores", "enriched", "ledger", "check"))
    news = spark.createDataFrame([("A", "n1", T0, "strong gains"), ("A", "n2", T0, "loss"), ("A", "n3", T0, "")], f"{NEWS}, title string")
    bars = spark.createDataFrame([("A", "5m", T0, 1.0, 1.0, 1.0, 1.0, 1), ("A", "5m", T0 + 5 * MINUTE, 1.0, 1.0, 1.0, 1.0, 1), ("B", "5m", T0, 1.0, 1.0, 1.0, 1.0, 1)], PRICED)
    fusion.fuse(bars, news, intervals=["5m"]).repartition(2, "timestamp_ms").write.parquet(landed)
    kind = spark.read.parquet(landed).schema
    real = sentiment.enrich_fused

    def run():
        streams.enrich_stream(streams.table_stream(spark, landed, kind, 1), lambda: news, scores, enriched, book, check).awaitTermination()

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(sentiment, "enrich_fused", lost)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(sentiment, "enrich_fused", real)
    run()
    s = ledger.committed(spark, "scores", scores, book, sentiment.score_articles(news).schema)
    assert sorted(r.dedup_key for r in s.collect()) == ["n1|finbert", "n1|roberta", "n2|finbert", "n2|roberta"]  # n3 has no title; nothing is scored twice
    e = ledger.committed(spark, "enriched", enriched, book, real(spark.read.parquet(landed), s).schema).collect()
    assert len(e) == 3 and sorted(r.news_count for r in e) == [0, 3, 3]
    labels = {x.dedup_key: x.finbert.label if x.finbert else None for r in e for x in r.news_context}
    assert labels == {"n1": "positive", "n2": "negative", "n3": None}


def test_state_knows_keys_for_its_time_to_live(spark, tmp_path):
    landed, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))

    def poll(*rows):
        land(spark, landed, list(rows), "ticker string, interval string, timestamp_ms long, close double")
        bars = state.new_bars(streams.table_stream(spark, landed, spark.read.parquet(landed).schema), live_ms=15_000)
        q = streams.sink(bars, target, check, idle=False)
        q.awaitTermination()
        got = spark.read.schema(bars.schema).parquet(target)
        return sorted((r.ticker, (r.timestamp_ms - T0) // MINUTE, r.close) for r in got.collect()), sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"])

    began = time.time()
    got, held = poll(("A", "5m", T0, 1.0), ("A", "5m", T0, 1.0), ("A", "5m", T0 + 5 * MINUTE, 2.0), (None, "5m", T0, 9.0), ("A", None, T0, 9.0))
    assert got == [("A", 0, 1.0), ("A", 5, 2.0)] and held == 1  # one bucket for a day
    got, held = poll(("A", "5m", T0, 7.0), ("B", "5m", T0, 3.0))
    if time.time() - began < 14:
        assert got == [("A", 0, 1.0), ("A", 5, 2.0), ("B", 0, 3.0)] and held == 2  # delivered again: nothing new
    time.sleep(16)
    got, held = poll(("C", "5m", T0, 4.0))
    assert held == 1  # the others have been forgotten
    got, _ = poll(("A", "5m", T0, 7.0))
    assert ("A", 0, 7.0) in got


def test_row_by_row_articles_equal_the_joined_ones(spark):
    from tidemark.operators import articles
    from tidemark.plans.fixtures import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    records, names = articles.split_records(t.gkg_line.drop("line_no")), articles.org_name_map(t.company)
    a, b = articles.to_articles(records, names), articles.articles_by_row(records, names)
    assert a.count() > 50 and a.select(b.columns).exceptAll(b).count() == b.exceptAll(a.select(b.columns)).count() == 0


def test_streams_of_bars_read_folders_of_tickers(spark, tmp_path):
    for ticker, text in (("a", '[{"date": "2024-01-05", "open": 1, "high": 2, "low": 1, "close": 1.5, "volume": 3}, {"date": "soon"}]'), ("b", "[]")):
        (tmp_path / "eod" / f"ticker={ticker}").mkdir(parents=True)
        (tmp_path / "eod" / f"ticker={ticker}" / "x.json").write_text(text)
    s = streams.bar_stream(spark, str(tmp_path / "eod"), "1d")
    streams.sink(state.new_bars(s), str(tmp_path / "out"), str(tmp_path / "check"), idle=False).awaitTermination()
    got = spark.read.schema(s.schema).parquet(str(tmp_path / "out")).select("ticker", "interval", F.col("timestamp_ms"), F.col("close").cast("double")).collect()
    assert [tuple(r) for r in got] == [("A", "1d", 1_704_412_800_000, 1.5)]
