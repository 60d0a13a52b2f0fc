import random

from pyspark.sql import functions as F

from tidemark.operators import fusion

BAR = "ticker string, interval string, timestamp_ms long, open double, high double, low double, close double, volume long"
NEWS = "ticker string, published_ms long, dedup_key string"
T0 = 1_704_200_000_000 // 300_000 * 300_000
MIN = 60_000


def bars(spark, *rows):
    return spark.createDataFrame([(t, i, ms, 1.0, 2.0, 0.5, 1.5, 10) for t, i, ms in rows], BAR)


def test_window_is_closed_and_ends_a_second_later(spark):
    news = spark.createDataFrame([("A", T0 - 30 * MIN, "from"), ("A", T0 + 5 * MIN, "to"), ("A", T0 - 30 * MIN - 1000, "early"), ("A", T0 + 5 * MIN + 1000, "late"), ("A", None, "none"), ("B", T0, "other")], NEWS)
    got = {r.dedup_key: r.offset_min for r in fusion.interval_pairs(bars(spark, ("A", "5m", T0)), news).collect()}
    assert got == {"from": -30.0, "to": 5.0}


def test_bucketed_join_equals_plain_join(spark):
    b = bars(spark, *[("A", i, T0 + k * 300_000 * (3 if i == "1d" else 1)) for i in ("5m", "1m", "15m", "1h", "1d", "odd") for k in range(12)])
    news = spark.createDataFrame([("A", T0 + k * 397_000 - 3_600_000, f"n{k}") for k in range(120)], NEWS)
    w = fusion.with_windows(b)
    plain = w.join(news, "ticker").filter((F.col("published_ms") >= F.col("ref_ms") - F.col("lookback_min") * MIN) & (F.col("published_ms") <= F.col("ref_ms") + F.col("lookahead_min") * MIN)).select("interval", "timestamp_ms", "dedup_key")
    got = fusion.interval_pairs(b, news).select("interval", "timestamp_ms", "dedup_key")
    assert got.count() == plain.count() > 0
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_ties_and_cap(spark):
    news = spark.createDataFrame([("A", T0 + MIN, "after"), ("A", T0 - MIN, "before"), *[("A", T0, f"k{i:02d}") for i in range(11)]], NEWS)
    e = fusion.fuse(bars(spark, ("A", "5m", T0), ("Z", "5m", T0)), news).orderBy("ticker").collect()
    assert [x.dedup_key for x in e[0].news_context] == [f"k{i:02d}" for i in range(10)] and e[0].news_count == 10
    assert e[1].news_count == 0 and e[1].news_context == [] and e[1].dedup_key == f"Z|{T0}|5m"
    few = fusion.fuse(bars(spark, ("A", "5m", T0)), news.filter("dedup_key IN ('after', 'before')")).first()
    assert [x.dedup_key for x in few.news_context] == ["before", "after"]


def test_daily_bar_stands_for_market_close(spark):
    day = T0 // 86_400_000 * 86_400_000
    b = fusion.with_windows(bars(spark, ("A", "1d", day), ("A", "5m", T0), ("A", "2w", T0))).orderBy("interval").collect()
    assert [(r.ref_ms, r.lookback_min, r.lookahead_min) for r in b] == [(day + 20 * 3_600_000, 1440, 5760), (T0, 1440, 5760), (T0, 30, 5)]


def test_frozen_and_refreshed_bars(spark):
    b = bars(spark, ("A", "5m", T0), ("A", "5m", T0 + 300_000))
    news = spark.createDataFrame([("A", T0, "n")], NEWS)
    before = b.filter(F.col("timestamp_ms") == T0)
    assert [r.timestamp_ms for r in fusion.fuse_incremental(b, news, before).collect()] == [T0 + 300_000]
    assert fusion.fuse_incremental(b, news, before, refresh_from_ms=T0).count() == 2


def test_plan_has_no_python_and_no_product(spark):
    from tidemark.plans.queries import QUERIES

    plan = QUERIES["fusion_topk"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and "WindowGroupLimit" in plan


def test_no_nested_loop_over_tables(spark):
    from tidemark.plans.queries import QUERIES

    for name in ("sent_compare", "sent_lexicon", "fusion_events_flat", "entity_gkg", "audit_scores_by_model"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_near_pairs_hold_the_nearest_of_dense_news(spark):
    """Bars, one of them twice, off the minute and at its edges, with news in heaps at one time, own and foreign, and with less than ten in the window."""
    rng = random.Random(8)
    b = bars(spark, *[(t, i, T0 + rng.randint(-3, 3) * 700_001) for t in "AB" for i in ("5m", "1d") for _ in range(4)], ("A", "5m", T0 + 10 * 86_400_000)).dropDuplicates()
    b = b.unionAll(b.filter("ticker = 'A'"))
    rows = [("A", T0 + rng.randint(-2_000, 2_000) * 1_000, f"a{i}", rng.random() < 0.5) for i in range(3_000)]
    rows += [("B", T0 + 60_000 * (i % 3), f"b{i}", i % 2 == 0) for i in range(40)] + [("A", T0 + 10 * 86_400_000 + m * 60_000, f"c{m}", False) for m in (-30, 5)] + [("A", None, "d", False)]
    n = spark.createDataFrame(rows, "ticker string, published_ms long, dedup_key string, is_foreign boolean")
    whole, near = fusion.interval_pairs(b, n), fusion.near_pairs(b, n)
    assert near.count() * 10 < whole.count()
    cols = ["ticker", "interval", "timestamp_ms", "rank", "dedup_key", "offset_min"]
    want, got = (sorted(map(tuple, fusion.nearest(x).select(cols).collect())) for x in (whole, near))
    assert got == want and len(want) > 100
