"""As-of match, sketches by day and sessions against brute force and exact values."""

import random

from pyspark.sql import functions as F

from tidemark.operators import asof, sketches, versions
from tidemark.plans.fixtures import Tables
from tidemark.streaming import streams

T0, MINUTE, DAY = 1_704_153_600_000, 60_000, 86_400_000


def test_latest_article_by_brute_force(spark):
    rng = random.Random(4)
    bars = [(rng.choice(["A", "B", "C", None]), "5m", T0 + rng.randint(-3, 40) * DAY // 4 + rng.randint(0, 3) * MINUTE) for _ in range(300)]
    news = [(rng.choice(["A", "A", "A", "B", None]), T0 + rng.choice([0, 1, 2, 17, 18]) * DAY + rng.randint(0, 5) * MINUTE, f"n{i}") for i in range(60)] + [("A", None, "x"), ("A", T0, None)]
    bars = list(dict.fromkeys(bars))
    b = spark.createDataFrame(bars, "ticker string, interval string, timestamp_ms long").repartition(3)
    n = spark.createDataFrame(news, "ticker string, published_ms long, dedup_key string").repartition(3)
    key = lambda x: (x[0], x[1] is not None, x[1] or "")
    for bucket, within in ((DAY, None), (MINUTE, None), (1000 * DAY, None), (DAY, 2 * DAY)):
        want = set()
        for ticker, interval, at in bars:
            found = max(((m, k) for t, m, k in news if t is not None and t == ticker and m is not None and m <= at and (within is None or at - m <= within)), key=key, default=(None, None))
            want.add((ticker, interval, at, found[1], found[0], None if found[0] is None else at - found[0]))
        got = asof.latest_before(b, n, bucket, within)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(bars)
    plan = asof.latest_before(b, n)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert plan.count("Window [") == 2 and "hashpartitioning(ticker" in plan


def test_daily_bars_match_at_the_close(spark):
    b = spark.createDataFrame([("A", "1d", T0)], "ticker string, interval string, timestamp_ms long")
    n = spark.createDataFrame([("A", T0 + 20 * 60 * MINUTE, "close"), ("A", T0 + 20 * 60 * MINUTE + 1, "after")], "ticker string, published_ms long, dedup_key string")
    assert asof.latest_before(b, n).first().dedup_key == "close"


def test_sketches_are_close_and_a_day_takes_the_place_of_itself(spark, tmp_path):
    n = Tables(spark, "/root/testdata/sf0.1").event.select("ticker", F.concat("ticker", F.lit("|"), "event_id").alias("key"), "value", "ms")
    root, own = str(tmp_path / "s"), (["ticker"], "key", "value", "ms")
    kind = sketches.schema(n, *own)
    sketches.refresh(n, root, *own)
    first = {r.value: r.part for r in versions.parts(spark, root).collect()}
    start = n.agg(F.min("ms")).first()[0] // DAY * DAY
    assert sketches.refresh(n, root, *own, from_ms=start, to_ms=start + DAY) == 2
    second = {r.value: r.part for r in versions.parts(spark, root).collect()}
    assert sum(first[d] != second[d] for d in second) == 1 and first.keys() == second.keys()  # one day was written, the others stay
    exact = {r.ticker: r for r in n.groupBy("ticker").agg(F.count("*").alias("n"), F.countDistinct("key").alias("d"), F.percentile("value", 0.48).alias("lo"), F.percentile("value", 0.52).alias("hi")).collect()}
    got = sketches.report(spark, root, kind, ["ticker"]).collect()
    assert len(got) == len(exact) == 10
    for r in got:
        e = exact[r.ticker]
        assert r.n == e.n and abs(r.distinct - e.d) <= 0.02 * e.d and e.lo <= r.q50 <= e.hi
    one = n.filter((F.col("ms") >= start) & (F.col("ms") < start + DAY))
    assert "PushedFilters" in one._jdf.queryExecution().executedPlan().toString()
    assert sketches.report(spark, str(tmp_path / "none"), kind, ["ticker"]).count() == 0


def test_sessions_and_dropped_rows(spark, tmp_path):
    landed, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))

    def poll(*rows):
        at = [(t, m * 60) for t, m in rows]
        spark.createDataFrame(at, "ticker string, s long").select("ticker", F.timestamp_seconds(F.lit(T0 // 1000) + F.col("s")).alias("published")).coalesce(1).write.mode("append").parquet(landed)
        s = streams.sessions(streams.table_stream(spark, landed, spark.read.parquet(landed).schema), gap="2 hours", late="30 minutes")
        q = streams.sink(s, target, check)
        q.awaitTermination()
        got = spark.read.schema(s.schema).parquet(target).collect()
        return sorted((r.ticker, (r.start_ms - T0) // MINUTE, (r.last_ms - T0) // MINUTE, r.articles) for r in got), streams.dropped_rows(q)

    got, dropped = poll(("A", 0), ("A", 119), ("A", 239), ("A", 360), ("B", 0), ("B", 121))
    assert dropped == 0
    got, dropped = poll(("A", 600), ("A", 610))
    closed = [("A", 0, 239, 3), ("A", 360, 360, 1), ("B", 0, 0, 1), ("B", 121, 121, 1)]
    assert got == closed and dropped == 0  # 120 minutes and less join, 121 part
    got, dropped = poll(("A", 5), ("B", 10))
    assert got == closed and dropped == 2
    got, dropped = poll(("Z", 10_000))
    assert got == [*closed[:2], ("A", 600, 610, 2), *closed[2:]]
