"""Tables by partition: inserts that read only what they touch, and refreshes behind a version pointer."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fusion, store, versions

DAY = 86_400_000
T0 = 1_704_153_600_000
PRICE = "ticker string, interval string, timestamp_ms long, open double, high double, low double, close double, volume long, source string"


def bar(ticker, day, minute=0, interval="5m", close=1.0):
    return (ticker, interval, T0 + day * DAY + minute * 60_000, 1.0, 2.0, 1.0, close, 1, None)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}


def held(spark, root):
    """Files of each day that readers see."""
    return {r.value: sorted(map(str, Path(root, f"data/part={r.part}").glob("part*"))) for r in versions.parts(spark, root).collect()}


def test_rows_without_a_key_pass_and_ties_go_by_order_then_hash(spark):
    batch = spark.createDataFrame([(None, 1), (None, 1), ("a", 2), ("a", 1), ("b", 1), ("c", 1)], "dedup_key string, n int")
    got = store.new_documents(batch, spark.createDataFrame([("b",), (None,)], "dedup_key string"), "n")
    assert sorted((r.dedup_key or "", r.n) for r in got.collect()) == [("", 1), ("", 1), ("a", 1), ("c", 1)]
    assert store.new_documents(batch, batch).count() == 2
    plan = plan_of(got)
    assert plan.count("Scan ExistingRDD") == 2 and plan.count("Window [") == 1 and "Union" not in plan


def test_one_shuffle_of_the_batch_by_a_full_key(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = str(tmp_path / "a"), str(tmp_path / "b")
        spark.range(1000).selectExpr("id dedup_key", "id n").write.parquet(a)
        spark.range(10).selectExpr("id dedup_key").write.parquet(b)
        got = store.new_documents(spark.read.parquet(a), spark.read.parquet(b), "n")
        assert got.count() == 990
        assert plan_of(got).count("Exchange hashpartitioning") == 2  # the batch's and the stored side's
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insert_reads_the_partitions_of_its_batch_alone(spark, tmp_path):
    path = str(tmp_path / "prices")
    old = spark.createDataFrame([bar("A", d, m) for d in range(40) for m in (0, 5)] + [bar("A", d, interval="1d") for d in range(40)], PRICE)
    assert store.insert_prices(old, path) == 120
    before = files(spark, path)
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(len(b))
            yield b

    batch = spark.createDataFrame([bar("A", 39, 5, close=9.0), bar("A", 39, 10), bar("A", 39, 10, close=2.0), bar("A", 40)], PRICE).mapInPandas(count, PRICE)
    assert store.insert_prices(batch, path) == 2
    assert ran.value == 4  # the batch was computed once
    assert store.insert_prices(batch, path) == 0
    assert before <= files(spark, path)
    stored = spark.read.schema(spark.read.parquet(path).schema).parquet(path)
    pruned = store.partitions_of(stored, ["interval", "day"], batch.selectExpr("interval", "'2024-02-10' day").distinct().collect())
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-02-10" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.select(F.input_file_name()).distinct().count() <= 2
    assert spark.read.parquet(path).filter(f"timestamp_ms = {T0 + 39 * DAY + 300_000}").first().close == 1  # stored rows never change


def test_refresh_replaces_its_days_and_leaves_other_files(spark, tmp_path):
    root = str(tmp_path / "events")
    rows = spark.createDataFrame([(d, x) for d in ("d1", "d2", "d3") for x in (1, 2)], "day string, x int")
    assert versions.current(spark, root) == 0 and versions.read(spark, root, rows.schema).count() == 0
    assert versions.refresh(rows, root, "day") == 1
    old = versions.read(spark, root, rows.schema)
    names = held(spark, root)
    new = spark.createDataFrame([("d2", 7), ("d4", 8)], "day string, x int")
    assert versions.refresh(new, root, "day", spark.createDataFrame([("d3",)], "day string")) == 2
    got = versions.read(spark, root, rows.schema)
    assert sorted(tuple(r) for r in got.collect()) == [("d1", 1), ("d1", 2), ("d2", 7), ("d4", 8)]
    assert sorted(tuple(r) for r in old.collect()) == sorted(tuple(r) for r in rows.collect())  # a reader that began before sees its version
    now = held(spark, root)
    assert now["d1"] == names["d1"] and now["d2"] != names["d2"]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert versions.expire(spark, root) == 2 and got.count() == 4 and versions.read(spark, root, rows.schema, 2).count() == 4


def test_a_failed_refresh_shows_nothing_and_a_second_writer_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "events")
    rows = spark.createDataFrame([("d1", 1)], "day string, x int")
    versions.refresh(rows, root, "day")
    real = versions._swap

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "_swap", lost)
    with pytest.raises(RuntimeError, match="lost"):
        versions.refresh(spark.createDataFrame([("d1", 5), ("d9", 5)], "day string, x int"), root, "day")
    assert [tuple(r) for r in versions.read(spark, root, rows.schema).collect()] == [("d1", 1)]
    monkeypatch.setattr(versions, "_swap", real)
    versions.refresh(spark.createDataFrame([("d2", 2)], "day string, x int"), root, "day")
    assert sorted(tuple(r) for r in versions.read(spark, root, rows.schema).collect()) == [("d1", 1), ("d2", 2)]  # nothing of the failed one
    with pytest.raises(RuntimeError, match="no longer"):
        versions._swap(spark, root, 1, 2)


def test_refreshed_days_of_fused_events(spark, tmp_path):
    root = str(tmp_path / "fused")
    kind = "ticker string, dedup_key string, published_ms long"
    bars = spark.createDataFrame([bar("A", d) for d in range(3)], PRICE)
    some = spark.createDataFrame([("A", "n0", T0), ("A", "n2", T0 + 2 * DAY)], kind)
    more = some.unionAll(spark.createDataFrame([("A", "late0", T0), ("A", "late2", T0 + 2 * DAY)], kind))
    fusion.refresh_fused(bars, some, root, 0, ["5m"])
    schema = fusion.with_day(fusion.fuse(bars, some, intervals=["5m"])).schema
    first = held(spark, root)
    fusion.refresh_fused(bars.unionAll(spark.createDataFrame([bar("B", 1)], PRICE)), more, root, T0 + 2 * DAY, ["5m"])
    got = versions.read(spark, root, schema)
    assert sorted((r.ticker, r.day, r.news_count) for r in got.collect()) == [("A", "2024-01-02", 1), ("A", "2024-01-03", 0), ("A", "2024-01-04", 2), ("B", "2024-01-03", 0)]
    now = held(spark, root)
    assert now["2024-01-02"] == first["2024-01-02"] and now["2024-01-04"] != first["2024-01-04"]
