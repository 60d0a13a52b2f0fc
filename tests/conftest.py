import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import os

    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"
    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(float(r[i])) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    def check(f, sql):
        df = f(spark, SMALL)
        cur = duck.execute(sql)
        want = normal(cur.fetchall(), names := [c[0] for c in cur.description])
        assert sorted(df.columns) == sorted(names)
        assert normal([tuple(r) for r in df.collect()], df.columns) == want

    return check
