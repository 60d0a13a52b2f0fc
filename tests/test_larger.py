"""Cases that larger tables have and the smallest ones don't."""

import shutil
from pathlib import Path

import pandas as pd
import pytest

from conftest import SMALL, normal
from tidemark.plans.oracles import ORACLE
from tidemark.plans.queries import QUERIES

START = pd.Timestamp("2024-01-01 00:01:11")


@pytest.fixture
def equals_sql(spark, tmp_path):
    """A query over the smallest tables with events (event_id, seconds from the start, event_type, k) of one's own, compared with its SQL."""
    import duckdb

    def check(name, events):
        for p in Path(SMALL).glob("*.parquet"):
            shutil.copyfile(p, tmp_path / p.name)
        ids, seconds, kinds, ks = zip(*events, strict=True)
        own = pd.DataFrame({
            "event_id": ids, "ts": [START + pd.Timedelta(seconds=s) for s in seconds], "user_id": [i % 3 for i in ids], "event_type": kinds, "value": [i % 10 + 0.5 for i in ids],
            "props": [f'{{"k": {k}}}' for k in ks],
        }).astype({"ts": "datetime64[us]"})
        own.to_parquet(tmp_path / "events.parquet")
        df = QUERIES[name](spark, str(tmp_path))
        got = normal([tuple(r) for r in df.collect()], df.columns)
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for p in tmp_path.glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
        cur = con.execute(ORACLE[name])
        want = normal(cur.fetchall(), [c[0] for c in cur.description])
        assert got == want
        return got

    return check


def test_a_quoted_field_is_no_url(equals_sql):
    """Lines 1575 and 11025 have no url and a quoted field; they make no article."""
    equals_sql("gkg_archives", [(i, i, "error", 0) for i in (1575, 1576, 1581, 11025, 11026)])


def test_the_bar_that_the_first_event_lies_in_comes_out(equals_sql):
    got = equals_sql("stream_pairs", [(i, 40 * i, "view" if i % 2 else "click", i % 9) for i in range(1, 40)])
    assert got


def test_percentiles_are_not_kept_for_each_article(spark):
    plan = QUERIES["audit_sketches"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "percentile_approx" in line and "dedup_key" in line.split("functions=")[0]]


def test_contents_are_read_before_articles_are_shuffled(spark):
    plan = QUERIES["entity_orgs"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()  # from the result down to the tables
    window = min(i for i, line in enumerate(plan) if "row_number" in line)
    assert min(i for i, line in enumerate(plan) if "regexp_extract_all" in line) > window


def test_landed_lines_hold_one_row(spark, tmp_path, monkeypatch):
    from tidemark.plans import queries

    monkeypatch.setattr(queries, "shared_path", lambda spark, what: str(tmp_path / what))
    n = QUERIES["source_vendor_news"](spark, SMALL).count()
    assert spark.read.text(str(tmp_path / "vendor")).count() == n > 0
