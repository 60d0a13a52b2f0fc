import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions import expressions as X
from tidemark.operators import articles, entities, sentiment, serving, store, universe
from tidemark.sources import readers
from tidemark.streaming import streams


def one(spark, expr_of, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(expr_of(F.col("v"))).collect()]


def test_tone_keeps_what_comes_before_the_first_bad_field(spark):
    got = one(spark, X.parse_tone, "1.2,abc,3", "1,2,3,4,5,6", "", "1,2,3,4,5,6,7.9", None)
    assert tuple(got[0]) == (1.2, None, None, None, None, None)
    assert tuple(got[1]) == (1, 2, 3, 4, 5, None) and got[2].tone_score is None and got[3].word_count == 7 and got[4].tone_score is None


def test_boilerplate(spark):
    text = " a line \n\nSTORY CONTINUES here\n  \nit was originally appeared on x\nlast"
    assert one(spark, X.strip_boilerplate, text, None, "") == ["a line\nlast", "", ""]


def test_name_suffix(spark):
    assert one(spark, X.strip_name_suffix, "quantia corp.", "ovid & co.", "acme holdings", "plain", "foods company") == ["quantia", "ovid &", "acme", "plain", "foods"]


def test_market_hours(spark):
    fri = 1_704_412_800_000  # 2024-01-05
    at = lambda h, m, s=0, d=0: fri + ((d * 24 + h) * 3600 + m * 60 + s) * 1000
    assert one(spark, X.in_market_hours, at(13, 29), at(13, 30), at(20, 0, 59), at(20, 1), at(15, 0, d=1), kind="long") == [False, True, True, False, False]


def test_published(spark):
    assert one(spark, X.parse_published, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00", "soon", "", None) == [1_704_067_200_000] * 3 + [None] * 3


def test_labels(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.1, True), (None, None, None, True), (0.1, 0.4, 0.4, True), (0.1, 0.2, 0.3, True), (None, None, None, False)], "p double, n double, u double, ok boolean")
    assert [r[0] for r in df.select(X.vendor_label(F.col("p"), F.col("n"), F.col("u"), F.col("ok"))).collect()] == ["positive", "positive", "negative", "neutral", None]
    assert one(spark, X.tone_label, 1.5, -1.5, 1.49, None, kind="double") == ["positive", "negative", "neutral", None]


def test_greedy_match_gives_each_ticker_once(spark):
    company = spark.createDataFrame([("A", "Alpha One Inc."), ("B", "Alpha Two Corp."), ("C", "Beta")], "ticker string, company_name string")
    art = spark.createDataFrame([("k", ["Alpha Group", "Alpha One", "Alpha Partners", "Gamma"])], "dedup_key string, orgs array<string>")
    got = {r.ticker: r.match_type for r in entities.org_matches(art, entities.company_lookup(company)).collect()}
    # "alpha" belongs to the last company; Alpha Group takes the first name that holds or is held, in order of ticker
    want, seen, lookup = {}, set(), {r.name: r.ticker for r in entities.company_lookup(company).orderBy("ord").collect()}
    for org in sorted(["Alpha Group", "Alpha One", "Alpha Partners", "Gamma"]):
        low = org.lower()
        if low in lookup:
            if lookup[low] not in seen:
                want[lookup[low]] = "exact"
                seen.add(lookup[low])
            continue
        for n, t in lookup.items():
            if t not in seen and (low in n or n in low):
                want[t] = "partial"
                seen.add(t)
                break
    assert got == want and len(got) >= 2


def test_strict_source(spark):
    company = spark.createDataFrame([("A", "Alpha Inc.")], "ticker string, company_name string")
    row = ("A", 1, "", "", ["A"], ["MERGER"], "k", "gdelt_historical")
    news = spark.createDataFrame([row], "ticker string, published_ms long, title string, content string, symbols_mentioned array<string>, tags array<string>, dedup_key string, source string")
    assert entities.map_articles(news, company).first().relevance == 80
    assert entities.map_articles(news, company, strict_source=True).count() == 0


def test_pages_and_records(spark):
    pages = spark.createDataFrame([("A", 0, 10), ("A", 1, 4), ("A", 2, 10), ("B", 0, 0), ("C", 0, 10), ("C", 1, 10), ("C", 2, 10)], "ticker string, page long, n long")
    assert sorted((r.ticker, r.page) for r in articles.cap_pages(pages, 10, 2).collect()) == [("A", 0), ("A", 1), ("C", 0), ("C", 1)]
    lines = spark.createDataFrame([("\t".join(["x"] * 26),), ("\t".join(["x"] * 28),)], "line string")
    assert articles.split_records(lines).count() == 1


def test_insert_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "docs")
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 5)], "dedup_key string, n int")
    empty = spark.createDataFrame([], batch.schema)
    assert store.append(store.new_documents(batch, empty, "n"), path) == 3
    stored = spark.read.parquet(path)
    assert sorted((r.dedup_key or "", r.n) for r in stored.collect()) == [("", 5), ("a", 1), ("b", 1)]
    assert store.new_documents(batch.filter("dedup_key IS NOT NULL"), stored).count() == 0
    prices = spark.createDataFrame([("A", 1, 1.23456, 2.0, 1.0, 1.5, 3)], "ticker string, timestamp_ms long, open double, high double, low double, close double, volume long")
    got = store.new_prices(prices, spark.createDataFrame([], "ticker string, timestamp_ms long, interval string")).first()
    assert str(got.open) == "1.2346" and got.interval == "1d" and got.source == "eodhd"
    store.log_run(spark, str(tmp_path / "runs"), "job", "1", 0.0, 1.5, 3)
    assert spark.read.parquet(str(tmp_path / "runs")).first().records == 3
    v = store.replace_version(batch, str(tmp_path / "versions"), 1)
    assert spark.read.parquet(v).count() == 4


def test_empty_fetch_is_an_error(spark):
    c = spark.createDataFrame([("A", "x", "y", True)], "ticker string, company_name string, sector string, is_active boolean")
    with pytest.raises(ValueError):
        universe.merge(c, c.select("ticker", "company_name", "sector").limit(0))
    assert universe.seed(spark).count() == 10


def test_scorer_plug_in(spark):
    news = spark.createDataFrame([("A", "k1", "up we go"), ("A", "k2", ""), ("A", "k3", "bad")], "ticker string, dedup_key string, title string")

    def load():
        return lambda texts: [("LABEL_POS", 0.91234) if "up" in t else None for t in texts]

    got = sentiment.score_with(news, "mine", load).collect()
    assert [(r.source_dedup_key, r.label, r.confidence, r.dedup_key) for r in got] == [("k1", "positive", 0.9123, "k1|mine")]


def test_enrich_keeps_labels(spark):
    flat = spark.createDataFrame([("k", "old"), ("j", None)], "article string, finbert_before string")
    scores = spark.createDataFrame([("k", "finbert", "new", 0.5), ("j", "finbert", "new", 0.5)], "source_dedup_key string, model string, label string, confidence double")
    assert {r.article: r.finbert_label for r in sentiment.enrich(flat, scores).collect()} == {"k": "old", "j": "new"}


def test_limits():
    with pytest.raises(ValueError):
        serving._limit(0, 10)


def test_readers(spark, tmp_path):
    (tmp_path / "eod").mkdir()
    (tmp_path / "eod" / "aapl.json").write_text(json.dumps([{"date": "2024-01-02", "open": 1.23456, "high": 2, "low": 1, "close": 1.5, "volume": 7}, {"date": "bad", "open": 1}]))
    r = readers.eod_bars(spark, str(tmp_path / "eod")).collect()
    assert len(r) == 1 and r[0].ticker == "AAPL" and r[0].timestamp_ms == 1_704_153_600_000 and str(r[0].open) == "1.2346"
    (tmp_path / "intra").mkdir()
    (tmp_path / "intra" / "MSFT.US.json").write_text(json.dumps([{"timestamp": 1704200000, "open": 1, "high": 2, "low": 1, "close": 1.5, "volume": None}, {"timestamp": 0}, {"timestamp": None}]))
    r = readers.intraday_bars(spark, str(tmp_path / "intra")).collect()
    assert [(x.ticker, x.timestamp_ms, x.volume) for x in r] == [("MSFT", 1_704_200_000_000, None)]
    (tmp_path / "news").mkdir()
    (tmp_path / "news" / "V.json").write_text(json.dumps([{"date": "2024-01-02T10:00:00+00:00", "title": "t" * 120, "content": "c", "link": "u", "symbols": ["V.US"], "tags": [], "sentiment": {"pos": 0.5}}]))
    n = readers.vendor_news(spark, str(tmp_path / "news")).first()
    assert n.dedup_key == f"2024-01-02T10:00:00+00:00|{'t' * 100}|V" and n.vendor_sentiment.pos == 0.5 and n.published_ms == 1_704_189_600_000
    (tmp_path / "zip").mkdir()
    with zipfile.ZipFile(tmp_path / "zip" / "a.gkg.csv.zip", "w") as z:
        z.writestr("a.csv", b"one\tx\r\ntwo\xff\n")
    (tmp_path / "zip" / "b.zip").write_bytes(b"broken")
    assert sorted(r.line for r in readers.zipped_record_lines(spark, str(tmp_path / "zip")).collect()) == ["one\tx", "two"]


def test_constituents(spark):
    html = '<table class="w" id="constituents"><tr><th>S</th></tr><tr><td><a>BRK.B</a></td><td>Berkshire</td><td></td><td>a</td><td>b</td><td>c</td><td>1067983</td></tr><tr><td></td><td>x</td></tr></table>'
    got = readers.constituents(spark.createDataFrame([(html,)], "html string")).collect()
    assert [tuple(r) for r in got] == [("BRK-B", "Berkshire", None, "0001067983")]


def test_stream_leaves_fused_bars_as_they_are(spark, tmp_path):
    bar = "ticker string, interval string, timestamp_ms long, open double, high double, low double, close double, volume long"
    news = "ticker string, published_ms long, dedup_key string"
    t0 = 1_704_200_100_000
    landed, target, check = (str(tmp_path / x) for x in ("landed", "fused", "check"))
    stock = [spark.createDataFrame([("A", t0, "n1")], news)]

    def run():
        streams.fuse_stream(streams.table_stream(spark, landed, spark.createDataFrame([], bar).schema), lambda: stock[0], target, check, ["5m"]).awaitTermination()

    spark.createDataFrame([("A", "5m", t0, 1.0, 1.0, 1.0, 1.0, 1)], bar).write.parquet(landed)
    run()
    stock[0] = spark.createDataFrame([("A", t0, "n1"), ("A", t0 + 1000, "n2")], news)
    spark.createDataFrame([("A", "5m", t0, 1.0, 1.0, 1.0, 1.0, 1), ("A", "5m", t0 + 300_000, 1.0, 1.0, 1.0, 1.0, 1)], bar).write.mode("append").parquet(landed)
    run()
    assert sorted((r.timestamp_ms, r.news_count) for r in spark.read.parquet(target).collect()) == [(t0, 1), (t0 + 300_000, 2)]
