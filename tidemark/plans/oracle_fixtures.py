"""DuckDB SQL of the domain tables of ``fixtures``, as common table expressions."""

VIEWS = {
    "fx_company": r"""
SELECT * FROM (VALUES
 ('T00','Northwind Metals Inc.','Materials',TRUE), ('T01','Harbor Freight Systems Corporation','Industrials',TRUE),
 ('T02','Quantia Corp.','Technology',TRUE),        ('T03','Bluepeak Energy Holdings','Energy',TRUE),
 ('T04','Harbor Mutual Group','Financials',TRUE),  ('T05','Celestra Foods Company','Staples',TRUE),
 ('T06','Ovid & Co.','Communication',TRUE),        ('T07','Merrow Therapeutics Ltd.','Health Care',TRUE),
 ('T08','Pinecrest Homes plc','Real Estate',TRUE), ('T09','Zephyr Airlines Inc','Industrials',FALSE),
 ('T10','Unpriced Utilities Limited','Utilities',TRUE)
) t(ticker, company_name, sector, is_active)""",
    "fx_event": r"""
SELECT event_id, 'T' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS ticker, event_type, value,
       epoch_ms(date_trunc('second', ts)) AS ms,
       CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events""",
    "fx_price": r"""
WITH b AS (
  SELECT ticker, '5m' AS "interval", (ms // 300000) * 300000 AS timestamp_ms, * EXCLUDE (ticker) FROM fx_event
  WHERE event_type IN ('view','purchase')
  UNION ALL
  SELECT ticker, '1d', (ms // 86400000) * 86400000, * EXCLUDE (ticker) FROM fx_event
  WHERE event_type IN ('view','purchase'))
SELECT ticker, "interval", timestamp_ms,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low, max_by(value, event_id) AS close,
       CASE WHEN max(event_id) % 70 = 0 THEN NULL ELSE count(*) END AS volume
FROM b GROUP BY ALL""",
    "fx_news": r"""
SELECT e.ticker, e.ms AS published_ms, e.event_id, e.k,
       CASE WHEN e.event_type = 'error' THEN 'gdelt' ELSE 'eodhd' END AS source,
       CASE WHEN e.event_type = 'error' THEN ''
            WHEN e.event_id % 3 = 0 THEN c.company_name || ' ' || left(d.text, 40)
            ELSE left(split_part(d.text, chr(10), 1), 100) END AS title,
       CASE WHEN e.event_type = 'error' THEN ''
            WHEN e.event_id % 4 = 0 THEN d.text || chr(10) || 'VIEW COMMENTS about ' || c.company_name
            WHEN e.event_id % 4 = 1 THEN d.text || chr(10) || 'Shares of ' || c.company_name || ' moved.'
            ELSE d.text END AS content,
       [e.ticker || '.US', c.ticker] AS symbols_mentioned,
       CASE WHEN e.event_type = 'error' THEN list_slice(['ECON_INFLATION','ECON_TRADE','MERGER'], 1, e.k % 4) ELSE ['news'] END AS tags,
       CASE WHEN e.event_type = 'error' OR e.k % 11 = 0 THEN NULL
            ELSE {'pos': (e.k % 7) / 10.0, 'neg': (e.k % 5) / 10.0, 'neu': (e.k % 3) / 10.0} END AS vendor_sentiment,
       CASE WHEN e.event_type = 'error' THEN (e.k % 13) / 2.0 - 3 END AS tone_score,
       'N|' || e.event_id || '|' || e.ticker AS dedup_key,
       CASE WHEN e.event_type = 'error' THEN 'http://n.example/' || e.ticker || '/' || e.k ELSE 'https://WWW.N.example/' || e.ticker || '/' || e.k || '/?ref=' || e.event_id END AS url
FROM fx_event e
JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
JOIN fx_company c ON c.ticker = 'T' || lpad(CAST(e.k % 10 AS VARCHAR), 2, '0')
WHERE e.event_type IN ('click','signup','error')""",
    "fx_score": r"""
SELECT dedup_key AS source_dedup_key, ticker, model, dedup_key || '|' || model AS dedup_key,
       ['positive','negative','neutral'][1 + CAST((event_id * m + k) % 3 AS INT)] AS label,
       round(0.4 + ((event_id * m) % 61) / 100.0, 4) AS confidence, published_ms + (event_id * m) % 1000 * 60000 AS scored_ms
FROM fx_news, (VALUES ('finbert', 7), ('roberta', 11)) t(model, m)
WHERE title <> '' AND event_id % 9 <> 0""",
    "fx_gkg_line": r"""
SELECT event_id AS line_no,
       concat_ws(chr(9), 'G' || event_id,
         CASE WHEN event_id % 50 = 0 THEN 'bad' ELSE strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S') END,
         '1', 'pub' || (k % 5) || '.example', CASE WHEN event_id % 45 = 0 THEN '' ELSE 'http://e.example/' || event_id END,
         '', '', CASE k % 3 WHEN 0 THEN 'TAX_X;ECON_TRADE;MERGER;' WHEN 1 THEN 'ECON_INFLATION' ELSE 'TAX_X;' END,
         '', '', '', '', '', CASE k % 4 WHEN 0 THEN 'Northwind Metals; quantia corp' WHEN 1 THEN 'zephyr airlines inc;Zephyr Airlines' WHEN 2 THEN 'unknown org' ELSE 'Merrow Therapeutics' END,
         '', CASE WHEN event_id % 40 = 0 THEN '1.5,abc,2' ELSE (k / 10.0) || ',2.5,1.25,3.75,10.5,0.5,' || (100 + k) || '.0' END)
       || CASE WHEN event_id % 60 = 0 THEN '' ELSE repeat(chr(9), 11) END AS line
FROM fx_event WHERE event_type = 'error'""",
}

PREFIX = "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items())
