"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from tidemark.config import BOILERPLATE_PHRASES, FINANCIAL_THEMES, FUSION_WINDOWS, LEGAL_FORM, LEGAL_FORM_LOOKUP, NAME_SUFFIXES, ORG_SPAN
from tidemark.operators.sentiment import NEGATIVE, POSITIVE
from tidemark.plans.oracle_fixtures import PREFIX


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_WIN = ", ".join(f"('{k}', {a}, {b})" for k, (a, b) in FUSION_WINDOWS.items())
_PHRASES = "(?i)" + "|".join(p.replace(".", r"\.") for p in BOILERPLATE_PHRASES)
_THEMES = ", ".join(map(_text, FINANCIAL_THEMES))
_CUT = "CASE " + " ".join(f"WHEN ends_with(full_, '{s}') THEN left(full_, length(full_) - {len(s)})" for s in NAME_SUFFIXES) + " ELSE full_ END"

# Common table expressions that queries are put together from.
PARTS = {
    "win": f"SELECT * FROM (VALUES {_WIN}) t(iv, back, ahead)",
    "bars": """SELECT p.*, CASE WHEN p."interval" = '1d' THEN (timestamp_ms // 86400000) * 86400000 + 72000000 ELSE timestamp_ms END AS ref_ms, back, ahead
FROM fx_price p JOIN win ON iv = p."interval" """,
    "pairs": """SELECT b.ticker, b."interval", b.timestamp_ms, n.dedup_key, n.published_ms, n.published_ms - ref_ms AS offset_ms, round((n.published_ms - ref_ms) / 60000.0, 2) AS offset_min
FROM bars b JOIN fx_news n ON b.ticker = n.ticker AND n.published_ms BETWEEN ref_ms - back * 60000 AND ref_ms + ahead * 60000""",
    "topk": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, "interval", timestamp_ms ORDER BY abs(offset_ms), published_ms, dedup_key) AS rank FROM pairs) WHERE rank <= 10""",
    "fused": """SELECT p.ticker, p."interval", p.timestamp_ms, coalesce(c.n, 0)::INT AS news_count
FROM fx_price p LEFT JOIN (SELECT ticker, "interval", timestamp_ms, count(*) AS n FROM topk GROUP BY ALL) c USING (ticker, "interval", timestamp_ms)""",
    "flat": """SELECT f.*, t.rank::INT AS rank, t.dedup_key AS article, t.offset_min FROM fused f LEFT JOIN topk t USING (ticker, "interval", timestamp_ms)""",
    "fused_src": """SELECT f.ticker, f."interval", f.timestamp_ms, coalesce(bool_or(n.source = 'gdelt'), FALSE) AS open_, coalesce(bool_or(n.source = 'eodhd'), FALSE) AS vendor_
FROM flat f LEFT JOIN fx_news n ON n.dedup_key = f.article GROUP BY ALL""",
    # companies out of customers and suppliers
    "uni": """SELECT 'C' || c_custkey AS ticker, regexp_replace(c_name, '#0*', ' ') || [' Inc.', ' Corp', ' Holdings', ' & Co.', ''][c_custkey % 5 + 1] AS company_name, c_mktsegment AS sector, lpad(c_custkey::VARCHAR, 10, '0') AS cik,
c_custkey % 7 <> 0 AS is_active, CASE WHEN c_custkey % 7 = 0 THEN 1600000000000 + c_custkey * 1000 END AS removed_ms, c_custkey AS k FROM customer""",
    "got": """SELECT ticker, company_name || CASE WHEN k % 11 = 0 THEN ' New' ELSE '' END AS company_name, sector, CASE WHEN k % 13 <> 0 THEN cik END AS cik FROM uni WHERE k % 5 <> 0
UNION ALL SELECT 'S' || s_suppkey, s_name, 'SUPPLY', lpad(s_suppkey::VARCHAR, 10, '0') FROM supplier""",
    "merged": """SELECT coalesce(s.ticker, f.ticker) AS ticker, CASE WHEN f.ticker IS NOT NULL THEN f.company_name ELSE s.company_name END AS company_name,
CASE WHEN f.ticker IS NOT NULL THEN f.sector ELSE s.sector END AS sector,
CASE WHEN f.ticker IS NOT NULL THEN f.cik ELSE s.cik END AS cik, f.ticker IS NOT NULL AS is_active,
CASE WHEN f.ticker IS NOT NULL THEN NULL WHEN s.is_active THEN 1704067200000 ELSE s.removed_ms END AS removed_ms,
CASE WHEN s.ticker IS NULL THEN 'added' WHEN f.ticker IS NOT NULL AND NOT s.is_active THEN 'reactivated'
     WHEN f.ticker IS NOT NULL AND (s.company_name IS DISTINCT FROM f.company_name OR s.sector IS DISTINCT FROM f.sector OR s.cik IS DISTINCT FROM f.cik) THEN 'updated'
     WHEN f.ticker IS NOT NULL THEN 'unchanged' WHEN s.is_active THEN 'deactivated' ELSE 'inactive' END AS status
FROM uni s FULL JOIN got f ON s.ticker = f.ticker""",
    # records
    "names_of": f"""SELECT name, arg_min(ticker, ticker || '#' || no) AS ticker FROM (
  SELECT ticker, unnest([0, 1]) AS no, unnest([full_, trim({_CUT}, ' .,')]) AS name FROM (SELECT ticker, lower(trim(company_name)) AS full_ FROM SRC))
WHERE name <> '' AND (length(name) >= 3 OR no = 0) GROUP BY name""",
    "rec": """SELECT f[1] AS record_id, f[2] AS date, f[4] AS publisher, f[5] AS url, f[8] AS themes, f[14] AS orgs, f[16] AS tone
FROM (SELECT string_split(line, chr(9)) AS f FROM fx_gkg_line) WHERE len(f) >= 27""",
    "rec_t": f"""SELECT *, list_sort(list_distinct(list_filter(string_split(themes, ';'), lambda x: x IN ({_THEMES})))) AS tags FROM rec""",
    "rec_o": """SELECT r.record_id, list_sort(list(DISTINCT n.ticker)) AS tickers FROM (SELECT record_id, lower(trim(unnest(string_split(orgs, ';')))) AS name FROM rec_t WHERE len(tags) > 0) r JOIN names n USING (name) GROUP BY 1""",
    "arts": """SELECT r.*, o.tickers, unnest(o.tickers) AS ticker, epoch_ms(try_strptime(date, '%Y%m%d%H%M%S')) AS published_ms
FROM rec_t r JOIN rec_o o USING (record_id) WHERE url <> '' AND date <> '' AND record_id <> '' AND try_strptime(date, '%Y%m%d%H%M%S') IS NOT NULL""",
    # entities
    "lookup_of": f"""SELECT name, ticker, ticker || '#' || kind AS ord FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY ticker DESC, kind DESC) AS n FROM (
    SELECT ticker, unnest([0, 1, 2, 3]) AS kind, lower(unnest([company_name, cut, CASE WHEN length(string_split(cut, ' ')[1]) > 3 THEN string_split(cut, ' ')[1] END, ticker])) AS name
    FROM (SELECT upper(ticker) AS ticker, company_name, trim(regexp_replace(company_name, '{LEGAL_FORM_LOOKUP}', '')) AS cut FROM SRC WHERE company_name <> ''))
  WHERE name IS NOT NULL AND name <> '') WHERE n = 1""",
    "vend": r"""SELECT *, array_to_string(list_filter(list_transform(string_split(content, chr(10)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '' AND NOT regexp_matches(p, PHRASES)), chr(10)) AS clean
FROM fx_news WHERE source = 'eodhd'""".replace("PHRASES", _text(_PHRASES)),
    "orgs": f"""SELECT *, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(title || chr(10) || chr(10) || clean, '{ORG_SPAN}'), lambda s: trim(regexp_replace(s, '{LEGAL_FORM}', ''))), lambda s: length(s) >= 2))) AS orgs FROM vend""",
    "org1": "SELECT dedup_key, org FROM (SELECT dedup_key, unnest(orgs) AS org FROM orgs)",
    "cand": """SELECT org, max(CASE WHEN lower(org) = name THEN ticker END) AS exact, list(ticker ORDER BY ord) AS partial
FROM (SELECT DISTINCT org FROM org1) JOIN lookup ON contains(name, lower(org)) OR contains(lower(org), name) GROUP BY org""",
    "step": "SELECT dedup_key, org, exact, partial, row_number() OVER (PARTITION BY dedup_key ORDER BY org) AS i FROM org1 JOIN cand USING (org)",
    "fold": """SELECT DISTINCT dedup_key, 0::BIGINT AS i, []::VARCHAR[] AS seen, []::VARCHAR[] AS kinds FROM step
UNION ALL SELECT f.dedup_key, s.i,
  CASE WHEN s.exact IS NOT NULL THEN CASE WHEN list_contains(f.seen, s.exact) THEN f.seen ELSE list_append(f.seen, s.exact) END
       WHEN len(list_filter(s.partial, lambda t: NOT list_contains(f.seen, t))) > 0 THEN list_append(f.seen, list_filter(s.partial, lambda t: NOT list_contains(f.seen, t))[1]) ELSE f.seen END,
  CASE WHEN s.exact IS NOT NULL THEN CASE WHEN list_contains(f.seen, s.exact) THEN f.kinds ELSE list_append(f.kinds, 'exact') END
       WHEN len(list_filter(s.partial, lambda t: NOT list_contains(f.seen, t))) > 0 THEN list_append(f.kinds, 'partial') ELSE f.kinds END
FROM fold f JOIN step s ON s.dedup_key = f.dedup_key AND s.i = f.i + 1""",
    "matches": "SELECT dedup_key, unnest(seen) AS ticker, unnest(kinds) AS match_type FROM (SELECT dedup_key, arg_max(seen, i) AS seen, arg_max(kinds, i) AS kinds FROM fold GROUP BY 1)",
    "tag": "SELECT DISTINCT dedup_key, upper(replace(s, '.US', '')) AS ticker FROM (SELECT dedup_key, unnest(symbols_mentioned) AS s FROM vend) WHERE upper(replace(s, '.US', '')) IN (SELECT ticker FROM lookup)",
    "map_v": """SELECT * FROM (SELECT c.dedup_key, c.ticker,
  CASE WHEN contains(lower(v.title), lower(c.ticker)) OR EXISTS (SELECT 1 FROM lookup l WHERE l.ticker = c.ticker AND contains(lower(v.title), l.name)) THEN 50 ELSE 0 END
  + CASE WHEN m.ticker IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN g.ticker IS NOT NULL THEN 20 ELSE 0 END AS relevance, coalesce(m.match_type, 'tag_only') AS match_type
FROM (SELECT dedup_key, ticker FROM matches UNION SELECT * FROM tag) c JOIN vend v USING (dedup_key) LEFT JOIN matches m ON m.dedup_key = c.dedup_key AND m.ticker = c.ticker LEFT JOIN tag g ON g.dedup_key = c.dedup_key AND g.ticker = c.ticker)
WHERE relevance >= 30""",
    "map_o": """SELECT DISTINCT dedup_key, upper(replace(s, '.US', '')) AS ticker, relevance, 'gdelt_pretagged' AS match_type FROM (
  SELECT dedup_key, least(100, 70 + 10 * len(tags))::INT AS relevance, unnest(symbols_mentioned) AS s FROM fx_news WHERE source = 'gdelt') WHERE upper(replace(s, '.US', '')) IN (SELECT ticker FROM lookup)""",
    "mapping": "SELECT * FROM map_v UNION ALL SELECT * FROM map_o",
    # sentiment
    "lab": """SELECT *, CASE WHEN vendor_sentiment IS NULL THEN NULL WHEN vendor_sentiment.pos >= vendor_sentiment.neg AND vendor_sentiment.pos >= vendor_sentiment.neu THEN 'positive'
  WHEN vendor_sentiment.neg >= vendor_sentiment.neu THEN 'negative' ELSE 'neutral' END AS vendor,
  CASE WHEN tone_score >= 1.5 THEN 'positive' WHEN tone_score <= -1.5 THEN 'negative' WHEN tone_score IS NOT NULL THEN 'neutral' END AS open FROM fx_news""",
    "cmp": "SELECT s.*, l.vendor, l.open, coalesce(s.label = l.vendor, FALSE) AS vendor_agrees, coalesce(s.label = l.open, FALSE) AS open_agrees FROM fx_score s LEFT JOIN lab l ON l.dedup_key = s.source_dedup_key",
    "bym": "SELECT source_dedup_key, max(CASE WHEN model = 'finbert' THEN label END) AS finbert, max(CASE WHEN model = 'roberta' THEN label END) AS roberta FROM fx_score GROUP BY 1",
    "lex": r"""SELECT *, len(list_filter(w, lambda x: x IN ('the', 'la', 'und', 'of'))) AS p, len(list_filter(w, lambda x: x IN ('and', 'de', 'der', 'to'))) AS n FROM (
  SELECT ticker, dedup_key, string_split_regex(lower(left(title, 512)), '[^\p{L}]+') AS w FROM fx_news WHERE title <> '')""",
    "lex0": r"""SELECT ticker, dedup_key, string_split_regex(lower(left(title, 512)), '[^\p{L}]+') AS w FROM fx_news WHERE title <> ''""",
    "batch": """SELECT ticker, event_id, CASE WHEN event_id % 10 <> 0 THEN dedup_key END AS dedup_key FROM fx_news""",
}
# the fusion of two thirds of the news
_OLD = {"FROM pairs": "FROM pairs_old", "FROM topk": "FROM topk_old", "JOIN topk": "JOIN topk_old", "FROM fused": "FROM fused_old", "JOIN fx_news n": "JOIN (SELECT * FROM fx_news WHERE event_id % 3 <> 0) n"}
for _part in ("pairs", "topk", "fused", "flat"):
    _body = PARTS[_part]
    for _of, _to in _OLD.items():
        _body = _body.replace(_of, _to)
    PARTS[f"{_part}_old"] = _body
_FUSION = ["win", "bars", "pairs", "topk"]
_EVENTS = [*_FUSION, "fused"]
_UNI = ["uni", "got", "merged"]
_ENT = ["lookup", "vend", "orgs", "org1", "cand", "step", "fold", "matches", "tag", "map_v", "map_o", "mapping"]
_REC = ["names", "rec", "rec_t", "rec_o"]


def _sql(body: str, *parts: str) -> str:
    own = {"names": PARTS["names_of"].replace("SRC", "fx_company"), "lookup": PARTS["lookup_of"].replace("SRC", "fx_company"), **PARTS}
    return PREFIX + "".join(f",\n{p} AS ({own[p]})" for p in parts) + "\n" + body


_TIERS = "CASE WHEN news_count < 1 THEN '[0,1)' WHEN news_count < 3 THEN '[1,3)' WHEN news_count < 10 THEN '[3,10)' WHEN news_count < 999 THEN '[10,999)' ELSE 'other' END"
_MODAL = "CASE WHEN p >= u AND p >= n THEN 'positive' WHEN u >= n THEN 'neutral' ELSE 'negative' END"
_PRICES = "SELECT * FROM fx_price UNION ALL SELECT * FROM fx_price WHERE timestamp_ms % 600000 = 0"
_BARS = """SELECT ticker, "interval", timestamp_ms, round(open * 100)::BIGINT AS open, round(high * 100)::BIGINT AS high, round(low * 100)::BIGINT AS low, round(close * 100)::BIGINT AS close, volume, '{source}' AS source
FROM fx_price WHERE {where}"""
_NUM = lambda i: f"try_cast(t[{i}] AS DOUBLE)"
_BAD = lambda i: f"(t[{i}] <> '' AND {_NUM(i)} IS NULL)"


def _tone(i: int, name: str, kind: str = "DOUBLE") -> str:
    bad = " OR ".join(f"coalesce({_BAD(k)}, FALSE)" for k in range(1, i + 1) if k != 6)
    return f"CASE WHEN NOT ({bad}) THEN trunc({_NUM(i)})::INT END AS {name}" if kind == "INT" else f"CASE WHEN NOT ({bad}) THEN {_NUM(i)} END AS {name}"


ORACLE = {
    "fusion_pairs_5m": _sql("SELECT ticker, timestamp_ms, dedup_key, offset_min FROM pairs WHERE \"interval\" = '5m'", "win", "bars", "pairs"),
    "fusion_pairs_1d": _sql("SELECT ticker, timestamp_ms, dedup_key, offset_min FROM pairs WHERE \"interval\" = '1d'", "win", "bars", "pairs"),
    "fusion_topk": _sql('SELECT ticker, "interval", timestamp_ms, rank::INT AS rank, dedup_key, offset_min FROM topk', *_FUSION),
    "fusion_events_flat": _sql("SELECT * FROM flat", *_EVENTS, "flat"),
    "fusion_counts": _sql('SELECT "interval", news_count, count(*) AS events FROM fused GROUP BY ALL', *_EVENTS),
    "fusion_stats": _sql("SELECT count(DISTINCT ticker) AS tickers, count(*) AS events, count(*) FILTER (news_count > 0) AS events_with_news, sum(news_count)::BIGINT AS attached, max(news_count) AS most FROM fused", *_EVENTS),
    "fusion_filtered": _sql("""SELECT ticker, "interval", timestamp_ms, rank::INT AS rank, dedup_key FROM (SELECT p.*, row_number() OVER (PARTITION BY p.ticker, p."interval", p.timestamp_ms ORDER BY abs(offset_ms), published_ms, dedup_key) AS rank
FROM pairs p WHERE (p.dedup_key, p.ticker) IN (SELECT (dedup_key, ticker) FROM mapping)) WHERE rank <= 10""", *_ENT, "win", "bars", "pairs"),
    "fusion_pool": _sql("SELECT ticker, dedup_key, FALSE AS is_foreign FROM fx_news UNION ALL SELECT m.ticker, m.dedup_key, TRUE FROM mapping m JOIN fx_news n USING (dedup_key) WHERE m.ticker <> n.ticker", *_ENT),
    "fusion_incremental": _sql("SELECT * FROM flat WHERE timestamp_ms % 1200000 <> 0", *_EVENTS, "flat"),
    "fusion_refresh": _sql("SELECT * FROM flat WHERE timestamp_ms % 1200000 <> 0 OR timestamp_ms >= (SELECT max(timestamp_ms) - 86400000 FROM fx_price)", *_EVENTS, "flat"),
    "fusion_refresh_table": _sql("""SELECT * FROM flat WHERE timestamp_ms % 1500000 = 0 OR timestamp_ms >= (SELECT max(timestamp_ms) // 86400000 * 86400000 - 172800000 FROM fx_price)
UNION ALL SELECT * FROM flat_old WHERE timestamp_ms % 1500000 <> 0 AND timestamp_ms < (SELECT max(timestamp_ms) // 86400000 * 86400000 - 172800000 FROM fx_price)""", *_EVENTS, "flat", "pairs_old", "topk_old", "fused_old", "flat_old"),
    "store_insert_partitioned": _sql(_BARS.format(where="TRUE", source="eodhd")),
    "fusion_asof": _sql("""SELECT b.ticker, b."interval", b.timestamp_ms, n.dedup_key, b.ref_ms - n.published_ms AS age_ms FROM bars b ASOF LEFT JOIN (
SELECT ticker, published_ms, max(dedup_key) AS dedup_key FROM fx_news GROUP BY ALL) n ON b.ticker = n.ticker AND b.ref_ms >= n.published_ms""", "win", "bars"),
    "audit_sketches": _sql("SELECT source, count(*) AS n, count(DISTINCT dedup_key) AS exact, TRUE AS within_2_pct, TRUE AS middle_holds FROM fx_news GROUP BY source"),
    "stream_sessions": _sql("""SELECT ticker, min(published_ms) AS start_ms, max(published_ms) AS last_ms, count(*) AS articles FROM (
SELECT *, sum(CASE WHEN published_ms - before <= 7200000 THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY published_ms, dedup_key) AS run
FROM (SELECT *, lag(published_ms) OVER (PARTITION BY ticker ORDER BY published_ms, dedup_key) AS before FROM fx_news)) GROUP BY ticker, run"""),
    "store_insert_prices": _sql("""SELECT ticker, "interval", timestamp_ms, round(open * 100)::BIGINT AS open, round(high * 100)::BIGINT AS high, round(low * 100)::BIGINT AS low, round(close * 100)::BIGINT AS close, volume, 'eodhd' AS source
FROM fx_price WHERE timestamp_ms % 900000 <> 0"""),
    "store_insert_documents": _sql("""SELECT ticker, event_id, dedup_key FROM batch WHERE dedup_key IS NOT NULL AND event_id % 3 <> 0
UNION ALL (SELECT * FROM batch WHERE dedup_key IS NULL UNION ALL SELECT * FROM batch WHERE dedup_key IS NULL)""", "batch"),
    "store_dup_keys": _sql(f'SELECT ticker, timestamp_ms, "interval", count(*) AS n FROM ({_PRICES}) GROUP BY ALL HAVING count(*) > 1'),
    "store_delta": _sql("SELECT dedup_key, ticker, published_ms FROM fx_news WHERE event_id % 5 = 0"),
    "store_resume": _sql("SELECT event_id, ticker, ms FROM fx_event WHERE event_id % 4 = 1"),
    "universe_merge": _sql("SELECT * FROM merged", *_UNI),
    "universe_report": _sql("SELECT ticker, status FROM merged UNION ALL SELECT ticker, 'missing' FROM merged WHERE status IN ('deactivated', 'inactive')", *_UNI),
    "universe_active": _sql("SELECT ticker, company_name, sector FROM merged WHERE is_active", *_UNI),
    "universe_only": _sql("SELECT t.ticker, u.company_name, u.sector FROM (VALUES ('C1'), ('C2'), ('C7'), ('NONE')) t(ticker) LEFT JOIN uni u USING (ticker)", "uni"),
    "universe_membership_counts": _sql("SELECT count(*) AS total, count(*) FILTER (is_active) AS active, count(*) FILTER (NOT is_active) AS inactive FROM merged", *_UNI),
    "gkg_articles": _sql("SELECT 'gdelt|' || record_id || '|' || ticker AS dedup_key, ticker, published_ms, url, publisher, array_to_string(tickers, ',') AS symbols, array_to_string(tags, ',') AS tags FROM arts", *_REC, "arts"),
    "gkg_historical": _sql("""SELECT 'gdelt_historical' AS source, substr(record_id, 2)::BIGINT % 60 AS snapshot, count(*) AS articles, min(published_ms) AS first_ms
FROM arts WHERE record_id NOT LIKE '%0' GROUP BY ALL""", *_REC, "arts"),
    "gkg_archives": _sql("""SELECT lpad(f.k::VARCHAR, 8, '0') || '.gkg.csv.zip' AS file, CASE WHEN f.k % 12 IN (3, 7) THEN 0 ELSE f.records END AS records, CASE WHEN f.k % 12 IN (3, 7) THEN 0 ELSE f."full" END AS "full",
CASE WHEN f.k % 12 IN (3, 7) THEN 0 ELSE coalesce(a.n, 0) END AS articles, f.k % 12 IN (3, 7) AS skipped
FROM (SELECT line_no // 250 AS k, count(*) AS records, count(*) FILTER (len(string_split(line, chr(9))) >= 27) AS "full" FROM fx_gkg_line GROUP BY 1) f
LEFT JOIN (SELECT substr(record_id, 2)::BIGINT // 250 AS k, count(*) AS n FROM arts WHERE substr(record_id, 2)::BIGINT % 5 <> 0 GROUP BY 1) a USING (k)""", *_REC, "arts"),
    "stream_archives": _sql("""SELECT 'gdelt|' || record_id || '|' || ticker AS dedup_key, lpad((substr(record_id, 2)::BIGINT // 250)::VARCHAR, 8, '0') || '.gkg.csv.zip' AS file, published_ms, array_to_string(tickers, ',') AS symbols
FROM arts WHERE substr(record_id, 2)::BIGINT // 250 % 12 NOT IN (3, 7)""", *_REC, "arts"),
    "gkg_counters": _sql("""SELECT count(*) AS seen, count(*) FILTER (len(tags) > 0) AS with_theme, count(*) FILTER (len(tickers) > 0) AS with_org, (SELECT count(*) FROM arts) AS articles
FROM rec_t LEFT JOIN rec_o USING (record_id) WHERE url <> '' AND date <> '' AND record_id <> ''""", *_REC, "arts"),
    "gkg_tone": _sql(f"""SELECT 'gdelt|' || record_id || '|' || ticker AS dedup_key, {_tone(1, 'tone_score')}, {_tone(2, 'positive')}, {_tone(3, 'negative')}, {_tone(4, 'polarity')}, {_tone(5, 'activity_ref_density')}, {_tone(7, 'word_count', 'INT')}
FROM (SELECT record_id, ticker, string_split(tone, ',') AS t FROM arts)""", *_REC, "arts"),
    "gkg_org_map": _sql("SELECT * FROM (" + PARTS["names_of"].replace("SRC", "uni") + ")", "uni"),
    "gkg_themes": _sql("SELECT record_id, array_to_string(tags, ',') AS tags, coalesce(array_to_string(tickers, ','), '') AS tickers FROM rec_t LEFT JOIN rec_o USING (record_id)", *_REC),
    "gkg_list_snapshots": _sql("""SELECT event_id AS line_no, strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S') AS stamp, 'http://g.example/' || strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S') || '.gkg.csv.zip' AS url
FROM fx_event WHERE event_id % 3 = 0 AND strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S') BETWEEN '20240102000000' AND '20240120000000' ORDER BY stamp, line_no LIMIT 500"""),
    "gkg_latest_snapshot": _sql("SELECT arg_min('http://g.example/' || strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S') || '.gkg.csv.zip', event_id) AS url FROM fx_event WHERE event_id % 3 = 0"),
    "news_page_cap": _sql("""SELECT ticker, page, n FROM (SELECT *, coalesce(sum(CASE WHEN n < s THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS short, row_number() OVER (PARTITION BY ticker ORDER BY page) AS no
FROM (SELECT ticker, ms // 86400000 AS page, count(*) AS n FROM fx_event GROUP BY ALL), (SELECT quantile_disc(n, 0.1) AS s FROM (SELECT count(*) AS n FROM fx_event GROUP BY ticker, ms // 86400000)))
WHERE short = 0 AND no <= 20 AND n > 0"""),
    "news_published": _sql("SELECT event_id, CASE event_id % 4 WHEN 0 THEN ms WHEN 1 THEN ms - 7200000 END AS published_ms FROM fx_event"),
    "news_strip_boilerplate": _sql("SELECT dedup_key, clean FROM vend UNION ALL SELECT dedup_key, '' FROM fx_news WHERE source = 'gdelt'", "vend"),
    "entity_lookup": _sql("SELECT name, ticker FROM (" + PARTS["lookup_of"].replace("SRC", "uni") + ")", "uni"),
    "entity_orgs": _sql("SELECT dedup_key, array_to_string(orgs, ';') AS orgs FROM orgs", "vend", "orgs"),
    "entity_matches": _sql("SELECT * FROM matches", *_ENT[:8]),
    "entity_gkg": _sql("SELECT * FROM map_o", "lookup", "map_o"),
    "entity_mapping": _sql("SELECT * FROM mapping", *_ENT),
    "entity_target": _sql("SELECT * FROM mapping WHERE ticker = 'T04'", *_ENT),
    "entity_stats": _sql("SELECT count(*) AS associations, count(DISTINCT dedup_key) AS articles, count(DISTINCT ticker) AS tickers FROM mapping", *_ENT),
    "sent_unscored": _sql("SELECT dedup_key, ticker, source FROM fx_news WHERE dedup_key NOT IN (SELECT source_dedup_key FROM fx_score WHERE model = 'finbert')"),
    "sent_lexicon": _sql("""SELECT dedup_key || chr(124) || m AS dedup_key, ticker, m AS model, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label,
round(round(0.5 + abs(p - n) / (2.0 * (p + n + 1)), 4) * 10000)::BIGINT AS confidence FROM lex, (VALUES ('finbert'), ('roberta')) t(m)""", "lex"),
    "sent_store": _sql("""SELECT dedup_key || '|' || m AS dedup_key, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label FROM lex, (VALUES ('finbert'), ('roberta')) t(m)
WHERE dedup_key || '|' || m NOT IN (SELECT dedup_key FROM fx_score)""", "lex"),
    "sent_vendor_label": _sql("SELECT dedup_key, vendor AS label FROM lab", "lab"),
    "sent_tone_label": _sql("SELECT dedup_key, open AS label FROM lab", "lab"),
    "sent_compare": _sql("SELECT dedup_key, label, vendor, vendor_agrees, open_agrees FROM cmp", "lab", "cmp"),
    "sent_four_way": _sql(f"""SELECT dedup_key, finbert, roberta, vendor, open, len(a) > 1 AND len(list_distinct(a)) = 1 AS all_agree, coalesce(finbert = roberta, FALSE) AS transformers_agree, coalesce(vendor = open, FALSE) AS commercial_vs_open_agree,
CASE WHEN p + u + n > 0 THEN {_MODAL} END AS modal_label, p::INT AS n_positive, u::INT AS n_neutral, n::INT AS n_negative FROM (
SELECT *, len(list_filter(a, lambda x: x = 'positive')) AS p, len(list_filter(a, lambda x: x = 'neutral')) AS u, len(list_filter(a, lambda x: x = 'negative')) AS n FROM (
SELECT l.dedup_key, b.finbert, b.roberta, l.vendor, l.open, list_filter([b.finbert, b.roberta, l.vendor, l.open], lambda x: x IS NOT NULL) AS a FROM lab l LEFT JOIN bym b ON b.source_dedup_key = l.dedup_key))""", "lab", "bym"),
    "sent_batch_stats": _sql("""SELECT model, count(*) AS scores, count(*) FILTER (label = 'positive') AS positive, count(*) FILTER (label = 'negative') AS negative, count(*) FILTER (label = 'neutral') AS neutral,
count(vendor) AS compared, count(*) FILTER (vendor_agrees) AS agreed, round(100.0 * count(*) FILTER (vendor_agrees) / count(vendor), 2) AS agreed_pct FROM cmp GROUP BY model""", "lab", "cmp"),
    "sent_enriched_flat": _sql('SELECT f.ticker, f."interval", f.timestamp_ms, f.rank, f.article, b.finbert, b.roberta FROM flat f LEFT JOIN bym b ON b.source_dedup_key = f.article WHERE f.article IS NOT NULL', *_EVENTS, "flat", "bym"),
    "read_prices": _sql("SELECT ticker, timestamp_ms, close, volume FROM fx_price WHERE ticker = 'T03' AND \"interval\" = '5m' AND timestamp_ms BETWEEN 1704153600000 AND 1705363200000 ORDER BY timestamp_ms DESC LIMIT 200"),
    "read_news": _sql("SELECT ticker, published_ms, title, source FROM fx_news WHERE ticker = 'T03' ORDER BY published_ms DESC, dedup_key LIMIT 50"),
    "read_fused": _sql("SELECT * FROM fused WHERE ticker = 'T03' ORDER BY timestamp_ms DESC, \"interval\" LIMIT 50", *_EVENTS),
    "read_sentiment": _sql("SELECT dedup_key, model, label, scored_ms FROM fx_score WHERE ticker = 'T03' AND model = 'finbert' ORDER BY scored_ms DESC, dedup_key LIMIT 100"),
    "read_stats": _sql("""SELECT (SELECT count(*) FROM fx_price) AS price_rows, (SELECT count(DISTINCT ticker) FROM fx_price) AS tickers_with_prices, (SELECT count(*) FROM fx_company) AS companies, (SELECT count(*) FROM fx_company WHERE is_active) AS active,
(SELECT count(*) FROM fx_news) AS news, (SELECT count(*) FROM fused) AS fused, (SELECT count(*) FROM fx_score) AS scores""", *_EVENTS),
    "bars_market_hours": _sql("""SELECT ticker, timestamp_ms, isodow(make_timestamp(timestamp_ms * 1000)) <= 5 AND hour(make_timestamp(timestamp_ms * 1000)) * 60 + minute(make_timestamp(timestamp_ms * 1000)) BETWEEN 810 AND 1200 AS open_now FROM fx_price WHERE "interval" = '5m'"""),
    "audit_interval_ranges": _sql('SELECT "interval", count(*) AS rows, count(DISTINCT ticker) AS tickers, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms FROM fx_price GROUP BY 1'),
    "audit_top_prices": _sql("SELECT ticker, count(*) AS rows FROM fx_price GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "audit_without_prices": _sql("SELECT ticker, company_name FROM fx_company WHERE is_active AND ticker NOT IN (SELECT ticker FROM fx_price)"),
    "audit_null_prices": _sql("SELECT count(*) AS rows, count(*) FILTER (open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL) AS with_null, count(*) FILTER (high < low) AS high_below_low FROM fx_price"),
    "audit_news_by_source": _sql("SELECT source, count(*) AS rows, min(published_ms) AS first_ms, max(published_ms) AS last_ms FROM fx_news GROUP BY 1"),
    "audit_top_news": _sql("SELECT ticker, count(*) AS rows FROM fx_news GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "audit_news_quality": _sql("""SELECT count(DISTINCT ticker) AS tickers, count(*) FILTER (source = 'eodhd' AND title = '') AS vendor_untitled, count(*) FILTER (source = 'eodhd' AND vendor_sentiment IS NOT NULL) AS vendor_with_sentiment,
count(*) FILTER (source <> 'eodhd' AND tone_score IS NOT NULL) AS open_with_tone FROM fx_news"""),
    "audit_fused_by_interval": _sql('SELECT "interval", count(*) AS events, round(avg(news_count), 4) AS mean_news, max(news_count) AS most_news FROM fused GROUP BY 1', *_EVENTS),
    "audit_attachment_tiers": _sql(f"SELECT {_TIERS} AS tier, count(*) AS events FROM fused GROUP BY 1", *_EVENTS),
    "audit_attached_sources": _sql("SELECT count(*) FILTER (open_) AS with_open, count(*) FILTER (vendor_) AS with_vendor, count(*) FILTER (open_ AND vendor_) AS with_both FROM fused_src", *_EVENTS, "flat", "fused_src"),
    "audit_open_by_ticker": _sql("SELECT ticker, count(*) AS events FROM fused_src WHERE open_ GROUP BY 1", *_EVENTS, "flat", "fused_src"),
    "audit_scores_by_model": _sql("SELECT model, count(*) AS scores, round(avg(confidence), 6) AS mean_confidence FROM fx_score GROUP BY 1"),
    "audit_label_histogram": _sql("SELECT model, label, count(*) AS scores FROM fx_score GROUP BY ALL"),
    "audit_agreement": _sql("""SELECT coalesce(model, 'all') AS model, count(*) AS compared, count(*) FILTER (vendor_agrees) AS agreed, round(100.0 * count(*) FILTER (vendor_agrees) / count(*), 2) AS agreed_pct FROM cmp WHERE vendor IS NOT NULL GROUP BY ROLLUP (model)""", "lab", "cmp"),
    "audit_confidence_tiers": _sql("SELECT model, CASE WHEN confidence < 0.5 THEN '[0,0.5)' WHEN confidence < 0.75 THEN '[0.5,0.75)' WHEN confidence < 0.9 THEN '[0.75,0.9)' WHEN confidence < 1 THEN '[0.9,1)' ELSE 'other' END AS tier, count(*) AS scores FROM fx_score GROUP BY ALL"),
    "audit_score_range": _sql("SELECT min(scored_ms) AS first_ms, max(scored_ms) AS last_ms, count(*) AS scores FROM fx_score"),
    "audit_duplicates": _sql("""SELECT 'prices' AS surface, (SELECT count(*) FROM fx_price) AS rows, (SELECT count(*) FROM (SELECT 1 FROM fx_price GROUP BY ticker, timestamp_ms, "interval" HAVING count(*) > 1)) AS duplicate_keys
UNION ALL SELECT 'news', (SELECT count(*) FROM fx_news), (SELECT count(*) FROM (SELECT 1 FROM fx_news GROUP BY dedup_key HAVING count(*) > 1))
UNION ALL SELECT 'fused', (SELECT count(*) FROM fx_price), 0 UNION ALL SELECT 'scores', (SELECT count(*) FROM fx_score), (SELECT count(*) FROM (SELECT 1 FROM fx_score GROUP BY dedup_key HAVING count(*) > 1))"""),
    "audit_null_volume": _sql("SELECT count(*) AS bars, count(*) FILTER (volume IS NULL) AS without_volume, round(100.0 * count(*) FILTER (volume IS NULL) / count(*), 4) AS pct FROM fx_price WHERE \"interval\" = '5m'"),
    "audit_url_overlap": _sql("SELECT count(*) AS values, count(*) FILTER (n > 1) AS shared, round(100.0 * count(*) FILTER (n > 1) / count(*), 4) AS pct FROM (SELECT ticker || ':' || k AS u, count(DISTINCT source) AS n FROM fx_news GROUP BY 1)"),
    "universe_limited": _sql("""(SELECT ticker, company_name, sector FROM merged WHERE is_active ORDER BY ticker LIMIT 40)
UNION ALL SELECT w.ticker, m.company_name, m.sector FROM (VALUES ('C12'), ('S3'), ('NONE')) w(ticker) LEFT JOIN merged m USING (ticker)""", *_UNI),
    "sent_own_model": _sql("""SELECT dedup_key || '|by-length' AS dedup_key, ticker, dedup_key AS source_dedup_key, 'by-length' AS model, ['positive', 'negative', 'neutral'][n % 3 + 1] AS label, (n % 50) * 2 AS confidence
FROM (SELECT *, length(left(title, 512)) AS n FROM fx_news WHERE title <> '') WHERE n % 7 <> 0"""),
    "audit_key_overlap": _sql("SELECT count(*) AS values, count(*) FILTER (n > 1) AS shared, round(100.0 * count(*) FILTER (n > 1) / count(*), 4) AS pct FROM (SELECT ticker || ':' || k AS u, count(DISTINCT source) AS n FROM fx_news GROUP BY 1)"),
    "audit_daily_agreement": _sql(f"""SELECT ticker, count(*) AS days, count(*) FILTER (v = o) AS agreed FROM (SELECT ticker, day, max(CASE WHEN side = 'vendor' THEN m END) AS v, max(CASE WHEN side = 'open' THEN m END) AS o FROM (
SELECT ticker, day, side, {_MODAL} AS m FROM (SELECT ticker, published_ms // 86400000 AS day, CASE WHEN source = 'eodhd' THEN 'vendor' ELSE 'open' END AS side, count(*) FILTER (coalesce(vendor, open) = 'positive') AS p, count(*) FILTER (coalesce(vendor, open) = 'neutral') AS u, count(*) FILTER (coalesce(vendor, open) = 'negative') AS n
FROM lab WHERE coalesce(vendor, open) IS NOT NULL GROUP BY ALL)) GROUP BY ALL) WHERE v IS NOT NULL AND o IS NOT NULL GROUP BY ticker""", "lab"),
    "audit_open_concentration": _sql("""SELECT count(*) AS tickers_with, round(100.0 * sum(CASE WHEN r <= 5 THEN n ELSE 0 END) / sum(n), 4) AS top_pct, (SELECT count(*) FROM fx_company WHERE is_active AND ticker NOT IN (SELECT ticker FROM fused_src WHERE open_)) AS active_without
FROM (SELECT ticker, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, ticker) AS r FROM fused_src WHERE open_ GROUP BY ticker)""", *_EVENTS, "flat", "fused_src"),
    "universe_seed": _sql("SELECT 'added' AS status, count(*) AS n FROM got UNION ALL SELECT 'deactivated', 10", "uni", "got"),
    "source_eod_bars": _sql(_BARS.format(where="\"interval\" = '1d' AND volume IS NOT NULL", source="eodhd")),
    "source_intraday_bars": _sql(_BARS.format(where="\"interval\" = '5m' AND volume IS NOT NULL", source="eodhd")),
    "source_history": _sql(_BARS.format(where="\"interval\" = '5m' AND volume IS NOT NULL AND timestamp_ms BETWEEN 1704153600000 AND 1705363200000", source="eodhd_historical")),
    "source_vendor_news": _sql("""SELECT ticker, published_ms, title, length(content) AS letters, 'http://n/' || event_id AS url, array_to_string(symbols_mentioned, ',') AS symbols, vendor_sentiment.pos AS pos, source,
strftime(make_timestamp(published_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00') || '|' || left(title, 100) || '|' || ticker AS dedup_key FROM fx_news WHERE source = 'eodhd'"""),
    "source_records": _sql("SELECT record_id, date, url, orgs FROM rec", "rec"),
    "source_constituents": """SELECT 'C-' || c_custkey AS ticker, c_name || ' & Co.' AS company_name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS sector,
CASE WHEN c_custkey % 3 <> 0 THEN lpad(c_custkey::VARCHAR, 10, '0') END AS cik FROM customer""",
    "source_universe_json": _sql("SELECT ticker, company_name, sector, cik FROM uni", "uni"),
    "store_log": _sql("""SELECT 'bars' AS job, 'r1' AS run_id, 0::BIGINT AS start_ms, (SELECT count(*) FROM fx_price) AS records, 1.5::DOUBLE AS seconds, 'ok' AS status, NULL::VARCHAR AS error_message
UNION ALL SELECT 'events', 'r2', 10000, (SELECT count(*) FROM fx_event), 2.0, 'failed', 'late'"""),
    "stream_scores": _sql(f"""SELECT dedup_key || '|' || m AS dedup_key, ticker, m AS model, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label,
round(round(0.5 + abs(p - n) / (2.0 * (p + n + 1)), 4) * 10000)::BIGINT AS confidence FROM (SELECT *, len(list_filter(w, lambda x: x IN ({', '.join(map(_text, POSITIVE))}))) AS p,
len(list_filter(w, lambda x: x IN ({', '.join(map(_text, NEGATIVE))}))) AS n FROM lex0), (VALUES ('finbert'), ('roberta')) t(m)""", "lex0"),
    "stream_fused": _sql("SELECT * FROM flat", *_EVENTS, "flat"),
    "stream_dedup": _sql("SELECT dedup_key, ticker FROM fx_news"),
    "stream_insert": _sql("SELECT dedup_key, ticker, published_ms FROM fx_news"),
    "stream_tone_window": _sql("SELECT ticker, (published_ms // 900000) * 900000 AS window_ms, count(*) AS articles, count(tone_score) AS with_tone, round(avg(tone_score), 6) AS mean_tone FROM fx_news GROUP BY ALL"),
    "stream_pairs": _sql("SELECT b.ticker, b.timestamp_ms, p.dedup_key, p.offset_min FROM bars b LEFT JOIN pairs p USING (ticker, \"interval\", timestamp_ms) WHERE b.\"interval\" = '5m'", "win", "bars", "pairs"),
    "stream_enriched": _sql(f"""SELECT f.ticker, f."interval", f.timestamp_ms, f.rank, f.article, s.label AS finbert, s.confidence, s.label AS roberta FROM flat f LEFT JOIN (
SELECT dedup_key, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label, round(round(0.5 + abs(p - n) / (2.0 * (p + n + 1)), 4) * 10000)::BIGINT AS confidence
FROM (SELECT *, len(list_filter(w, lambda x: x IN ({', '.join(map(_text, POSITIVE))}))) AS p, len(list_filter(w, lambda x: x IN ({', '.join(map(_text, NEGATIVE))}))) AS n FROM lex0)) s
ON s.dedup_key = f.article WHERE f.article IS NOT NULL""", *_EVENTS, "flat", "lex0"),
    "stream_prices": _sql(_BARS.format(where="\"interval\" = '5m' AND volume IS NOT NULL", source="eodhd")),
    "stream_records": _sql("SELECT 'gdelt|' || record_id || '|' || ticker AS dedup_key, ticker, published_ms, url, publisher, array_to_string(tickers, ',') AS symbols, array_to_string(tags, ',') AS tags FROM arts", *_REC, "arts"),
}
