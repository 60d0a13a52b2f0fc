"""Fixed values of the fusion domain and the session that its jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fusion windows in minutes, (look back, look ahead) by bar interval.
FUSION_WINDOWS = {"1d": (1440, 5760), "1h": (120, 10), "15m": (60, 5), "5m": (30, 5), "1m": (15, 2)}
DEFAULT_INTERVAL = "1d"
# The hour at which a daily bar closes, market hours in minutes of the day, articles attached to a bar at most.
MARKET_CLOSE_HOUR_UTC = 20
MARKET_OPEN_MINUTE, MARKET_CLOSE_MINUTE = 810, 1200
MOST_NEWS_PER_BAR = 10

# Themes that make an open-data record financial.
FINANCIAL_THEMES = [
    "ECON_STOCKMARKET", "ECON_EARNINGSREPORT", "ECON_BANKRUPTCY", "ECON_INTEREST_RATES", "ECON_MONETARY_POLICY", "ECON_INFLATION", "ECON_TRADE",
    "BUS_STOCK_BUYBACK", "BUS_MARKET_CLOSE", "BUS_NEW_PRODUCTS", "MERGER", "ACQUISITION", "LEG_FINANCIAL_REGULATION",
]

# Company-name suffixes, in the order in which they are tried.
NAME_SUFFIXES = [" inc.", " inc", " corp.", " corp", " corporation", " company", " co.", " co", " ltd.", " ltd", " plc", " limited", " group", " holdings", " holding"]

# Phrases that mark a paragraph as boilerplate.
BOILERPLATE_PHRASES = [
    "Free Stock Analysis Report", "originally appeared on Benzinga", "originally appeared on", "View Comments", "Story Continues", "Don't Miss:",
    "Read Next:", "Trending:", "See Also:", "Top Picks", "UNLOCKED: 5 NEW TRADES", "Get the latest stock analysis",
    "was originally published by The Motley Fool", "Stock Advisor returns as of", "The Motley Fool has positions in", "This article provides information only",
]

# Legal forms cut from the end of a name.
LEGAL_FORM = r"\s*(Inc\.?|Corp\.?|Ltd\.?|Co\.?|LLC|PLC)\s*$"
LEGAL_FORM_LOOKUP = r"\s*(Inc\.?|Corp\.?|Ltd\.?|Co\.?|LLC|PLC|,?\s*Inc\.?)\s*$"
#: Spans of two or more capitalised words: the built-in stand-in for a trained organisation tagger.
ORG_SPAN = r"[A-Z][A-Za-z]+(?: (?:&|[A-Z][A-Za-z.]*))+"

# Least relevance in hundredths, least tone of a label, fields of a whole record, sources of open data.
RELEVANCE_THRESHOLD = 30
TONE_THRESHOLD = 1.5
GKG_FIELDS = 27
OPEN_SOURCES = ["gdelt", "gdelt_historical"]

# Names of the two sentiment models and their short forms.
MODELS = {"finbert": "ProsusAI/finbert", "roberta": "mrm8488/distilroberta-finetuned-financial-news-sentiment-analysis"}
PRIMARY_MODEL = "finbert"


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; other settings are the caller's."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()
