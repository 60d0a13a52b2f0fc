"""Entity mapping: which companies an article is about, and how relevant it is to each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import LEGAL_FORM_LOOKUP, OPEN_SOURCES, RELEVANCE_THRESHOLD
from tidemark.functions.expressions import extract_orgs, strip_boilerplate
from tidemark.shared import stored

MATCH = "array<struct<ticker string, match_type string>>"


def company_lookup(companies: DataFrame) -> DataFrame:
    """(name, ticker, ord): full name, name without legal form, first word of over three letters, and ticker, in lower case.

    A name of several companies goes to the last ticker; ``ord`` orders names by ticker and kind.
    """
    c = companies.filter("company_name <> '' AND ticker IS NOT NULL").select(F.upper("ticker").alias("ticker"), F.col("company_name").alias("full"))
    c = c.withColumn("cut", F.trim(F.regexp_replace("full", LEGAL_FORM_LOOKUP, "")))
    first = F.get(F.split("cut", r"\s+"), F.lit(0))
    kinds = F.array(F.col("full"), F.col("cut"), F.when(F.length(first) > 3, first), F.col("ticker"))
    rows = c.select("ticker", F.posexplode(kinds).alias("kind", "name")).filter("name IS NOT NULL AND name <> ''")
    last = Window.partitionBy(F.lower("name")).orderBy(F.desc("ticker"), F.desc("kind"))
    won = rows.withColumn("n", F.row_number().over(last)).filter("n = 1")
    return won.select(F.lower("name").alias("name"), "ticker", F.concat("ticker", F.lit("#"), F.col("kind").cast("string")).alias("ord"))


def first_per_key(news: DataFrame) -> DataFrame:
    """The first article of each key (earliest, then least ticker); rows without a key are dropped."""
    w = Window.partitionBy("dedup_key").orderBy("published_ms", "ticker")
    return news.filter("dedup_key IS NOT NULL").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def article_orgs(news: DataFrame) -> DataFrame:
    """Articles with their clean text and organisations; where a user's own tagger has made a column ``orgs``, that one is kept."""
    clean = news.withColumn("clean", strip_boilerplate(F.col("content")))
    if "orgs" in news.columns:
        return clean
    return clean.withColumn("orgs", extract_orgs(F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.col("clean"))))


#: Letters of a gram by which texts meet the pieces of text that they may hold.
GRAM = 3


def _grams(df: DataFrame, text: str, size: int) -> DataFrame:
    """One row for each place of a text where ``size`` letters follow: the columns, gram and at (from 1)."""
    n = F.length(text) - size + 1
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(at).alias("at")).withColumn("gram", F.substring(F.col(text), F.col("at"), F.lit(size)))


def _holds(long: DataFrame, text: str, short: DataFrame, part: str) -> DataFrame:
    """Rows of both tables where ``text`` contains ``part``.

    A part is looked for by its rarest gram alone, rarest among the grams of all texts, and must then stand at the place that the gram
    has in it; a part with a gram that no text has meets nothing. Parts shorter than a gram are grams themselves: each text meets one once, and
    each meeting is a result.
    """
    texts = _grams(long, text, GRAM)
    often = texts.groupBy("gram").agg(F.count("*").alias("n"))
    own = [F.col(c) for c in short.columns]
    grams = _grams(short.filter(F.length(part) >= GRAM), part, GRAM).join(often, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = grams.groupBy(*own).agg(F.min(F.struct("n", "gram", "at")).alias("r")).filter("r.n > 0").select(*own, F.col("r.gram").alias("gram"), F.col("r.at").alias("inside"))
    start = F.col("at") - F.col("inside") + 1
    met = texts.join(rarest, "gram").filter((start >= 1) & (F.substring(F.col(text), start, F.length(part)) == F.col(part))).select(*long.columns, *own)
    out = met
    for size in range(1, GRAM):
        brief = short.filter(F.length(part) == size).withColumn("gram", F.col(part))
        out = out.unionAll(_grams(long, text, size).join(brief, "gram").select(*long.columns, *own))
    return out.distinct()


def org_candidates(orgs: DataFrame, lookup: DataFrame, most: int | None = None) -> DataFrame:
    """(org, exact, partial) for distinct organisations: the ticker of that very name, and the tickers of names that hold it or lie in it.

    ``partial`` is in order of the lookup, each ticker once and at most ``most``, cut before they are gathered. The cut is exact for a fold over articles of at
    most that many organisations: those before have taken at most ``most`` - 1 of them.
    """
    names = lookup.select("name", F.col("ticker").alias("t"), "ord")
    low = orgs.select("org").distinct().withColumn("low", F.lower("org"))
    cols = ["org", "low", "name", "t", "ord"]
    found = _holds(low, "low", names, "name").select(cols).unionAll(_holds(names, "name", low, "low").filter("name <> low").select(cols))
    first = found.groupBy("org", "t").agg(F.min("ord").alias("ord"))
    if most is not None:
        first = first.withColumn("_n", F.row_number().over(Window.partitionBy("org").orderBy("ord"))).filter(F.col("_n") <= most)
    partial = first.groupBy("org").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]).alias("partial"))
    same = low.join(names, F.col("low") == F.col("name")).groupBy("org").agg(F.max("t").alias("exact"))
    return partial.join(same, "org", "left").select("org", "exact", "partial")


def _take(seen: Column, org: Column) -> Column:
    """One step of the fold: an organisation adds its own ticker, or else the first candidate not seen yet."""
    tickers = F.transform(seen, lambda s: s["ticker"])
    fresh = F.filter(org["partial"], lambda t: ~F.array_contains(tickers, t))
    exact = F.when(F.array_contains(tickers, org["exact"]), seen).otherwise(F.concat(seen, F.array(F.struct(org["exact"].alias("ticker"), F.lit("exact").alias("match_type"))).cast(MATCH)))
    partial = F.when(F.size(fresh) > 0, F.concat(seen, F.array(F.struct(F.get(fresh, F.lit(0)).alias("ticker"), F.lit("partial").alias("match_type"))).cast(MATCH))).otherwise(seen)
    return F.when(org["exact"].isNotNull(), exact).otherwise(partial)


def org_matches(articles: DataFrame, lookup: DataFrame) -> DataFrame:
    """(dedup_key, ticker, match_type): each article's organisations, in alphabetical order, each given a ticker not taken before."""
    # reading whole contents is the dear part, so it is done once: stored before the rows are filtered, as Spark would repeat it in the filter
    orgs = stored(articles.select("dedup_key", "orgs"), "orgs").select("dedup_key", F.explode("orgs").alias("org"))
    most = orgs.groupBy("dedup_key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    cand = stored(org_candidates(stored(orgs.select("org").distinct(), "names"), stored(lookup, "lookup"), most), "candidates")
    per = orgs.join(cand, "org").groupBy("dedup_key").agg(F.array_sort(F.collect_list(F.struct("org", "exact", "partial"))).alias("c"))
    folded = per.select("dedup_key", F.explode(F.aggregate("c", F.array().cast(MATCH), _take)).alias("m"))
    return folded.select("dedup_key", "m.ticker", "m.match_type")


def map_vendor(articles: DataFrame, lookup: DataFrame, target: str | None = None) -> DataFrame:
    """(dedup_key, ticker, relevance, match_type) of vendor articles; relevance in hundredths: title 50, organisation 30, tag 20."""
    known = lookup.select("ticker").distinct()
    matches = org_matches(articles, lookup)
    tags = articles.select("dedup_key", F.explode("symbols_mentioned").alias("s")).select("dedup_key", F.upper(F.regexp_replace("s", r"\.US", "")).alias("ticker")).distinct().join(known, "ticker", "left_semi")
    # One aggregate over both, so that the matches, which read whole contents, are made once.
    found = matches.withColumn("tag", F.lit(0)).unionByName(tags.select("dedup_key", "ticker", F.lit(None).cast("string").alias("match_type"), F.lit(20).alias("tag")))
    cand = found.groupBy("dedup_key", "ticker").agg(F.max("match_type").alias("match_type"), F.max("tag").alias("tag"))
    if target:
        cand = cand.filter(F.col("ticker") == target)
    names = lookup.groupBy("ticker").agg(F.collect_list("name").alias("names"))
    titled = cand.join(articles.select("dedup_key", F.lower(F.coalesce("title", F.lit(""))).alias("title")), "dedup_key").join(names, "ticker")
    in_title = F.exists("names", lambda n: F.col("title").contains(n)) | F.col("title").contains(F.lower("ticker"))
    relevance = F.when(in_title, 50).otherwise(0) + F.when(F.col("match_type").isNotNull(), 30).otherwise(0) + F.col("tag")
    return titled.select("dedup_key", "ticker", relevance.alias("relevance"), F.coalesce("match_type", F.lit("tag_only")).alias("match_type")).filter(F.col("relevance") >= RELEVANCE_THRESHOLD)


def map_open(articles: DataFrame, lookup: DataFrame, target: str | None = None) -> DataFrame:
    """The same for open-data articles, whose tickers came with them: 70 and 10 for each theme, at most 100."""
    known = lookup.select("ticker").distinct()
    rows = articles.select("dedup_key", F.least(F.lit(100), 70 + 10 * F.greatest(F.coalesce(F.size("tags"), F.lit(0)), F.lit(0))).cast("int").alias("relevance"), F.explode("symbols_mentioned").alias("s"))
    out = rows.select("dedup_key", F.upper(F.regexp_replace("s", r"\.US", "")).alias("ticker"), "relevance").distinct().join(known, "ticker", "left_semi")
    out = out.filter(F.col("ticker") == target) if target else out
    return out.select("dedup_key", "ticker", "relevance", F.lit("gdelt_pretagged").alias("match_type"))


def map_articles(news: DataFrame, companies: DataFrame, target: str | None = None, strict_source: bool = False) -> DataFrame:
    """Mapping of all articles, one row per article and ticker of enough relevance."""
    lookup = company_lookup(companies)
    is_open = F.col("source").isin(OPEN_SOURCES[:1] if strict_source else OPEN_SOURCES)
    # contents are read once, where they lie: what is shuffled and stored is the organisations found in them
    found = article_orgs(news).select("dedup_key", "ticker", "published_ms", "source", "title", "symbols_mentioned", "tags", F.when(~is_open, F.col("orgs")).alias("orgs"))
    articles = stored(first_per_key(found), "articles")
    return map_vendor(articles.filter(~is_open), lookup, target).unionByName(map_open(articles.filter(is_open), lookup, target))


def mapping_stats(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.count("*").alias("associations"), F.countDistinct("dedup_key").alias("articles"), F.countDistinct("ticker").alias("tickers"))
