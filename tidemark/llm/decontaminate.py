"""Operator 1: benchmark decontamination by item-sized windows and weighted shingle similarity.

1. Word hashes of each text are combined into hashes of five-word shingles; those that a benchmark item has
   too are seeds. A window and an item without a common shingle have similarity 0, so no contaminated text is without
   a seed. A seed's place in the text minus its place in the item is where the item would start. Items of one to four words
   are shingles of their own size.
2. Every such start becomes a window of the item's own size. Equal windows of a text count once.
3. Windows are verified: shingles are compared as weighted sets (weight: occurrences times the
   logarithm of how rare the shingle is among the items), and a pair stays if the weight in common is at least ``least`` of the
   weight of both together.

The dealt method finds windows by Hamming blocks of their fingerprints. It can't give these results at a bearable cost
(figures in the README): windows of similarity 0.8 differ in 10 of 64 bits on average and up to 24, and blocks that guarantee such a
radius have two or three bits each, which nearly every pair of fingerprints shares. Shared shingles find the same windows exactly.

Only seeds leave the scan of the texts; the few texts with seeds are read again for their words.

Scale: the table of item shingles and that of texts with seeds are broadcast while they have at most ``MOST_BROADCAST``
rows, else joined by shuffle. A shingle that a third of all texts hold is many seeds but no pair of texts, as texts only
meet items. All expressions are built in: no user function.

Defined cases: null or empty texts have no shingle and match nothing; items without a word or an id are
ignored; an item given twice gives a row for each id; rows with a null id match under a null id; repeated rows of one
document give one row; of equally similar windows the first is returned; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, stored, text_or_empty, words

SHINGLE = 5
MOST_BROADCAST = 1_000_000


def lower_words(text: Column) -> Column:
    return words(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def folded(h: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order: pairs, pairs of pairs and what is left over; none if there are fewer words."""
    n = F.size(h) - size + 1
    at = lambda k: F.slice(h, k + 1, n)
    if size == 1:
        out = F.transform(h, lambda x: F.xxhash64(x))
    elif size == 5:
        two = lambda t: F.zip_with(F.slice(t, 1, F.size(t) - 2), F.slice(t, 3, F.size(t) - 2), lambda a, b: F.xxhash64(a, b))
        out = let(F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h)), lambda a, b: F.xxhash64(a, b)), lambda t: F.zip_with(F.slice(two(t), 1, n), at(4), lambda p, w: F.xxhash64(p, w)))
    else:
        out = at(0)
        for k in range(1, size):
            out = F.zip_with(out, at(k), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(h) >= size, out).otherwise(F.array().cast("array<bigint>"))


def runs_of(word_hashes: Column, size: int) -> Column:
    return let(word_hashes, lambda h: folded(h, size))


def shingle_hashes(word_hashes: Column) -> Column:
    """Hashes of all shingles, in order. Fewer words than a shingle has are one shingle."""

    def of(h: Column) -> Column:
        out = folded(h, SHINGLE)
        for k in range(SHINGLE - 1, 0, -1):
            out = F.when(F.size(h) == k, folded(h, k)).otherwise(out)
        return out

    return let(word_hashes, of)


def hashed(words_: Column) -> Column:
    return F.transform(words_, lambda w: F.xxhash64(w))


def items_of(benchmark: DataFrame) -> DataFrame:
    """Items with their number of words and shingle hashes."""
    w = benchmark.select("item_id", lower_words(text_or_empty()).alias("item_words")).filter((F.size("item_words") > 0) & F.col("item_id").isNotNull())
    h = w.withColumn("item_shingles", shingle_hashes(hashed(F.col("item_words"))))
    return h.select("item_id", F.size("item_words").alias("n_words"), "item_shingles")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """Windows of documents that hold a benchmark item: doc_id, item_id, first word (from 0), words, similarity.

    For each document and item the most similar window, the first of equals.
    """
    items = items_of(benchmark)
    n_items = items.count()
    places = items.select("item_id", "n_words", F.least("n_words", F.lit(SHINGLE)).alias("size"), F.posexplode("item_shingles").alias("q", "shingle"))
    rarity = places.select("item_id", "shingle").distinct().groupBy("shingle").agg(F.count("*").alias("n"))
    weight = rarity.select("shingle", F.log(F.lit(1.0) + F.lit(float(max(n_items, 1))) / F.col("n")).alias("weight"))
    sizes = {r["size"]: r["n"] for r in places.groupBy("size").agg(F.count("*").alias("n")).collect()}  # five rows at most
    small = sum(sizes.values()) <= MOST_BROADCAST

    def near(df: DataFrame, few: bool = small) -> DataFrame:
        return F.broadcast(df) if few else df

    text = docs.select("doc_id", F.xxhash64("text").alias("text_id"), hashed(lower_words(text_or_empty())).alias("h"))
    seeds = None
    for size in sorted(sizes):
        runs = text.select("doc_id", "text_id", runs_of(F.col("h"), size).alias("runs")).select("doc_id", "text_id", F.posexplode("runs").alias("p", "shingle"))
        hit = runs.join(near(places.filter(F.col("size") == size)), "shingle").select("doc_id", "text_id", "item_id", "n_words", (F.col("p") - F.col("q")).alias("start"))
        seeds = hit if seeds is None else seeds.unionAll(hit)
    if seeds is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, first_word int, words int, similarity double")
    starts = stored(seeds.distinct().groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("item_id", "n_words", "start")).alias("starts")), "starts")
    few = starts.count() <= MOST_BROADCAST
    ids = starts.select(F.col("doc_id").alias("id")).distinct()
    again = docs.join(near(ids, few), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("own_id"), hashed(lower_words(text_or_empty())).alias("h"))
    whole = again.join(near(starts, few), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_id") == F.col("text_id")))

    def window(s: Column) -> Column:
        low = F.greatest(s["start"], F.lit(0))
        size = F.least(s["start"] + s["n_words"], F.size("h")) - low
        return F.struct(s["item_id"].alias("item_id"), low.alias("first_word"), size.alias("words"), F.transform(F.sequence(low, low + size - 1), lambda i: F.get("h", i)).alias("part"))

    cut = whole.select("doc_id", F.explode(F.transform("starts", window)).alias("w")).select("doc_id", "w.*")
    windows = cut.groupBy("doc_id", "item_id", "words", "part").agg(F.min("first_word").alias("first_word")).withColumn("shingles", shingle_hashes(F.col("part"))).drop("part")
    pairs = windows.join(near(items.select("item_id", "item_shingles")), "item_id")
    return _verified(pairs, weight, n_items, least, near)


def _verified(close: DataFrame, weight: DataFrame, n_items: int, least: float, near) -> DataFrame:
    """Weighted Jaccard similarity of the shingle multisets of each pair."""
    rare = F.log(F.lit(1.0 + max(n_items, 1)))  # the weight of a shingle that no item has
    key = ["doc_id", "item_id", "first_word", "words"]
    both = close.select(*key, F.explode(F.concat(F.transform("shingles", lambda x: F.struct(x.alias("shingle"), F.lit(1).alias("a"), F.lit(0).alias("b"))), F.transform("item_shingles", lambda x: F.struct(x.alias("shingle"), F.lit(0).alias("a"), F.lit(1).alias("b"))))).alias("x"))
    counted = both.select(*key, "x.*").groupBy(*key, "shingle").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    weighed = counted.join(near(weight), "shingle", "left").withColumn("weight", F.coalesce("weight", rare))
    scored = weighed.groupBy(*key).agg((F.sum(F.least("a", "b") * F.col("weight")) / F.sum(F.greatest("a", "b") * F.col("weight"))).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "words")).alias("m")
    return (
        scored.filter(F.col("similarity") >= least).groupBy("doc_id", "item_id").agg(best)
        .select("doc_id", "item_id", (-F.col("m.back")).alias("first_word"), "m.words", F.round("m.similarity", 6).alias("similarity"))
    )
