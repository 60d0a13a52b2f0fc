"""Operator 13: prefix trie of conversations by van Emde Boas recursion.

A sequence of turns is a path from the root; a node is a distinct prefix, named by its smallest conversation and its depth. The
trie is cut at half its height: prefixes of the upper half are named first, then the trie above the cut and the forest
below it are built in the same way. All tries of one level of the recursion go through one job, so H turns take log2(H) rounds:

* segments: digests of aligned runs of 1, 2, 4 ... turns, each from the two halves before;
* names: at level s every prefix of odd multiples of s turns gets the least conversation that shares the name of the prefix s turns
  shorter and the digest of the s turns between;
* totals, from the smallest level up: the roots of the lower forests hand what their block has summed to all nodes of the upper trie
  above them, found along the root's own conversation.

A round moves digests and numbers, never texts, and is written as a table. Rows of a popular prefix are summed before they are shuffled and
met by plain joins that Spark splits. Positions are counted over ranges of rows, with the numbers of rows
before handed over, so a conversation of any length is split as well. A node's list of ends is put together in pieces of
``PIECE`` ids over ranges; its hash, which has to read them in order, runs over those pieces and keeps only its state.

Defined cases: rows with a null conv_id are left out; null roles and texts are empty; rows of one turn go by role, then text, repeated
rows count as turns of their own; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored

#: Ids of a piece of a node's ends.
PIECE = 256
MODULUS, SHARED = 5, 9


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranged(conversations: DataFrame) -> DataFrame:
    """Turns as a table in order over ranges: conv_id, part, row (ascending within a part), digest of role and text, size (bytes of the text)."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = c.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"),
        _sha(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary")).alias("digest"), F.octet_length("text").cast("long").alias("size"),
    )
    return stored(rows, "trie-turns")


def positions(ranges: DataFrame) -> DataFrame:
    """Turns with their place in their conversation: conv_id, at (from 0), digest, size."""
    starts = ranges.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("conv_id", "part", (before - F.col("first")).alias("shift"))  # a row for each range that a conversation reaches
    return ranges.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("row") + F.col("shift")).alias("at"), "digest", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation with the first h turns of its base in place of its own: the same columns, and a row of null ``at`` for each conversation."""
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(MODULUS))
    convs = turns.filter("at = 0").select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("h"))
    heads = turns.filter(F.col("at") < SHARED - 1).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").filter("at < h").select("conv_id", "at", "digest", "size")
    taken = first.groupBy("conv_id").agg(F.count("*").alias("taken"))
    shift = convs.join(taken, "conv_id", "left").select("conv_id", "h", (F.coalesce("taken", F.lit(0)) - F.col("h")).alias("shift"))
    rest = turns.join(shift, "conv_id").filter("at >= h").select("conv_id", (F.col("at") + F.col("shift")).alias("at"), "digest", "size")
    return first.unionAll(rest).unionAll(convs.select("conv_id", F.lit(None).cast("long"), F.lit(None).cast("binary"), F.lit(None).cast("long")))


def segments(level: DataFrame) -> DataFrame:
    """Digests of runs twice as long, from (conv_id, k, digest); runs that aren't whole are left out."""
    half = lambda odd: F.max(F.when(F.col("k") % 2 == odd, F.col("digest")))
    return level.groupBy("conv_id", (F.col("k") / 2).cast("long").alias("k")).agg(half(0).alias("a"), half(1).alias("b")).filter("b IS NOT NULL").select("conv_id", "k", _sha("a", "b").alias("digest"))


def named(turns: DataFrame) -> DataFrame:
    """All prefixes of all conversations, from (conv_id, at, digest): conv_id, depth, name (the smallest conversation of the prefix)."""
    roots = turns.filter("at IS NULL").select("conv_id")
    least, longest = turns.agg(F.min("conv_id"), F.max("at")).first()
    names = stored(roots.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(least).cast("long").alias("name")), "trie-names")
    if longest is None:
        return names
    levels = [stored(turns.filter("at IS NOT NULL").select("conv_id", F.col("at").alias("k"), "digest"), "trie-runs")]
    while 1 << len(levels) <= longest + 1:
        levels.append(stored(segments(levels[-1]), "trie-runs"))
    for j in reversed(range(len(levels))):
        s = 1 << j
        runs = levels[j].filter("k % 2 = 0").withColumn("depth", F.col("k") * s).join(names, ["conv_id", "depth"]).select("conv_id", "depth", F.col("name").alias("above"), "digest")
        runs = stored(runs, "trie-met")
        groups = stored(runs.groupBy("above", "depth", "digest").agg(F.min("conv_id").alias("name")), "trie-groups")
        lower = runs.join(groups, ["above", "depth", "digest"]).select("conv_id", (F.col("depth") + s).alias("depth"), "name")
        whole = stored(names.unionAll(lower), "trie-names")
        forget(names, runs, groups, levels[j])
        names = whole
    return names


def nodes(turns: DataFrame, names: DataFrame) -> DataFrame:
    """One row per node: name, depth, parent, n_convs, n_children, own number of leaves and own saved tokens."""
    size = turns.filter("at IS NOT NULL").select(F.col("conv_id").alias("name"), (F.col("at") + 1).alias("depth"), "size")
    count = names.groupBy("name", "depth").agg(F.count("*").alias("n_convs"))
    above = names.select(F.col("conv_id").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    found = stored(count.join(size, ["name", "depth"], "left").join(above, ["name", "depth"], "left"), "trie-nodes")
    children = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    n = F.coalesce("n_children", F.lit(0).cast("long"))
    out = found.join(children, ["name", "depth"], "left").select(
        "name", "depth", "parent", "n_convs", n.alias("n_children"), (n == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))).alias("saved_tokens")
    )
    out = stored(out, "trie-totals")
    forget(found)
    return out


def grafted(trie: DataFrame, names: DataFrame) -> DataFrame:
    """``trie`` with n_leaves and saved_tokens summed over subtrees: at each level the lower forests' roots hand their sums to the nodes of the upper trie."""
    deepest = trie.agg(F.max("depth")).first()[0]
    s = 1
    while deepest is not None and s <= deepest:
        cut = trie.filter(F.col("depth") % (2 * s) == s).select(F.col("name").alias("conv_id"), (F.col("depth") / (2 * s)).cast("long").alias("block"), "n_leaves", "saved_tokens")
        path = names.filter(F.col("depth") % (2 * s) < s).select("conv_id", (F.col("depth") / (2 * s)).cast("long").alias("block"), "depth", "name")
        more = cut.join(path, ["conv_id", "block"]).groupBy("name", "depth").agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("t"))
        add = lambda own, other: (F.col(own) + F.coalesce(other, F.lit(0).cast("long"))).alias(own)
        above = trie.join(more, ["name", "depth"], "left").select("name", "depth", "parent", "n_convs", "n_children", add("n_leaves", "l"), add("saved_tokens", "t"))
        whole = stored(above, "trie-totals")
        forget(trie)
        trie, s = whole, 2 * s
    return trie


def ends(names: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of the conversations that end at each node: name, depth, ends_sha256."""
    last = names.groupBy("conv_id").agg(F.max("depth").alias("depth"), F.max_by("name", "depth").alias("name"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted rows to one row for every ``PIECE`` ids of a node."""
        for b in batches:
            b["node"] = (b[["name", "depth"]].diff().fillna(1) != 0).any(axis=1).cumsum()
            b["n"] = b.groupby("node").cumcount() // PIECE
            got = b.groupby(["node", "n"], sort=False).agg(name=("name", "first"), depth=("depth", "first"), least=("conv_id", "first"), ids=("conv_id", lambda x: ",".join(map(str, x))))
            yield got.reset_index(drop=True)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted pieces to one row for each node; only the running hash is kept."""
        at, sha = None, None
        for b in batches:
            out = []
            for name, depth, ids in zip(b["name"], b["depth"], b["ids"], strict=True):
                if (name, depth) != at:
                    if at:
                        out.append((*at, sha.hexdigest()))
                    at, sha = (name, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield pd.DataFrame(out, columns=["name", "depth", "ends_sha256"])
        if at:
            yield pd.DataFrame([(*at, sha.hexdigest())], columns=["name", "depth", "ends_sha256"])

    ranged = last.select("name", "depth", "conv_id").repartitionByRange("name", "depth", "conv_id").sortWithinPartitions("name", "depth", "conv_id")
    parts = ranged.mapInPandas(pieces, "name long, depth long, least long, ids string")
    return parts.repartition("name", "depth").sortWithinPartitions("name", "depth", "least").mapInPandas(hashed, "name long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ranges = ranged(conversations)
    turns = stored(rebuilt(positions(ranges)), "trie-rebuilt")
    names = named(turns)
    trie = grafted(nodes(turns, names), names)
    found = stored(ends(names), "trie-ends")
    forget(ranges, turns, names)
    return trie.join(found, ["name", "depth"], "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
