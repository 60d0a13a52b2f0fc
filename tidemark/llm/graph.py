"""Connected components of an edge table, without gathering edges or nodes anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """One star step. Edges hold u > v. ``both``: neighbours on either side (large star), else smaller ones only.

    Each node's least neighbour is a partial aggregate; joining it back is a join that adaptive execution
    splits where a node has very many neighbours.
    """
    pairs = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hit = pairs.join(least, "u")
    if both:
        out = hit.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hit.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, component): for each node with an edge, the least node that it can reach.

    Alternates large-star and small-star steps until nothing changes, so the rounds grow with the logarithm of the
    diameter. Each round is checkpointed in the shared folder. Edges with a null end or equal ends are ignored.
    """
    e = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = checkpointed(e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        e = checkpointed(_stars(_stars(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
