"""Operator 9: URL filters as a sort-merge range join.

A rule is a host and a path prefix. Reversed host labels (``net.example.www.``) turn "this host and its
subdomains" into an interval of keys, and a path prefix is an interval of paths. Such intervals nest: of two either one
holds the other or they are apart. So the last interval that starts at or before a key, with the intervals around it, is the
stack of all that can hold the key; what the key doesn't start with has been closed before it.

Two sweeps, each a window in key order over interval starts and URLs that carries the latest stack on to the URLs behind:

1. over reversed hosts, with the stack of rule hosts around; each active host of a URL gives a probe;
2. over the paths of one rule host, with the stack of its rules around. Of all active rules of a URL the longest decides.

A stack is as deep as hosts have labels or rules nest, whatever the number of rules.

Scale: URLs and rules are dealt by the top-level label and the URLs of a large label once more by a hash of the row, into parts of
``rows`` URLs or as many as the label has rules, if these are more. Every part gets the label's rules, so copies of rules are
never more than rules and URLs together, and a host that holds a third of all URLs is spread evenly. The numbers of parts
of the ``LARGE`` labels with most URLs are broadcast; a label behind these has less than 1 / ``LARGE`` of all URLs and is one
part. No user function, no cross join, nothing on the driver.

Defined cases: a null URL or one without ``://`` has empty host and path, which no rule fits (rules with
an empty host are ignored); ties in length go to the longer host; repeated rows are judged one by one; a
rule given twice counts once, and block wins if it is given with both verdicts; with no rules every URL gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labels of which at most this many are dealt in parts.
LARGE = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def reversed_host(host: Column) -> Column:
    """Host labels from the top level down, each followed by a dot."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def top_label(key: Column) -> Column:
    return F.substring_index(key, ".", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules once each: ``top``, ``key`` (reversed host), ``path`` and the rule ``r`` in order of precedence."""
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit("/"))
    once = rules.filter("host <> '' AND verdict IS NOT NULL").groupBy(host.alias("host"), path.alias("path")).agg(F.max("verdict").alias("verdict"))
    r = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), "host", "path", "verdict")
    key = reversed_host(F.col("host"))
    return once.select(top_label(key).alias("top"), key.alias("key"), "path", r.alias("r"))


def host_stacks(rules: DataFrame) -> DataFrame:
    """Each rule host's key with the keys of the rule hosts around it, itself included."""
    hosts = rules.select("top", "key").distinct()
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.")
    around = F.transform(labels, lambda _, i: F.concat(F.array_join(F.slice(labels, 1, i + 1), "."), F.lit(".")))
    outer = hosts.select("top", "key", F.explode(around).alias("outer"))
    return outer.join(hosts.select(F.col("key").alias("outer")), "outer").groupBy("top", "key").agg(F.collect_list("outer").alias("stack"))


def path_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's host key and path with the rules of that host around it, itself included."""
    around = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    outer = rules.select("top", "key", "path", F.explode(around).alias("outer"))
    inner = rules.select("key", F.col("path").alias("outer"), "r")
    return outer.join(inner, ["key", "outer"]).groupBy("top", "key", "path").agg(F.collect_list("r").alias("stack"))


def url_filter(urls: DataFrame, rules: DataFrame, row: str = "page_id", url: str = "url", default: str = "allow", rows: int = 2_000) -> DataFrame:
    """One row per URL: the row id, ``host``, ``path``, the winning ``rule`` (or null) and the ``verdict``.

    ``rules`` has the columns host, path and verdict (allow or block). ``rows`` is the number of URLs that are swept together.
    """
    host, path = url_parts(F.col(url))
    given = urls.select(F.monotonically_increasing_id().alias("n"), F.col(row).alias("id"), host.alias("host"), path.alias("path"))
    given = given.withColumn("key", reversed_host(F.col("host"))).withColumn("top", top_label(F.col("key")))
    r = rule_table(rules)
    large = given.groupBy("top").count().filter(F.col("count") > rows).orderBy(F.desc("count"), "top").limit(LARGE)
    parts = F.broadcast(large.join(r.groupBy("top").agg(F.count("*").alias("rules")), "top", "left").select(
        "top", (F.floor(F.col("count") / F.greatest(F.coalesce("rules", F.lit(0)), F.lit(rows))) + 1).cast("int").alias("parts")
    ))
    n_parts = F.coalesce("parts", F.lit(1))
    each_part = F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part")

    hosts = host_stacks(r).join(parts, "top", "left").select("top", each_part, "key", F.lit(0).alias("kind"), "stack")
    dealt = given.join(parts, "top", "left").select("top", F.pmod(F.xxhash64("n"), n_parts).cast("int").alias("part"), "key", F.lit(1).alias("kind"), "n", "id", "host", "path")
    sweep = Window.partitionBy("top", "part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = hosts.unionByName(dealt, allowMissingColumns=True).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    active = F.filter("stack", lambda k: F.col("key").startswith(k))
    probes = swept.select("top", "part", F.explode_outer(active).alias("key"), "path", F.lit(1).alias("kind"), "n", "id", "host")

    paths = path_stacks(r).join(parts, "top", "left").select("top", each_part, "key", "path", F.lit(0).alias("kind"), "stack")
    sweep = Window.partitionBy("top", "part", "key").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = paths.unionByName(probes, allowMissingColumns=True).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    fits = F.array_max(F.filter("stack", lambda x: F.col("path").startswith(x["path"])))
    best = judged.groupBy("n", "id", "host", "path").agg(F.max(fits).alias("best"))
    return best.select(
        F.col("id").alias(row), "host", "path", F.concat("best.host", "best.path").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
