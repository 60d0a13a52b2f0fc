"""Tables of partitions that are replaced whole, with a version pointer that readers follow.

::

    root/data/part=0000000003_2024-01-05/part-*.parquet   what version 3 has written for a day
    root/versions/v=3/part-*.parquet                      the folders that make up version 3
    root/_current/v=3                                     the pointer: one empty file, swapped by a rename

A refresh writes its partitions to folders of its own, then the list that takes them from there and all others from where
they were, then moves the pointer. Files of partitions that aren't refreshed stay as they are. A reader takes the
pointer once, so it sees the table before or after a refresh and never half of it; files of older versions stay until ``expire``. A refresh
that fails before the rename has changed nothing for readers, and the next one deletes what it has left. One writer at a time:
the second of two fails at the rename, as the pointer that it renames is gone.

Version and partition are one folder name, as Spark prunes by each partition column alone: of two columns it would read
old folders of refreshed days too. Values of the partition column must be fit for a folder's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


PARTS = "part string, value string"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, root: str) -> int:
    """The version that readers see; 0 before the first one."""
    fs, p = _fs(spark, f"{root}/_current")
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n[2:]) for n in found if n.startswith("v=")), default=0)


def _swap(spark: SparkSession, root: str, before: int, after: int) -> None:
    """Move the pointer by one rename, which fails if it has moved meanwhile."""
    fs, old = _fs(spark, f"{root}/_current/v={before}")
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_current/v={after}")
    if before == 0 and not fs.exists(old):
        fs.create(old, False).close()
    if not fs.rename(old, new):
        raise RuntimeError(f"{root}: version {before} is no longer the current one")


def parts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The folders of a version, the current one if not given: (part, value of the partition column)."""
    v = current(spark, root) if version is None else version
    if v == 0:
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(PARTS).parquet(f"{root}/versions/v={v}")


def read(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of a version, the current one if not given. Only its folders are read."""
    fs, p = _fs(spark, f"{root}/data")
    own = parts(spark, root, version)
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    data = spark.read.schema(StructType(list(schema.fields)).add("part", "string")).parquet(f"{root}/data")
    # a row for each folder, as many as the driver lists; the condition holds for all of them and lets them prune the scan
    return data.join(F.broadcast(own.filter("part > ''").select("part")), "part", "left_semi").select(*schema.names)


def refresh(rows: DataFrame, root: str, by: str, refreshed: DataFrame | None = None) -> int:
    """Put ``rows`` in place of their partitions as a new version and return its number.

    ``by`` is a string column of the rows. ``refreshed``: values of ``by`` that are replaced even if no row is left for them.
    """
    spark = rows.sparkSession
    before = current(spark, root)
    v, mark = before + 1, f"{before + 1:010d}_"
    fs, left = _fs(spark, f"{root}/data/part={mark}*")
    for f in fs.globStatus(left) or []:
        fs.delete(f.getPath(), True)
    rows.withColumn("part", F.concat(F.lit(mark), by)).write.mode("append").partitionBy("part").parquet(f"{root}/data")
    written = spark.read.schema("part string").parquet(f"{root}/data").filter(F.col("part").startswith(mark)).select("part", F.substring("part", len(mark) + 1, 1_000).alias("value")).distinct()
    gone = written.select("value") if refreshed is None else written.select("value").unionAll(refreshed.select(F.col(by).cast("string")))
    kept = parts(spark, root, before).join(gone, "value", "left_anti")
    kept.unionByName(written).coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/v={v}")
    _swap(spark, root, before, v)
    return v


def expire(spark: SparkSession, root: str) -> int:
    """Delete folders that the current version doesn't name and return their number. No reader of an older version, and no writer, may be running."""
    named = {r["part"] for r in parts(spark, root).collect()}  # as many as the driver lists folders
    fs, p = _fs(spark, f"{root}/data")
    old = [d.getPath() for d in (fs.listStatus(p) if fs.exists(p) else []) if d.getPath().getName().startswith("part=") and d.getPath().getName()[5:] not in named]
    for d in old:
        fs.delete(d, True)
    return len(old)
