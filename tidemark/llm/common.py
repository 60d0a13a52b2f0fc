"""Shared helpers: tables, identifiers and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """One table of ``sf_dir`` with the named columns only."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text in order; empty array for an empty text."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def crc_mod(name: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n."""
    return F.crc32(F.col(name).cast("string")) % F.lit(n)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; on a local master a temporary one where none is named, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_paths: WeakKeyDictionary = WeakKeyDictionary()


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored tables of which all that is still needed has been stored in turn."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_paths.pop(t))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
