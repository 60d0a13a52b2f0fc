"""Several tables written by one stream, each micro-batch exactly once in all of them.

A micro-batch writes each table under ``query=<id>/batch=<n>`` in place of whatever an attempt before has left there, and then
a row (table, query, batch) in a ledger. A batch that is run again, after a failure between two tables or before the checkpoint knew of it,
leaves out tables that the ledger names. Readers see what the ledger names: the two partition columns meet it by a semi join with a
broadcast of its rows (one for each batch and table, three short columns), which also prunes the folders that are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

LEDGER = "table string, query string, batch long"


def stored_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # only a table that has not been written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def committed(spark: SparkSession, name: str, path: str, ledger: str, schema: StructType) -> DataFrame:
    """Rows of a table in batches that the ledger names."""
    whole = StructType(list(schema.fields)).add("query", "string").add("batch", "long")
    # any batch number is at least 0; the condition says to the planner that the ledger selects folders
    own = stored_rows(spark, ledger, LEDGER).filter((F.col("table") == name) & (F.col("batch") >= 0)).select("query", "batch")
    return stored_rows(spark, path, whole).join(F.broadcast(own), ["query", "batch"], "left_semi").select(*schema.names)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream has kept in its checkpoint since its first start."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def write_tables(stream: DataFrame, tables: list[tuple[str, str, Callable[[DataFrame], DataFrame]]], ledger: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write (name, path, rows of a micro-batch) in order, each batch once in each; a later table's rows may read the earlier ones."""

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        own = query_id(spark, checkpoint)
        done = {r["table"] for r in stored_rows(spark, ledger, LEDGER).filter((F.col("query") == own) & (F.col("batch") == n)).select("table").collect()}
        batch.persist()
        try:
            for name, path, rows in tables:
                if name not in done:
                    rows(batch).write.mode("overwrite").parquet(f"{path}/query={own}/batch={n}")
                    spark.createDataFrame([(name, own, n)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
