"""Stored tables: partitioned parquet, append-only history, bucketed raw transactions.

Micro-batches of streams are in :mod:`tillwatch.sources.batches`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """A catalog table, or no rows of the declared schema while it does not exist yet."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], StructType.fromDDL(schema))


def append_history(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").format("parquet").saveAsTable(table)


def append_bucketed(rows: DataFrame, table: str, key: str = "tx_id", buckets: int = 256) -> None:
    """Append to a table bucketed by ``key``: later joins and lookups on the key leave the stored
    side where it is.  Choose ``buckets`` so that one bucket of one load stays near 1 GB."""
    (
        # one writer per bucket, hence one file per bucket and load
        rows.repartition(buckets, key)
        .write.mode("append").format("parquet")
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


def overwrite_table(rows: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Materialise a model; marts are partitioned by date so that date filters prune files.

    Rows of one date are brought together so that a date has few files, but by rebalancing: adaptive
    execution splits a date that is too large for one task and merges small ones.
    """
    if partition_by:
        writer = rows.hint("rebalance", partition_by).write.partitionBy(partition_by)
    else:
        writer = rows.write
    writer.mode("overwrite").format("parquet").saveAsTable(table)


def run_of(spark: SparkSession) -> str:
    """The running streaming query's id, which lives in its checkpoint; batch ids count from 0 in each."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
