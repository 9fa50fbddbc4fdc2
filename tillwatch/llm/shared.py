"""Tables in the cluster's shared folder, and broadcasts behind a check of their size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.session import checkpoint_root
from tillwatch.sources.batches import Folder

#: Most rows of narrow integers (ids, hashes) that are broadcast; about 30 MB in an executor.
BROADCAST_ROWS = 500_000
#: Bytes of an Arrow batch for a Python worker (one longer text makes a longer batch).  The JVM holds a batch
#: about three times outside its heap, the worker once or twice, and that for every running task.
BATCH = "2m"
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and the master is one local process."""
    return checkpoint_root(spark)


def stored(df: DataFrame, name: str, scratch: list[DataFrame] | None = None) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors.

    What is put on a `scratch` list is deleted by `discard` when its last reader is done.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    if scratch is not None:
        scratch.append(found)
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `stored` wrote, once nothing reads them any more."""
    for df in tables:
        folder, name = df.stored_at.rsplit("/", 1)
        Folder(df.sparkSession, folder).remove(name)


def narrow_batches(spark: SparkSession) -> None:
    """From now on texts go to Python workers in batches of BATCH, unless the session names another size."""
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH)


def texts_of(docs: DataFrame, doc_id: str, text: str, carry: list[str] | None = None) -> DataFrame:
    """doc_id, text and, in one struct that no name of theirs can clash with, the columns to carry along."""
    narrow_batches(docs.sparkSession)
    rest = [F.struct(*(F.col(c) for c in carry)).alias("rest")] if carry else []
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *rest)


def with_rest(ddl: str, rows: DataFrame) -> T.StructType:
    """The schema of a DDL text, and the carried struct if rows have one."""
    schema = T.StructType.fromDDL(ddl)
    return schema.add("rest", rows.schema["rest"].dataType) if "rest" in rows.columns else schema


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored df, marked for broadcast if it has at most `rows` rows; else Spark shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
