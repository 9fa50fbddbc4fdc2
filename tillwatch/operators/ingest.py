"""Idempotent ingest: defaults, high-water mark, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.timegrid import as_utc, zoneless

# Column defaults of the raw transaction table.
DEFAULT_CURRENCY = "VND"
DEFAULT_IS_FRAUD = False


def with_defaults(parsed: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Parsed messages in the raw table's types, with its column defaults; ``arrival`` is kept."""
    return parsed.select(
        *(["arrival"] if "arrival" in parsed.columns else []),
        "tx_id",
        "user_id",
        "merchant",
        F.col("amount").cast("decimal(15,2)").alias("amount"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        "country",
        zoneless(parsed, "tx_at").alias("tx_at"),
        "device",
        F.coalesce("is_fraud", F.lit(DEFAULT_IS_FRAUD)).alias("is_fraud"),
        "fraud_reason",
        (ingested_at if ingested_at is not None else as_utc(F.current_timestamp())).alias("ingested_at"),
    )


def high_water_mark(table: DataFrame) -> DataFrame:
    """One row: ``mark`` = max(tx_at), null for an empty table."""
    return table.agg(F.max("tx_at").alias("mark"))


def above_mark(incoming: DataFrame, table: DataFrame) -> DataFrame:
    """Incoming rows later than the table's newest; all rows when the table is empty.

    Optional: late rows at or before the mark are lost even if they were never stored, while
    :func:`insert_if_absent` alone is already idempotent.
    """
    mark = high_water_mark(table).scalar()
    return incoming.filter(mark.isNull() | (F.col("tx_at") > mark))


def first_per_key(incoming: DataFrame, key: str = "tx_id", arrival: str | None = None) -> DataFrame:
    """One row per key, the first to arrive.  Null keys drop.

    ``arrival`` is any orderable column, by default the source position ``arrival``
    (:func:`tillwatch.sources.messages.positioned`) if there is one, else the event time ``tx_at``.
    A copy without one comes last; ties fall to the event time and the other columns.

    An aggregate rather than a ranking: copies of one key collapse before the shuffle.
    """
    columns = incoming.columns
    arrival = arrival or ("arrival" if "arrival" in columns else "tx_at")
    ties = [c for c in ("tx_at",) if c in columns and c != arrival]
    ordered = [arrival] + ties + [c for c in columns if c not in (key, arrival, *ties)]
    late = [F.col(c).isNull().alias(f"_late_{c}") for c in (arrival, *ties)]
    return (
        incoming.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(late[0], arrival, *late[1:], *ordered[1:])).alias("_row"))
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in columns])
    )


def insert_if_absent(incoming: DataFrame, table: DataFrame, key: str = "tx_id",
                     arrival: str | None = None) -> DataFrame:
    """The rows to append: one per new key, the first to arrive.

    Only the table's key column is read.  Bucket the stored table by the key
    (:func:`tillwatch.sources.tables.append_bucketed`) to keep its side of the join in place; a stream
    asks an index instead (:class:`tillwatch.sources.key_index.KeyIndex`).
    """
    return first_per_key(incoming, key, arrival).join(table.select(key), key, "left_anti")
