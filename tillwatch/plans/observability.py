"""Hourly observability run: schema drift gate, freshness, debt."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators import observe
from tillwatch.schemas import FRESHNESS_HISTORY, SCHEMA_DIFFS, SCHEMA_SNAPSHOTS
from tillwatch.sources.tables import append_history, read_or_empty


class BreakingSchemaChange(RuntimeError):
    pass


def run_schema_check(spark: SparkSession, tables: dict[str, DataFrame], now: datetime,
                     prefix: str = "") -> DataFrame:
    """Diff each table against its latest stored snapshot, then store snapshot and diff.

    Raises after storing if a change is breaking.
    """
    current = observe.snapshot_schema(spark, tables, now)
    stored = read_or_empty(spark, f"{prefix}schema_snapshots", SCHEMA_SNAPSHOTS)
    diffs = observe.diff_snapshots(current, stored, F.lit(now).cast("timestamp_ntz"))
    append_history(diffs, f"{prefix}schema_diffs")
    append_history(current, f"{prefix}schema_snapshots")
    latest = spark.table(f"{prefix}schema_diffs").filter(
        F.col("checked_at") == F.lit(now).cast("timestamp_ntz"))
    # one row per watched table
    broken = [r["source_name"] for r in latest.filter("is_breaking").orderBy("source_name").collect()]
    if broken:
        raise BreakingSchemaChange(f"breaking schema changes: {broken}")
    return latest


def run_freshness_check(spark: SparkSession, tables: dict[str, DataFrame], now: datetime,
                        prefix: str = "", **settings) -> DataFrame:
    """Check and store freshness; returns the notices of stale tables, which do not fail the run."""
    at = F.lit(now).cast("timestamp_ntz")
    append_history(observe.check_freshness(tables, at, **settings), f"{prefix}freshness_history")
    stored = spark.table(f"{prefix}freshness_history").filter(F.col("checked_at") == at)
    return observe.stale_notices(stored)


def debt(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Data-debt score over the stored histories; a missing history counts as no debt."""
    return observe.data_debt(
        read_or_empty(spark, f"{prefix}freshness_history", FRESHNESS_HISTORY),
        read_or_empty(spark, f"{prefix}schema_diffs", SCHEMA_DIFFS),
    )


def latest(spark: SparkSession, prefix: str = "") -> dict[str, DataFrame]:
    """Latest freshness and drift per table; empty while nothing has been stored."""
    return {
        "freshness": observe.latest_freshness(
            read_or_empty(spark, f"{prefix}freshness_history", FRESHNESS_HISTORY)),
        "schema_drift": observe.diff_json(observe.latest_schema_drift(
            read_or_empty(spark, f"{prefix}schema_diffs", SCHEMA_DIFFS))),
    }
