"""Schema snapshots and drift, freshness against SLAs, the composite data-debt score."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tillwatch.functions.exact import count_where
from tillwatch.functions.timegrid import hours_between, zoneless
from tillwatch.schemas import SCHEMA_SNAPSHOTS

# Watched tables, SLA hours, timestamp column per table, status cut-offs, debt points.
WATCHED_SCHEMAS = ["raw_transactions", "fraud_alerts"]
SLA_HOURS = {"raw_transactions": 1.0, "mart_revenue_daily": 2.0}
FRESHNESS_COLUMN = {"raw_transactions": "ingested_at", "mart_revenue_daily": "updated_at"}
DEFAULT_FRESHNESS_COLUMN = "created_at"
FRESH_RATIO, WARNING_RATIO = 0.75, 1.0
STALE_POINTS, WARNING_POINTS = 20, 10
BREAKING_POINTS, CHANGE_POINTS = 25, 5
MAX_DEBT = 100


# ---------------------------------------------------------------- latest rows

def latest_per(df: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row per key, as an aggregate: partial maxima travel, not whole groups."""
    rest = [c for c in df.columns if c not in (key, at)]
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(at, *rest)).alias("_row"))
        .select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def latest_freshness(history: DataFrame) -> DataFrame:
    return latest_per(history, "source_name", "checked_at").orderBy("source_name")


def latest_schema_drift(diffs: DataFrame) -> DataFrame:
    return latest_per(diffs, "source_name", "checked_at").orderBy("source_name")


# ---------------------------------------------------------------- schema drift

def snapshot_schema(spark: SparkSession, tables: dict[str, DataFrame], at: datetime,
                    defaults: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """One row per column of each table, from table metadata alone (no data is read)."""
    defaults = defaults or {}
    rows = [
        (name, at, i, f.name, f.dataType.simpleString(), f.nullable,
         defaults.get(name, {}).get(f.name))
        for name, df in tables.items()
        for i, f in enumerate(df.schema, start=1)
    ]
    return spark.createDataFrame(rows, SCHEMA_SNAPSHOTS)


def read_for_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table read so that Spark answers counts from file footers alone.

    Spark does that in its newer reader only, which is chosen when the table is opened; the push-down setting
    stays on and concerns that reader alone.
    """
    older = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(older)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(older, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(older, before)


def table_metadata(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per column of each Parquet table: place, type, rows of the table, nulls of the column.

    Column chunks are not read: footers hold the counts, one task per group of files reads them, and a
    table of any size becomes one row before it is unpacked.  Nested columns have no count there; their
    ``nulls`` are null.
    """
    parts = []
    for name, path in paths.items():
        df = read_for_metadata(spark, path)
        flat = {f.name for f in df.schema if not isinstance(f.dataType, (ArrayType, MapType, StructType))}
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}")
                                                             for i, c in enumerate(df.columns) if c in flat])
        rows = F.array(*[
            F.struct(
                F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("is_nullable"), F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_{i}") if f.name in flat else F.lit(None).cast("bigint")).alias("nulls"),
            ) for i, f in enumerate(df.schema)
        ])
        parts.append(counts.select(F.lit(name).alias("source_name"), F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def metadata_snapshot(metadata: DataFrame, at: Column) -> DataFrame:
    """Metadata rows in the form of stored snapshots, for the drift checks."""
    return metadata.select(
        "source_name", at.alias("snapshot_at"), "ordinal", "column_name", "data_type", "is_nullable",
        F.lit(None).cast("string").alias("column_default"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """All column rows of each source's newest snapshot."""
    newest = snapshots.groupBy("source_name").agg(F.max("snapshot_at").alias("snapshot_at"))
    return snapshots.join(newest, ["source_name", "snapshot_at"], "left_semi")


def _diff(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: columns added, removed and retyped.  A key without any previous column is a
    baseline: no change.  Differences in nullability or default are not changes."""
    cur = current.select(*keys, "column_name", F.col("data_type").alias("_to"))
    prev = previous.select(*keys, "column_name", F.col("data_type").alias("_from"))
    both = cur.join(prev, [*keys, "column_name"], "full_outer")
    name = F.col("column_name")
    retyped = F.struct(name.alias("column"), F.col("_from").alias("from"), F.col("_to").alias("to"))

    def listed(value: Column, when: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(when, value)))

    known = F.count("_from") > 0
    grouped = both.groupBy(*keys).agg(
        known.alias("_known"),
        listed(name, F.col("_from").isNull()).alias("_added"),
        listed(name, F.col("_to").isNull()).alias("removed"),
        listed(retyped, F.col("_from") != F.col("_to")).alias("type_changed"),
    )
    nothing = F.array().cast("array<string>")
    breaking = (F.size("removed") > 0) | (F.size("type_changed") > 0)
    return grouped.select(
        *keys,
        (breaking | (F.col("_known") & (F.size("_added") > 0))).alias("has_changes"),
        breaking.alias("is_breaking"),
        F.when(F.col("_known"), F.col("_added")).otherwise(nothing).alias("added"),
        "removed",
        "type_changed",
    )


def diff_snapshots(current: DataFrame, previous: DataFrame, checked_at: Column) -> DataFrame:
    """Drift of each source in ``current`` against its newest snapshot in ``previous``.

    Sources that are only in ``previous`` are not being checked and give no row.
    """
    checked = current.select("source_name").distinct()
    before = latest_snapshot(previous).join(checked, "source_name", "left_semi")
    return _diff(current, before, ["source_name"]).select(
        "source_name", checked_at.alias("checked_at"),
        "has_changes", "is_breaking", "added", "removed", "type_changed",
    )


def diff_history(snapshots: DataFrame) -> DataFrame:
    """Drift of every stored snapshot against the same source's one before it."""
    taken = snapshots.select("source_name", "snapshot_at").distinct()
    steps = taken.withColumn(
        "_next",
        F.lead("snapshot_at").over(Window.partitionBy("source_name").orderBy("snapshot_at")),
    ).filter(F.col("_next").isNotNull())
    shifted = (
        snapshots.join(steps, ["source_name", "snapshot_at"])
        .drop("snapshot_at")
        .withColumnRenamed("_next", "snapshot_at")
    )
    return _diff(snapshots, shifted, ["source_name", "snapshot_at"]).withColumnRenamed(
        "snapshot_at", "checked_at"
    )


def diff_json(diffs: DataFrame) -> DataFrame:
    """Diffs with added/removed/type_changed as one JSON text."""
    payload = F.to_json(F.struct("added", "removed", "type_changed"))
    return diffs.select(
        "source_name", "checked_at", "has_changes", "is_breaking", payload.alias("diff_json")
    )


# ---------------------------------------------------------------- freshness

def freshness_status(last_updated: Column, hours: Column, sla_hours: Column) -> Column:
    """'fresh' up to 0.75 of the SLA, 'warning' up to 1.0, then 'stale'; never updated or an SLA
    that is not positive is 'stale'."""
    ratio = F.when(sla_hours > 0, hours / sla_hours).otherwise(F.lit(float("inf")))
    return (
        F.when(last_updated.isNull(), "stale")
        .when(ratio <= FRESH_RATIO, "fresh")
        .when(ratio <= WARNING_RATIO, "warning")
        .otherwise("stale")
    )


def with_freshness(checks: DataFrame) -> DataFrame:
    """(source_name, checked_at, last_updated, sla_hours) plus elapsed hours and status."""
    hours = F.coalesce(
        hours_between(F.col("last_updated"), F.col("checked_at")), F.lit(float("inf"))
    )
    return checks.withColumn("hours_since_update", hours).select(
        "source_name",
        "checked_at",
        "last_updated",
        "hours_since_update",
        "sla_hours",
        freshness_status(F.col("last_updated"), F.col("hours_since_update"), F.col("sla_hours"))
        .alias("status"),
    )


def check_freshness(tables: dict[str, DataFrame], now: Column,
                    sla_hours: dict[str, float] | None = None,
                    columns: dict[str, str] | None = None) -> DataFrame:
    """Newest timestamp of each watched table against its SLA.

    A table without its timestamp column counts as never updated.
    """
    sla_hours = SLA_HOURS if sla_hours is None else sla_hours
    columns = FRESHNESS_COLUMN if columns is None else columns
    parts = []
    for name, df in tables.items():
        column = columns.get(name, DEFAULT_FRESHNESS_COLUMN)
        if column in df.columns:
            newest = df.agg(F.max(column).alias("last_updated"))
            newest = newest.select(zoneless(newest, "last_updated").alias("last_updated"))
        else:
            newest = df.sparkSession.range(1).select(
                F.lit(None).cast("timestamp_ntz").alias("last_updated")
            )
        parts.append(newest.select(
            F.lit(name).alias("source_name"), now.alias("checked_at"), "last_updated",
            F.lit(float(sla_hours[name])).alias("sla_hours"),
        ))
    return with_freshness(reduce(DataFrame.unionByName, parts))


def stale_notices(freshness: DataFrame) -> DataFrame:
    """Notification text of each stale table; sending it is the caller's business."""
    hours = F.format_string("%.1f", F.col("hours_since_update"))
    shown = F.when(F.col("hours_since_update") == float("inf"), "inf").otherwise(hours)
    return freshness.filter(F.col("status") == "stale").select(
        "source_name",
        "checked_at",
        F.concat(
            F.col("source_name"), F.lit(": no update for "), shown,
            F.lit(" hours, allowed are "), F.col("sla_hours").cast("string"), F.lit("; newest row: "),
            F.coalesce(F.col("last_updated").cast("string"), F.lit("none")),
        ).alias("notice"),
    )


# ---------------------------------------------------------------- data debt

def data_debt(freshness_history: DataFrame, schema_diffs: DataFrame) -> DataFrame:
    """One row: ``data_debt_score`` (0..100, higher is worse), ``grade`` and the contributing
    factors, from each source's latest checks."""
    status = F.col("status")
    fresh = latest_per(freshness_history, "source_name", "checked_at").select(
        F.when(status == "stale", STALE_POINTS).when(status == "warning", WARNING_POINTS)
        .alias("points"),
        # fixed values: the texts of the factors, here and below
        F.when(status == "stale", f"stale table (+{STALE_POINTS})")
        .when(status == "warning", f"warning table (+{WARNING_POINTS})").alias("detail"),
    )
    breaking, changed = F.col("is_breaking"), F.col("has_changes")
    drift = latest_per(
        schema_diffs.select("source_name", "checked_at", "has_changes", "is_breaking"),
        "source_name", "checked_at",
    ).select(
        F.when(breaking, BREAKING_POINTS).when(changed, CHANGE_POINTS).alias("points"),
        F.when(breaking, f"breaking schema change (+{BREAKING_POINTS})")
        .when(changed, f"non-breaking schema change (+{CHANGE_POINTS})").alias("detail"),
    )
    score = F.least(F.coalesce(F.sum("points"), F.lit(0)), F.lit(MAX_DEBT))
    return fresh.unionByName(drift).agg(
        score.cast("int").alias("data_debt_score"),
        # one entry per watched table
        F.sort_array(F.collect_list("detail")).alias("details"),
    ).select("data_debt_score", _grade(F.col("data_debt_score")).alias("grade"), "details")


def _grade(score: Column) -> Column:
    return (
        F.when(score <= 10, "A").when(score <= 30, "B").when(score <= 50, "C")
        .when(score <= 70, "D").otherwise("F")
    )


def breaking_count(diffs: DataFrame) -> DataFrame:
    return diffs.agg(count_where(F.col("is_breaking")).alias("breaking"))
