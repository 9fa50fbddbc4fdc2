"""The alerts table and every read on top of it.

Alerts are appended, never trimmed, and every count reads all of them.
Arrival order is (batch_id, tx_at, tx_id), newest first.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwatch.functions.exact import count_where
from tillwatch.functions.fixed import DAY_NAMES
from tillwatch.functions.timegrid import as_utc, floor_hour, zoneless
from tillwatch.schemas import ALERT_FIELDS
from tillwatch.sources.messages import json_columns

# Longest page of recent alerts, breaker threshold and hold time.
MAX_ALERTS = 1000
BREAKER_RATE = 0.20
BREAKER_SECONDS = 300


def to_alerts(flagged: DataFrame, batch_id: Column | str) -> DataFrame:
    """Flagged transactions as alert rows; ``tx_at`` becomes text."""
    batch = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    return flagged.select(
        batch.cast("bigint").alias("batch_id"),
        "tx_id",
        "user_id",
        "merchant",
        F.col("amount").cast("double").alias("amount"),
        F.col("country_code").alias("country"),
        zoneless(flagged, "tx_at").cast("string").alias("tx_at"),
        F.coalesce("fraud_score", F.lit(1)).alias("fraud_score"),
        F.coalesce("triggered_rules", F.lit("")).alias("triggered_rules"),
        F.coalesce("velocity_score", F.lit(0)).alias("velocity_score"),
        F.coalesce("amount_spike_flag", F.lit(False)).alias("amount_spike"),
        F.coalesce("geo_anomaly_flag", F.lit(False)).alias("geo_anomaly"),
    )


def alert_payload(alerts: DataFrame) -> DataFrame:
    """``key`` = user_id, ``value`` = the eleven fields as JSON, nulls kept."""
    body = F.to_json(F.struct(*StructType.fromDDL(ALERT_FIELDS).names), {"ignoreNullFields": "false"})
    return alerts.select(F.col("user_id").alias("key"), body.alias("value"))


def read_alert_payload(messages: DataFrame) -> DataFrame:
    """Alert columns of stored JSON; records that are not alerts are skipped."""
    return (
        json_columns(messages, ALERT_FIELDS)
        .filter(F.col("tx_id").isNotNull() & F.col("user_id").isNotNull())
        .fillna({"fraud_score": 0, "velocity_score": 0,
                 "amount_spike": False, "geo_anomaly": False})
    )


def _newest_first() -> list[Column]:
    return [F.desc("batch_id"), F.desc("tx_at"), F.desc("tx_id")]


def recent_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The newest ``limit`` (1..1000) alerts, newest first."""
    if not 1 <= limit <= MAX_ALERTS:
        raise ValueError(f"limit has to be within 1..{MAX_ALERTS}")
    return alerts.orderBy(*_newest_first()).limit(limit)


def _alert_time() -> Column:
    """tx_at text as a zone-less UTC time; unreadable text is null.

    Text with an offset is shifted to UTC, text without one is UTC already.
    """
    text = F.col("tx_at")
    zoned = text.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, as_utc(F.try_to_timestamp(text))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def alert_trend_hourly(alerts: DataFrame, now: Column) -> DataFrame:
    """Alert counts per hour of the last 24 hours before ``now``."""
    return (
        alerts.withColumn("_t", _alert_time())
        .filter(F.col("_t") >= now - F.expr("interval 24 hours"))
        .groupBy(floor_hour(F.col("_t")).alias("_h"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.date_format("_h", "yyyy-MM-dd'T'HH:mm:ss").alias("hour"), "count")
        .orderBy("hour")
    )


def _day_hour_counts(alerts: DataFrame) -> DataFrame:
    return (
        alerts.withColumn("_t", _alert_time())
        .filter(F.col("_t").isNotNull())
        .groupBy(F.weekday("_t").alias("day_no"), F.hour("_t").alias("hour"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def alert_heatmap(alerts: DataFrame) -> DataFrame:
    """Counts for each of the 7 x 24 (day, hour) cells, zero where there is no alert."""
    return _heatmap(_day_hour_counts(alerts))


def _heatmap(counts: DataFrame) -> DataFrame:
    grid = counts.sparkSession.range(168).select(
        F.floor(F.col("id") / 24).cast("int").alias("day_no"),
        (F.col("id") % 24).cast("int").alias("hour"),
    )
    day = F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.col("day_no") + 1)
    return (
        # at most 168 count rows
        grid.join(F.broadcast(counts), ["day_no", "hour"], "left")
        .select("day_no", day.alias("day"), "hour",
                F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))
        .orderBy("day_no", "hour")
    )


def alert_heatmap_pivot(alerts: DataFrame) -> DataFrame:
    """The heatmap as seven rows, Monday first, with columns h00..h23."""
    return _pivot(alert_heatmap(alerts))


def _pivot(heatmap: DataFrame) -> DataFrame:
    cells = [
        F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("count"))), F.lit(0).cast("bigint"))
        .alias(f"h{h:02d}")
        for h in range(24)
    ]
    return heatmap.groupBy("day_no", "day").agg(*cells).orderBy("day_no")


def alert_totals(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("total_fraud_alerts"))


def alerts_by_user(alerts: DataFrame) -> DataFrame:
    """Alert count and cumulative score per user."""
    return alerts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.sum("fraud_score").alias("total_score"),
    )


def top_flagged_users(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Users by cumulative score; equal scores by user_id descending."""
    return (
        alerts.groupBy("user_id")
        .agg(F.sum("fraud_score").alias("total_score"))
        .orderBy(F.desc("total_score"), F.desc("user_id"))
        .limit(limit)
    )


def circuit_breaker(scored: DataFrame, closed_at: Column, threshold: float = BREAKER_RATE,
                    hold_seconds: int = BREAKER_SECONDS) -> DataFrame:
    """Per ``batch_id``: flagged share of all scored rows and, above ``threshold``, until when
    publishing stays off (``closed_at`` + hold).  ``closed_at`` is an aggregate over the batch."""
    rate = F.col("flagged_tx") / F.col("scored_tx")
    return (
        scored.groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("scored_tx"),
            count_where(F.col("is_flagged")).alias("flagged_tx"),
            closed_at.alias("_closed"),
        )
        .withColumn("fraud_rate", rate)
        .withColumn("tripped", F.col("fraud_rate") > threshold)
        .withColumn(
            "flag_until",
            F.when(F.col("tripped"),
                   F.timestamp_add("SECOND", F.lit(hold_seconds), F.col("_closed"))),
        )
        .drop("_closed")
    )


def breaker_active(breaker_log: DataFrame, now: Column) -> DataFrame:
    """One row: is any batch's hold still running at ``now``."""
    return breaker_log.agg(
        F.coalesce(F.max(F.col("flag_until") > now), F.lit(False)).alias("circuit_breaker_active")
    )


def alert_stats(alerts: DataFrame, breaker_log: DataFrame, now: Column, top: int = 10
                ) -> DataFrame:
    """One row: alert total, breaker state, the top users as an array of structs, best first."""
    best = top_flagged_users(alerts, top).agg(
        F.sort_array(F.collect_list(F.struct("total_score", "user_id")), asc=False)
        .alias("top_flagged_users")
    )
    return alert_totals(alerts).select(
        "total_fraud_alerts",
        breaker_active(breaker_log, now).scalar().alias("circuit_breaker_active"),
        best.scalar().alias("top_flagged_users"),
    )


def stats_of_scored(scored: DataFrame, closed_at: Column, now: Column, top: int = 10) -> DataFrame:
    """``alert_stats`` from scored rows with a ``batch_id``, which are read once.

    Rows become counts per (batch, user); those are summed per batch and per user together, and each
    task cuts its own users to the ``top`` before they meet.
    """
    flagged = F.col("is_flagged")
    counts = scored.groupBy("batch_id", "user_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        count_where(flagged).alias("_flagged"),
        F.sum(F.when(flagged, F.coalesce("fraud_score", F.lit(1)))).alias("_score"),
        closed_at.alias("_closed"),
    )
    of_user = F.grouping("user_id") == 0
    sums = counts.groupingSets([["batch_id"], ["user_id"]], "batch_id", "user_id").agg(
        of_user.alias("_of_user"),
        F.sum("_rows").alias("_rows"),
        F.sum("_flagged").alias("_flagged"),
        F.sum("_score").alias("_score"),
        F.max("_closed").alias("_closed"),
    ).filter(~F.col("_of_user") | (F.col("_flagged") > 0))
    # every batch is a partition of its own here and stays
    order = Window.partitionBy("_of_user", "batch_id").orderBy(F.desc("_score"), F.desc("user_id"))
    kept = sums.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= top)
    held = F.timestamp_add("SECOND", F.lit(BREAKER_SECONDS), F.col("_closed")) > now
    tripped = F.col("_flagged") / F.col("_rows") > BREAKER_RATE
    best = F.when(F.col("_of_user"),
                  F.struct(F.col("_score").alias("total_score"), F.col("user_id").alias("user_id")))
    return kept.agg(
        F.coalesce(F.sum(F.when(~F.col("_of_user"), F.col("_flagged"))), F.lit(0))
        .alias("total_fraud_alerts"),
        F.coalesce(F.max(F.when(~F.col("_of_user") & tripped, held)), F.lit(False))
        .alias("circuit_breaker_active"),
        F.sort_array(F.collect_list(best), asc=False).alias("top_flagged_users"),
    )


# ---------------------------------------------------------------- roll-up

def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Alerts and score per (hour, user): ROLLUP.  Roll-ups add up, so batches may be summed in any order.

    ``hour`` is null for alerts whose time cannot be read, which no time feed counts.
    """
    return alerts.groupBy(floor_hour(_alert_time()).alias("hour"), "user_id").agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("fraud_score").alias("score"))


def merge_rollups(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("hour", "user_id").agg(F.sum("alerts").alias("alerts"), F.sum("score").alias("score"))


def rollup_totals(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.coalesce(F.sum("alerts"), F.lit(0)).alias("total_fraud_alerts"))


def rollup_by_user(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("user_id").agg(F.sum("alerts").alias("alert_count"), F.sum("score").alias("total_score"))


def rollup_top_users(rollup: DataFrame, limit: int = 10) -> DataFrame:
    return (
        rollup.groupBy("user_id").agg(F.sum("score").alias("total_score"))
        .orderBy(F.desc("total_score"), F.desc("user_id")).limit(limit)
    )


def rollup_heatmap(rollup: DataFrame) -> DataFrame:
    return _heatmap(
        rollup.filter(F.col("hour").isNotNull())
        .groupBy(F.weekday("hour").alias("day_no"), F.hour("hour").alias("hour"))
        .agg(F.sum("alerts").alias("count"))
    )


def rollup_heatmap_pivot(rollup: DataFrame) -> DataFrame:
    return _pivot(rollup_heatmap(rollup))


def rollup_trend_hourly(rollup: DataFrame, now: datetime, alerts: DataFrame | None = None) -> DataFrame:
    """Alert counts per hour of the last 24 hours before ``now`` (UTC).

    Whole hours come from the roll-up.  Unless ``now`` is on the hour, the oldest one is cut, and only for
    that hour ``alerts`` are read.
    """
    start = now - timedelta(hours=24)
    cut = start.replace(minute=0, second=0, microsecond=0)
    whole = cut if cut == start else cut + timedelta(hours=1)
    counts = rollup.filter(F.col("hour") >= F.lit(whole).cast("timestamp_ntz")).select("hour", F.col("alerts").alias("n"))
    if whole != cut:
        if alerts is None:
            raise ValueError("now is not on the hour: the alerts of the cut hour are needed")
        edge = alerts.withColumn("_t", _alert_time()).filter(
            (F.col("_t") >= F.lit(start).cast("timestamp_ntz")) & (F.col("_t") < F.lit(whole).cast("timestamp_ntz")))
        counts = counts.unionByName(edge.select(floor_hour(F.col("_t")).alias("hour"), F.lit(1).cast("bigint").alias("n")))
    return (
        counts.groupBy("hour").agg(F.sum("n").alias("count"))
        .select(F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss").alias("hour"), "count").orderBy("hour")
    )
