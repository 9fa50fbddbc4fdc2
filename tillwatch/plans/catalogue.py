"""Named queries over the test tables, each ``(spark, sf_dir) -> DataFrame``.

The transaction tables come from ``events`` through the adapter; the observability histories are
derived from ``events`` too: one freshness check per (event type, day), and one schema snapshot per
(event type, day) made of the payload keys seen that day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.fixed import lookup
from tillwatch.functions.timegrid import as_utc
from tillwatch.operators import alerts as al
from tillwatch.operators import ingest, observe, quality, revenue, rules
from tillwatch.operators.staging import stg_transactions
from tillwatch.sources import messages
from tillwatch.sources.events_adapter import event_messages, raw_transactions, read_table

Query = Callable[[SparkSession, str], DataFrame]

# Rule windows for the sparse test events: a day instead of a minute for velocity.
VELOCITY = {"window": "24 hours", "slide": "1 hour"}
SLA_BY_TYPE = {"click": 0.5, "view": 0.4, "purchase": 1.0, "signup": 0.25, "error": 0.6}


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# The tables of the folder.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
NOW = "2024-01-31 00:00:00"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_transactions(events(spark, sf))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return stg_transactions(raw(spark, sf))


def merchant_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.int_merchant_revenue(staged(spark, sf))


def user_daily(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.int_user_daily_summary(staged(spark, sf))


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.mart_revenue_daily(merchant_revenue(spark, sf))


def fraud_report(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.mart_fraud_report(user_daily(spark, sf))


def to_score(spark: SparkSession, sf: str) -> DataFrame:
    """The staged columns the rules and alerts need."""
    return staged(spark, sf).select(
        "tx_id", "user_id", "merchant", "amount", "country_code", "tx_at", "tx_date"
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return rules.score_transactions(
        to_score(spark, sf), velocity_window=VELOCITY["window"], velocity_slide=VELOCITY["slide"]
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alert rows, one batch per day."""
    return al.to_alerts(rules.flagged_transactions(scored(spark, sf)), F.unix_date("tx_date"))


def _in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows, one batch per day."""
    return scored(spark, sf).withColumn("batch_id", F.unix_date("tx_date").cast("bigint"))


def breaker_log(spark: SparkSession, sf: str) -> DataFrame:
    return al.circuit_breaker(_in_batches(spark, sf), closed_at=F.max("tx_at"))


def freshness_history(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz")
    checks = events(spark, sf).groupBy(
        F.col("event_type").alias("source_name"), day.alias("checked_at")
    ).agg(F.max("ts").alias("last_updated"))
    return observe.with_freshness(
        checks.withColumn("sla_hours", lookup(F.col("source_name"), SLA_BY_TYPE, 1.0))
    )


def schema_history(spark: SparkSession, sf: str) -> DataFrame:
    """Column rows per (event type, day): payload keys seen, 'double' where values reach 100."""
    key = F.get_json_object("props", "$.k")
    seen = events(spark, sf).groupBy(
        F.col("event_type").alias("source_name"),
        F.to_date("ts").cast("timestamp_ntz").alias("snapshot_at"),
        key.cast("int").alias("ordinal"),
    ).agg(F.max("value").alias("_top"))
    return seen.select(
        "source_name", "snapshot_at", "ordinal",
        F.concat(F.lit("k"), F.col("ordinal").cast("string")).alias("column_name"),
        F.when(F.col("_top") >= 100, "double").otherwise("int").alias("data_type"),
        F.lit(True).alias("is_nullable"),
        F.lit(None).cast("string").alias("column_default"),
    )


def diff_text(diffs: DataFrame) -> DataFrame:
    """Array columns as text, one comparable value per cell."""
    retyped = F.transform("type_changed", lambda c: F.concat_ws(":", c["column"], c["from"], c["to"]))
    return diffs.select(
        "source_name", "checked_at", "has_changes", "is_breaking",
        F.array_join("added", ",").alias("added"),
        F.array_join("removed", ",").alias("removed"),
        F.array_join(retyped, ",").alias("type_changed"),
    )


def _relations(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "raw_transactions": raw(spark, sf),
        "stg_transactions": staged(spark, sf),
        "mart_revenue_daily": mart(spark, sf),
        "mart_fraud_report": fraud_report(spark, sf),
    }


def _score_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "tx_id", "user_id", "tx_at", "tx_count_60s", "velocity_score", "user_median_amount",
        "amount_spike_flag", "geo_anomaly_flag", "fraud_score", "triggered_rules", "is_flagged",
    )


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    parsed = messages.parse_transactions(event_messages(events(spark, sf)))
    return parsed.withColumn("tx_at", as_utc(F.col("tx_at")))


def _first_half(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the lower half of the ids."""
    rows = events(spark, sf)
    return rows.filter(F.col("event_id") * 2 < rows.agg(F.max("event_id")).scalar())


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table with the first half of the events."""
    return raw_transactions(_first_half(spark, sf))


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    """Every transaction twice, the copy with a time one hour earlier; it arrives later, but for each
    seventh event before the original."""
    once = raw_transactions(events(spark, sf), keep=["event_id"])
    first = F.col("event_id") % 7 == 3
    copy = once.withColumn("tx_at", F.col("tx_at") - F.expr("interval 1 hour"))
    place = F.col("event_id") * 2
    both = once.withColumn("arrival", place + F.when(first, 1).otherwise(0)).unionByName(
        copy.withColumn("arrival", place + F.when(first, 0).otherwise(1)))
    return both.drop("event_id")


def _watched_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, staged and parsed relations checked at NOW by their own timestamp columns."""
    tables = {
        "raw_transactions": raw(spark, sf),
        "stg_transactions": staged(spark, sf),
        "orders": read_table(spark, sf, "orders"),
    }
    return observe.check_freshness(
        tables, at(NOW), sla_hours={"raw_transactions": 1.0, "stg_transactions": 0.1,
                                    "orders": 24.0},
        columns={"raw_transactions": "ingested_at", "stg_transactions": "tx_at",
                 "orders": "o_orderdate"},
    )


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    now = at("2024-01-15 00:00:00")
    user = F.transform("top_flagged_users",
                       lambda u: F.concat_ws(":", u["user_id"], u["total_score"].cast("string")))
    stats = al.stats_of_scored(_in_batches(spark, sf), F.max("tx_at"), now)
    return stats.withColumn("top_flagged_users", F.array_join(user, ","))


def _read_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Stored alert messages read back; every geo anomaly was cut off after 20 characters, and
    messages of a single rule carry no user."""
    sent = alerts(spark, sf)
    body = F.to_json(F.struct(
        "tx_id", F.when(F.col("fraud_score") > 1, F.col("user_id")).alias("user_id"),
        "amount", "fraud_score", "triggered_rules",
    ))
    cut = F.when(F.col("geo_anomaly"), F.substring(body, 1, 20)).otherwise(body)
    return al.read_alert_payload(sent.select(cut.alias("value")))


def _stored_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The newest snapshot of each source against all that were stored before it."""
    history = schema_history(spark, sf)
    newest = observe.latest_snapshot(history)
    stored = history.join(newest.select("source_name", "snapshot_at").distinct(), ["source_name", "snapshot_at"], "left_anti")
    return diff_text(observe.diff_snapshots(newest, stored, at(NOW)))


def _debt(spark: SparkSession, sf: str) -> DataFrame:
    debt = observe.data_debt(
        freshness_history(spark, sf), observe.diff_history(schema_history(spark, sf))
    )
    return debt.withColumn("details", F.array_join("details", "; "))


def queries() -> dict[str, Query]:
    d = revenue.doubles
    return {
        # ingest
        "parse_json_events": _parsed,
        "dead_letter_counts":
            lambda s, sf: messages.dead_letter_counts(event_messages(events(s, sf))),
        "ingest_above_watermark":
            lambda s, sf: d(ingest.above_mark(raw(s, sf), _stored(s, sf))),
        "insert_if_absent":
            lambda s, sf: d(ingest.insert_if_absent(_delivered(s, sf), _stored(s, sf)).drop("arrival")),
        # staging and models
        "stg_transactions": lambda s, sf: d(staged(s, sf)),
        "int_merchant_revenue": lambda s, sf: d(merchant_revenue(s, sf)),
        "int_user_daily_summary": lambda s, sf: d(user_daily(s, sf)),
        "merchant_category": lambda s, sf: revenue.merchant_category(staged(s, sf)),
        "mart_revenue_daily": lambda s, sf: d(mart(s, sf)),
        "mart_fraud_report":
            lambda s, sf: d(revenue.fraud_report_ranked(fraud_report(s, sf))),
        # revenue reads
        "revenue_by_merchant": lambda s, sf: d(revenue.revenue_by_merchant(mart(s, sf))),
        "revenue_by_country": lambda s, sf: d(revenue.revenue_by_country(mart(s, sf))),
        "country_distribution": lambda s, sf: revenue.country_distribution(mart(s, sf)),
        "revenue_daily_recent": lambda s, sf: d(revenue.revenue_daily(mart(s, sf))),
        "revenue_daily_by_merchant":
            lambda s, sf: d(revenue.revenue_daily(mart(s, sf), merchant="Grab")),
        "fraud_rate_trend": lambda s, sf: d(revenue.fraud_rate_trend(mart(s, sf))),
        "overall_fraud_rate": lambda s, sf: d(revenue.overall_fraud_rate(mart(s, sf))),
        # rules
        "velocity_windows": lambda s, sf: rules.velocity_windows(to_score(s, sf), **VELOCITY),
        "velocity_score": lambda s, sf: rules.velocity_score(to_score(s, sf), **VELOCITY)
            .select("tx_id", "user_id", "tx_at", "tx_count_60s", "velocity_score"),
        "velocity_score_60s": lambda s, sf: rules.velocity_score(to_score(s, sf))
            .select("tx_id", "user_id", "tx_at", "tx_count_60s", "velocity_score"),
        "amount_windows": lambda s, sf: d(rules.amount_windows(to_score(s, sf))),
        "amount_spike": lambda s, sf: d(rules.amount_spike(to_score(s, sf)).select(
            "tx_id", "user_id", "tx_at", "amount", "user_median_amount", "amount_spike_flag")),
        "geo_pairs": lambda s, sf: rules.geo_pairs(to_score(s, sf)),
        "geo_anomaly": lambda s, sf: rules.geo_anomaly(to_score(s, sf)).select(
            "tx_id", "user_id", "country_code", "tx_at", "geo_anomaly_flag"),
        "fraud_score": lambda s, sf: _score_columns(scored(s, sf)),
        "flagged_transactions":
            lambda s, sf: _score_columns(rules.flagged_transactions(scored(s, sf))),
        # alerts
        "alerts": alerts,
        "alert_payload_json": lambda s, sf: al.alert_payload(alerts(s, sf)),
        "alert_state_totals": lambda s, sf: al.alert_totals(alerts(s, sf)).withColumn(
            "raw_transactions", raw(s, sf).agg(F.count(F.lit(1))).scalar()),
        "alert_state_by_user": lambda s, sf: al.alerts_by_user(alerts(s, sf)),
        "top_flagged_users": lambda s, sf: al.top_flagged_users(alerts(s, sf)),
        "recent_alerts": lambda s, sf: al.recent_alerts(alerts(s, sf)),
        "fraud_trend_hourly": lambda s, sf: al.alert_trend_hourly(alerts(s, sf), at(NOW)),
        "fraud_heatmap": lambda s, sf: al.alert_heatmap(alerts(s, sf)),
        "fraud_heatmap_pivot": lambda s, sf: al.alert_heatmap_pivot(alerts(s, sf)),
        "circuit_breaker_rate": breaker_log,
        "alert_stats": _stats,
        "alerts_read_back": _read_alerts,
        # alert feeds from the roll-up
        "alert_rollup": lambda s, sf: al.alert_rollup(alerts(s, sf)),
        "rollup_top_users": lambda s, sf: al.rollup_top_users(al.alert_rollup(alerts(s, sf))),
        "rollup_heatmap": lambda s, sf: al.rollup_heatmap(al.alert_rollup(alerts(s, sf))),
        "rollup_trend_hourly": lambda s, sf: al.rollup_trend_hourly(al.alert_rollup(alerts(s, sf)), datetime.fromisoformat(NOW)),
        # quality
        "dq_not_null": lambda s, sf: quality.check_not_null(_relations(s, sf)),
        "dq_unique": lambda s, sf: quality.check_unique(_relations(s, sf)),
        "dq_profile": lambda s, sf: quality.profile_all(_relations(s, sf)),
        "dq_accepted_values": lambda s, sf: quality.check_accepted_values(_relations(s, sf)),
        "dq_no_negative_amount": lambda s, sf: d(quality.negative_amounts(raw(s, sf))),
        "dq_fraud_rate_band": lambda s, sf: d(quality.fraud_rate_outside(
            revenue.overall_fraud_rate(mart(s, sf)))),
        "dq_fraud_rate_tight_band": lambda s, sf: d(quality.fraud_rate_outside(
            revenue.overall_fraud_rate(mart(s, sf)), 0.1, 1.0)),
        # observability
        "table_metadata": lambda s, sf: observe.table_metadata(s, {t: f"{sf}/{t}.parquet" for t in TABLES}),
        "schema_snapshot": lambda s, sf: observe.latest_snapshot(schema_history(s, sf)),
        "schema_diff":
            lambda s, sf: diff_text(observe.diff_history(schema_history(s, sf))),
        "latest_schema_drift": lambda s, sf: diff_text(observe.latest_schema_drift(
            observe.diff_history(schema_history(s, sf)))),
        "stored_schema_drift": _stored_drift,
        "freshness_status": _watched_freshness,
        "freshness_history": freshness_history,
        "latest_freshness": lambda s, sf: observe.latest_freshness(freshness_history(s, sf)),
        "stale_notices": lambda s, sf: observe.stale_notices(freshness_history(s, sf)),
        "data_debt": _debt,
    }
