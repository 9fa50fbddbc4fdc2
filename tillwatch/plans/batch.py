"""Gated batch run: stage, check, build the models, check everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators import alerts as al
from tillwatch.operators import quality, revenue, rules
from tillwatch.operators.staging import stg_transactions
from tillwatch.sources.tables import overwrite_table


class QualityError(RuntimeError):
    """A declared check found violations; ``violations`` lists (relation, rule, column, count)."""

    def __init__(self, violations: list[tuple]) -> None:
        self.violations = violations
        super().__init__("; ".join(f"{r}.{c} {rule}: {n}" for r, rule, c, n in violations))


def violated(violations: list[tuple]) -> None:
    if violations:
        raise QualityError(sorted(violations))


def gate(checks: DataFrame) -> None:
    # at most one row per declared check
    violated([tuple(r[c] for c in ("relation", "rule", "column", "violations"))
              for r in checks.filter(F.col("violations") > 0).collect()])


def _fraud_rate(mart: DataFrame) -> DataFrame:
    outside = quality.fraud_rate_outside(revenue.overall_fraud_rate(mart))
    return outside.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("mart_revenue_daily").alias("relation"), F.lit("fraud_rate_band").alias("rule"),
        F.lit("fraud_rate_pct").alias("column"), "violations")


def run_batch(spark: SparkSession, raw: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Build all models from the raw table and return them as stored tables.

    The staged relation stays a view.  A violation in it stops the run before any model is built; a
    violation in the raw table or a model is raised after all are built.  Each intermediate is written
    once and read back, so the marts do not repeat the scan of the raw table.  All checks of a relation
    are one scan of it, and those of the revenue mart are taken while it is written.
    """
    staged = stg_transactions(raw)
    view = f"{prefix}stg_transactions"
    staged.createOrReplaceTempView(view)
    gate(quality.profile(staged, "stg_transactions", {"negative_amount": F.col("amount") < 0}))

    def store(name: str, rows: DataFrame, partition_by: str | None = None) -> DataFrame:
        overwrite_table(rows, prefix + name, partition_by)
        return spark.table(prefix + name)

    merchant = store("int_merchant_revenue", revenue.int_merchant_revenue(staged), "tx_date")
    users = store("int_user_daily_summary", revenue.int_user_daily_summary(staged), "tx_date")
    checks = quality.Observed("mart_revenue_daily")
    mart = store("mart_revenue_daily", checks.on(revenue.mart_revenue_daily(merchant)), "date")
    report = store("mart_fraud_report", revenue.mart_fraud_report(users))

    later = quality.profile_all({"raw_transactions": raw, "mart_fraud_report": report}).unionByName(_fraud_rate(mart))
    failed = later.filter(F.col("violations") > 0).collect()
    violated(checks.violations() + [tuple(r) for r in failed])
    return {"stg_transactions": spark.table(view), "int_merchant_revenue": merchant,
            "int_user_daily_summary": users, "mart_revenue_daily": mart,
            "mart_fraud_report": report}


def run_scoring(spark: SparkSession, staged: DataFrame, prefix: str = "", **windows
                ) -> dict[str, DataFrame]:
    """Score once, store, and take alerts from the stored rows: one scored relation feeds them all.

    ``windows`` go to :func:`tillwatch.operators.rules.score_transactions`.
    """
    overwrite_table(rules.score_transactions(staged, **windows), f"{prefix}scored", "tx_date")
    scored = spark.table(f"{prefix}scored")
    overwrite_table(
        al.to_alerts(rules.flagged_transactions(scored), F.unix_date("tx_date")), f"{prefix}alerts"
    )
    return {"scored": scored, "alerts": spark.table(f"{prefix}alerts")}
