"""Daily summaries, marts and the revenue reads on top of them.

Amounts and rates stay exact decimals inside; :func:`doubles` is for the outer edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillwatch.functions.exact import (
    count_where, hundredths, mean, percent, quotient, sum_where,
)
from tillwatch.functions.fixed import (
    COUNTRY_ALPHA3, COUNTRY_CENTROID, MERCHANT_CATEGORY, OTHER_CATEGORY, lookup,
)


def doubles(df: DataFrame) -> DataFrame:
    """Every decimal column as double."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name)
        for f in df.schema
    ])


def int_merchant_revenue(staged: DataFrame) -> DataFrame:
    """One row per (day, merchant, country).

    The distinct user count makes Spark aggregate by (day, merchant, country, user) first, so a
    merchant that holds most rows is already reduced, and spread over users, before the last step.
    """
    n, fraud = F.count(F.lit(1)), count_where(F.col("is_fraud"))
    return staged.groupBy("tx_date", "merchant", "country_code").agg(
        n.alias("tx_count"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("amount").alias("total_revenue_vnd"),
        mean(F.sum("amount"), n).alias("avg_tx_value_vnd"),
        fraud.alias("fraud_tx_count"),
        sum_where(F.col("amount"), F.col("is_fraud")).alias("fraud_amount_vnd"),
        percent(fraud, n, 4).alias("fraud_rate_pct"),
    )


def int_user_daily_summary(staged: DataFrame) -> DataFrame:
    """One row per (day, user)."""
    n, fraud = F.count(F.lit(1)), count_where(F.col("is_fraud"))
    return staged.groupBy("tx_date", "user_id").agg(
        n.alias("total_tx"),
        fraud.alias("fraud_tx"),
        F.sum("amount").alias("total_amount"),
        sum_where(F.col("amount"), F.col("is_fraud")).alias("fraud_amount"),
        mean(F.sum("amount"), n).alias("avg_amount"),
        F.max("tx_at").alias("last_tx_at"),
        percent(fraud, n, 2).alias("daily_fraud_rate_pct"),
    )


def category_of(merchant: Column) -> Column:
    return lookup(merchant, MERCHANT_CATEGORY, OTHER_CATEGORY)


def merchant_category(staged: DataFrame) -> DataFrame:
    """Distinct (day, merchant) with the merchant's category; a null merchant is 'other'."""
    return staged.select("tx_date", "merchant").distinct().withColumn(
        "category", category_of(F.col("merchant"))
    )


def mart_revenue_daily(merchant_revenue: DataFrame) -> DataFrame:
    """Revenue mart, one row per (date, merchant, country).

    The category belongs to the merchant alone, so joining the (day, merchant) category relation
    on its key always finds that one category and is written as a projection: no second scan, no
    shuffle.  A null merchant would find no partner in the join and so keeps a null category.
    """
    return merchant_revenue.select(
        F.col("tx_date").alias("date"),
        "merchant",
        F.when(F.col("merchant").isNotNull(), category_of(F.col("merchant"))).alias("category"),
        "country_code",
        "tx_count",
        "unique_users",
        "total_revenue_vnd",
        quotient(hundredths(F.col("total_revenue_vnd")), F.col("tx_count") * 100, 2)
        .alias("avg_tx_value_vnd"),
        "fraud_tx_count",
        "fraud_rate_pct",
        F.coalesce("fraud_amount_vnd", F.lit(0).cast("decimal(25,2)")).alias("fraud_amount_vnd"),
    )


def mart_fraud_report(user_daily: DataFrame) -> DataFrame:
    """Per user, over the user's days that saw fraud.

    Rate and last_fraud_at therefore cover every transaction of those days, not of all days.
    Order by ``total_fraud_tx`` when reading; a stored table keeps no order.
    """
    fraud, total = F.sum("fraud_tx"), F.sum("total_tx")
    return user_daily.filter(F.col("fraud_tx") > 0).groupBy("user_id").agg(
        fraud.alias("total_fraud_tx"),
        F.sum("fraud_amount").cast("decimal(38,2)").alias("total_fraud_amount"),
        F.max("last_tx_at").alias("last_fraud_at"),
        percent(fraud, total, 2).alias("user_fraud_rate_pct"),
    )


def fraud_report_ranked(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("total_fraud_tx"), "user_id")


def _totals(mart: DataFrame, key: str) -> DataFrame:
    """Totals per ``key``; the rate is the plain, unweighted mean of the daily percentages."""
    rate = F.col("fraud_rate_pct")
    return mart.groupBy(key).agg(
        F.sum("tx_count").alias("total_tx"),
        F.sum("total_revenue_vnd").alias("total_revenue_vnd"),
        mean(F.sum(rate), F.count(rate)).alias("avg_fraud_rate_pct"),
        quotient((F.sum(rate) * 10_000).cast("decimal(34,0)"), F.count(rate) * 10_000, 2)
        .alias("_rate_2dp"),
    )


def revenue_by_merchant(mart: DataFrame) -> DataFrame:
    return _totals(mart, "merchant").drop("_rate_2dp").orderBy(
        F.desc("total_revenue_vnd"), "merchant"
    )


def revenue_by_country(mart: DataFrame) -> DataFrame:
    """Totals per non-null country with its map position."""
    code = F.col("country_code")
    return (
        _totals(mart.filter(code.isNotNull()), "country_code")
        .drop("_rate_2dp")
        .withColumn("lat", lookup(code, {c: p[0] for c, p in COUNTRY_CENTROID.items()}, 0.0))
        .withColumn("lon", lookup(code, {c: p[1] for c, p in COUNTRY_CENTROID.items()}, 0.0))
        .orderBy(F.desc("total_tx"), "country_code")
    )


def country_distribution(mart: DataFrame) -> DataFrame:
    """Feed of the country map: numbers as doubles, rate to two places, three-letter code."""
    code = F.col("country_code")
    return (
        _totals(mart.filter(code.isNotNull()), "country_code")
        .select(
            code,
            lookup(code, COUNTRY_ALPHA3).alias("iso_alpha3"),
            F.col("total_tx").cast("double").alias("total_tx"),
            F.col("total_revenue_vnd").cast("double").alias("total_revenue_vnd"),
            F.col("_rate_2dp").cast("double").alias("avg_fraud_rate_pct"),
        )
        .orderBy(F.desc("total_tx"), "country_code")
    )


def revenue_daily(mart: DataFrame, limit: int = 30, merchant: str | None = None) -> DataFrame:
    """The newest ``limit`` (1..365) mart rows, optionally of one merchant."""
    if not 1 <= limit <= 365:
        raise ValueError("limit has to be within 1..365")
    if merchant is not None:
        mart = mart.filter(F.col("merchant") == F.lit(merchant))
    return mart.orderBy(F.desc("date"), "merchant", "country_code").limit(limit)


def fraud_rate_trend(mart: DataFrame) -> DataFrame:
    """Chart feed: fraud share per day in percent, over all days."""
    total, fraud = F.sum("tx_count"), F.sum("fraud_tx_count")
    return mart.groupBy("date").agg(
        total.alias("total_tx"), fraud.alias("total_fraud_tx"),
        percent(fraud, total, 4).alias("fraud_rate_pct"),
    ).orderBy("date")


def overall_fraud_rate(mart: DataFrame) -> DataFrame:
    """Fraud share over the whole mart in percent; null on an empty mart."""
    total, fraud = F.sum("tx_count"), F.sum("fraud_tx_count")
    return mart.agg(
        total.alias("total_tx"),
        fraud.alias("total_fraud_tx"),
        percent(fraud, total, 4).alias("overall_fraud_rate_pct"),
    )
