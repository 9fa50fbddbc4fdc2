"""The driver's ``events`` table seen as raw payment transactions.

Deliberately untidy: nulls, negative amounts, padding, wrong case, an unlisted merchant and an
unlisted device, so that staging and the quality checks have something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture: merchant by event_id modulo 11.
_MERCHANTS = [
    "Grab", " Shopee", "VinMart", "MoMo ", "Tiki", "Highlands", "Circle K", "ZaloPay", "VNPay",
    "Lazada", "Corner Shop",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``events`` with the columns and types of the raw transaction table, ``keep`` columns first."""
    n = F.col("event_id")
    place = F.pmod(n * 37, F.lit(100))
    confirmed_fraud = (F.col("event_type") == "error") & (n % 4 == 0)
    return events.select(
        *(keep or []),
        F.when(n % 499 != 7, F.concat(F.lit("tx-"), n.cast("string"))).alias("tx_id"),
        F.concat(F.lit(" user_"), F.lpad(F.col("user_id").cast("string"), 4, "0"), F.lit(" "))
        .alias("user_id"),
        F.element_at(F.array(*map(F.lit, _MERCHANTS)), (n % 11 + 1).cast("int"))
        .alias("merchant"),
        F.when(n % 97 == 5, -F.col("value")).when(n % 103 != 9, F.col("value"))
        .cast("decimal(15,2)").alias("amount"),
        F.lit(" vnd").alias("currency"),
        F.when(place < 85, "vn").when(place < 90, "US").when(place < 94, "SG ")
        .when(place < 97, "JP").when(place < 99, "KR").otherwise("GB").alias("country"),
        F.when(n % 503 != 11, F.col("ts")).alias("tx_at"),
        F.when(F.col("event_type") == "click", "Mobile").when(F.col("event_type") == "view", " web")
        .when(F.col("event_type") == "purchase", "kiosk").otherwise("pos").alias("device"),
        F.when(confirmed_fraud, True).when(F.col("event_type") != "signup", False)
        .alias("is_fraud"),
        F.when(confirmed_fraud, "amount_spike").alias("fraud_reason"),
        (F.col("ts") + F.expr("interval 7 minutes")).alias("ingested_at"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """``events`` as a topic would carry them: ``key`` and ``value`` (JSON text).

    Some messages are cut short (not JSON) and some carry an unreadable time.
    """
    rows = raw_transactions(events.withColumn("_n", F.col("event_id")), keep=["_n"])
    iso = F.date_format("tx_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [c for c in rows.columns if c not in ("_n", "ingested_at")]
    body = F.to_json(F.struct(*[
        F.when(F.col("_n") % 223 == 4, "soon").otherwise(F.concat(iso, F.lit("+00:00")))
        .alias("tx_at") if c == "tx_at"
        else F.col(c).cast("double").alias(c) if c == "amount"
        else F.col(c)
        for c in fields
    ]))
    cut = F.when(F.col("_n") % 211 == 3, F.lit('{"tx_id": "tx-')).otherwise(body)
    return rows.select(F.trim("user_id").alias("key"), cut.alias("value"))
