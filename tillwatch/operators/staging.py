"""Raw transactions -> staged transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.timegrid import floor_millis, zoneless


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Clean, cast and rename; drop rows without tx_id or tx_at and rows whose amount is not > 0.

    ``tx_at`` is cut to milliseconds; ``tx_date`` is the day of the uncut time.
    """
    return raw.filter(
        F.col("tx_id").isNotNull() & F.col("tx_at").isNotNull() & (F.col("amount") > 0)
    ).select(
        "tx_id",
        F.trim("user_id").alias("user_id"),
        F.trim("merchant").alias("merchant"),
        F.col("amount").cast("decimal(15,2)").alias("amount"),
        F.upper(F.trim("currency")).alias("currency"),
        F.upper(F.trim("country")).alias("country_code"),
        floor_millis(zoneless(raw, "tx_at")).alias("tx_at"),
        F.lower(F.trim("device")).alias("device"),
        F.coalesce("is_fraud", F.lit(False)).alias("is_fraud"),
        "fraud_reason",
        "ingested_at",
        F.to_date(zoneless(raw, "tx_at")).alias("tx_date"),
    )
