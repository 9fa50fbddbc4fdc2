"""Window-exact rules on a stream (append mode).

Spark emits a window once the watermark has passed its end, so a transaction gets one row per window
that holds it; :func:`per_transaction` takes the most suspicious of them when the output is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.timegrid import micros

# Fixed value: how late a transaction may be.
WATERMARK = "10 seconds"


def watermarked(parsed: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return parsed.withWatermark("tx_at", delay)


def deduplicated(stream: DataFrame) -> DataFrame:
    """One row per tx_id among those within the watermark of each other."""
    return stream.dropDuplicatesWithinWatermark(["tx_id"])


def _with_window_value(stream: DataFrame, window: str, slide: str, value: Column, name: str,
                       alone: Column) -> DataFrame:
    """Each transaction once per window that holds it, with the window's aggregate, or ``alone`` if it
    has no user: such a row belongs to no group and comes out unmatched.

    The join is on (user, window) equality: a range condition on window bounds is not supported on
    streams, and it would compare every window of a user with every transaction.
    """
    spans = F.window("tx_at", window, slide)
    values = (
        stream.groupBy("user_id", spans.alias("w")).agg(value.alias(name))
        .withColumnRenamed("user_id", "_user")
    )
    # the window is the row's event time from here on; tx_at stays as plain data
    rows = stream.withColumn("rw", spans).withColumn("tx_at", F.col("tx_at").alias("tx_at", metadata={}))
    same = (rows["user_id"] == values["_user"]) & (rows["rw"] == values["w"])
    found = F.when(F.col("user_id").isNull(), alone).otherwise(F.col(name))
    return rows.join(values, same, "left_outer") \
        .withColumns({"window_start": F.col("rw.start"), "window_end": F.col("rw.end"), name: found}) \
        .drop("_user", "rw", "w")


def velocity_per_window(stream: DataFrame, window: str = "60 seconds", slide: str = "10 seconds"
                        ) -> DataFrame:
    return _with_window_value(stream, window, slide, F.count(F.lit(1)), "tx_count_60s", F.lit(1).cast("bigint"))


def amount_per_window(stream: DataFrame, window: str = "24 hours", slide: str = "1 hour"
                      ) -> DataFrame:
    # exact at any size: equal amounts are one entry with a count, as in the batch rules
    median = F.expr("percentile_disc(0.5) within group (order by cast(amount as double))")
    return _with_window_value(stream, window, slide, median, "user_median_amount", F.col("amount").cast("double"))


def per_transaction(emitted: DataFrame) -> DataFrame:
    """Collapse the stored per-window rows to one per tx_id (batch): highest count, lowest positive
    median, 0 if there is none."""
    median = F.col("user_median_amount")
    lowest = F.coalesce(F.min(F.when(median > 0, median)), F.when(F.count(median) > 0, F.lit(0.0)))
    found = [
        F.max("tx_count_60s").alias("tx_count_60s") if c == "tx_count_60s"
        else lowest.alias("user_median_amount")
        for c in emitted.columns if c in ("tx_count_60s", "user_median_amount")
    ]
    return emitted.groupBy("tx_id").agg(*found)


def geo_hits(stream: DataFrame, within: str = "30 minutes", country: str = "country") -> DataFrame:
    """Transactions followed, within ``within``, by one of the same user in another country.

    A semi join: a transaction comes out once, on its first match, not once per partner.  The time
    bucket in the key spreads a busy user over tasks; later transactions are also offered to the
    bucket before theirs.
    """
    width = f"{micros(within)} microseconds"
    earlier = stream.withColumn("_bucket", F.window("tx_at", width)["start"])
    later = stream.select(
        F.col("user_id").alias("_user"),
        F.col("tx_id").alias("_tx"),
        F.col(country).alias("_country"),
        F.col("tx_at").alias("_at"),
        F.explode(F.array(
            F.window("tx_at", width)["start"],
            F.window("tx_at", width)["start"] - F.expr(f"interval {micros(within)} microseconds"),
        )).alias("_near"),
    )
    span = F.expr(f"interval {micros(within)} microseconds")
    return earlier.join(
        later,
        (F.col("user_id") == F.col("_user")) & (F.col("_bucket") == F.col("_near"))
        & (F.col("tx_id") != F.col("_tx")) & (F.col(country) != F.col("_country"))
        & (F.col("_at") >= F.col("tx_at")) & (F.col("_at") <= F.col("tx_at") + span),
        "left_semi",
    ).drop("_bucket")
