"""Incremental build: new transactions rewrite the dates they touch, and nothing else.

The raw table is partitioned by day.  A run stores what is new, notes the days it touches, rebuilds those
days of every daily model and overwrites just their partitions; the per-user report is made from the
stored daily rows of the users seen on those days.  The note is written before the new rows and cleared
after the last model, so a run that was stopped is completed by the next one, whatever that brings.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.timegrid import zoneless
from tillwatch.operators import ingest, quality, revenue
from tillwatch.operators.staging import stg_transactions
from tillwatch.plans.batch import gate, violated
from tillwatch.sources.tables import overwrite_table

MODELS = {"int_merchant_revenue": "tx_date", "int_user_daily_summary": "tx_date", "mart_revenue_daily": "date"}


def overwrite_dates(rows: DataFrame, table: str, by: str) -> None:
    """Replace the dates that ``rows`` have, leave the others as they are."""
    spark = rows.sparkSession
    # rows of a date meet, so that a date has few files; a large one is split
    rows = rows.hint("rebalance", by)
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(by).format("parquet").saveAsTable(table)
        return
    # a setting of the session: as an option, an insert into a table does not heed it
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        # the table's own order of columns has the partition last
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def days(names: list[date]) -> list:
    return [F.lit(d).cast("date") for d in names]


class IncrementalBuild:
    """The models of :func:`tillwatch.plans.batch.run_batch`, kept up to date; tables are named ``prefix`` + model."""

    def __init__(self, spark: SparkSession, prefix: str = "") -> None:
        self.spark, self.prefix = spark, prefix
        self.raw, self.pending = f"{prefix}raw_transactions", f"{prefix}pending_dates"

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)

    def _pending(self) -> list[date]:
        if not self.spark.catalog.tableExists(self.pending):
            return []
        # a row per day that is touched
        return sorted(r[0] for r in self.spark.table(self.pending).distinct().collect())

    def _note(self, dates: list[date]) -> None:
        overwrite_table(self.spark.createDataFrame([(d,) for d in dates], "tx_date date").coalesce(1), self.pending)

    def raw_slice(self, dates: list[date]) -> DataFrame:
        """The raw rows of some days: only their partitions are read."""
        return self.spark.table(self.raw).filter(F.col("tx_date").isin(*days(dates))).drop("tx_date")

    def store(self, incoming: DataFrame) -> list[date]:
        """Append the transactions that are not stored yet; the days to be rebuilt, those left over included.

        Copies are compared over all days, by the key column alone.
        """
        new = incoming
        if self.spark.catalog.tableExists(self.raw):
            new = ingest.insert_if_absent(incoming, self.spark.table(self.raw))
        else:
            new = ingest.first_per_key(incoming)
        new = new.drop("arrival").withColumn("tx_date", F.to_date(zoneless(new, "tx_at"))).persist()
        try:
            # calendar days, however many rows
            touched = {r[0] for r in new.select("tx_date").distinct().collect() if r[0] is not None}
            dates = sorted(touched | set(self._pending()))
            self._note(dates)
            new.hint("rebalance", "tx_date").write.mode("append").partitionBy("tx_date").format("parquet").saveAsTable(self.raw)
        finally:
            new.unpersist()
        return dates

    def build(self, dates: list[date]) -> None:
        """Rebuild those days.  A violation in their staged rows stops before any model is written."""
        if not dates:
            return
        staged = stg_transactions(self.raw_slice(dates))
        gate(quality.profile(staged, "stg_transactions", {"negative_amount": F.col("amount") < 0}))
        overwrite_dates(revenue.int_merchant_revenue(staged), f"{self.prefix}int_merchant_revenue", "tx_date")
        overwrite_dates(revenue.int_user_daily_summary(staged), f"{self.prefix}int_user_daily_summary", "tx_date")
        merchant = self._table("int_merchant_revenue").filter(F.col("tx_date").isin(*days(dates)))
        checks = quality.Observed("mart_revenue_daily")
        overwrite_dates(checks.on(revenue.mart_revenue_daily(merchant)), f"{self.prefix}mart_revenue_daily", "date")
        self._report(dates)
        violated(checks.violations())
        gate(quality.profile(self._table("mart_fraud_report"), "mart_fraud_report"))
        self._note([])

    def _report(self, dates: list[date]) -> None:
        """The report with the touched users made anew, from daily rows only."""
        daily = self._table("int_user_daily_summary")
        if not self.spark.catalog.tableExists(f"{self.prefix}mart_fraud_report"):
            overwrite_table(revenue.mart_fraud_report(daily), f"{self.prefix}mart_fraud_report")
            return
        touched = daily.filter(F.col("tx_date").isin(*days(dates))).select("user_id").distinct()
        same = daily["user_id"].eqNullSafe(touched["user_id"])
        anew = revenue.mart_fraud_report(daily.join(touched, same, "left_semi"))
        report = self._table("mart_fraud_report")
        kept = report.join(touched, report["user_id"].eqNullSafe(touched["user_id"]), "left_anti")
        # the table cannot be read and overwritten at once
        overwrite_table(kept.unionByName(anew), f"{self.prefix}mart_fraud_report_next")
        overwrite_table(self._table("mart_fraud_report_next"), f"{self.prefix}mart_fraud_report")
        self.spark.sql(f"drop table `{self.prefix}mart_fraud_report_next`")

    def run(self, incoming: DataFrame) -> list[date]:
        dates = self.store(incoming)
        self.build(dates)
        return dates
