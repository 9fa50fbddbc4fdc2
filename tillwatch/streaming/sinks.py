"""foreachBatch sinks.  Outputs are batch tables keyed by run and batch id: a retried batch replaces what
it wrote, and a new checkpoint, whose batch ids start again, adds to what is there."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.exact import count_where
from tillwatch.functions.timegrid import as_utc
from tillwatch.operators import alerts as al
from tillwatch.operators import ingest
from tillwatch.schemas import ALERTS, BREAKER_LOG, RAW_TRANSACTIONS, ROLLUP
from tillwatch.sources.batches import FAN, BatchTable, covers
from tillwatch.sources.key_index import KeyIndex
from tillwatch.sources.messages import positioned, split_dead_letters

Publish = Callable[[DataFrame, int], None]

# Fixed value: time between micro-batches.
TRIGGER = "5 seconds"
STORED = RAW_TRANSACTIONS + ", batch_id bigint"
DEAD_LETTERS = "value string, reject_reason string, batch_id bigint"


def run_of(spark: SparkSession) -> str:
    """The running streaming query's id, which lives in its checkpoint; batch ids count from 0 in each."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def publish_to_kafka(servers: str, topic: str) -> Publish:
    """Publish (key, value) rows with Spark's Kafka writer (needs its package)."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())

    return publish


def publish_to_files(path: str) -> Publish:
    def publish(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")

    return publish


class RollupTable(BatchTable):
    """Roll-ups of micro-batches; merged ones are summed, so they grow with hours and users, not with alerts."""

    def _write_merged(self, rows: DataFrame, path: str, files: int) -> dict:
        merged = al.merge_rollups(rows).withColumns({"run": F.lit(None).cast("string"), "batch_id": F.lit(None).cast("bigint")})
        return super()._write_merged(merged.select(*self.stored.names), path, files)


class AlertSink:
    """Score sink: store alerts, log the flagged share, publish unless the breaker holds.

    Takes *all* scored rows, so that the flagged share is of all transactions.  Alerts, decision and
    publishing belong to one batch function; two queries would race for the breaker.
    Each log row carries the latest hold forward, so a batch reads only its predecessor's row.
    """

    def __init__(self, root: str, publish: Publish,
                 now: Callable[[], Column] = lambda: as_utc(F.current_timestamp()),
                 threshold: float = al.BREAKER_RATE, hold_seconds: int = al.BREAKER_SECONDS,
                 fan: int = FAN) -> None:
        self._alerts = BatchTable(f"{root}/alerts", ALERTS, fan)
        self._rollup = RollupTable(f"{root}/alert_rollup", ROLLUP, fan)
        self._log = BatchTable(f"{root}/breaker_log", BREAKER_LOG, fan)
        self.publish, self.now = publish, now
        self.threshold, self.hold_seconds = threshold, hold_seconds

    def __call__(self, scored: DataFrame, batch_id: int) -> None:
        spark = scored.sparkSession
        run = run_of(spark)
        scored = scored.persist()
        try:
            now = spark.range(1).select(self.now().alias("now")).first()["now"]
            held = self._hold_before(spark, run, batch_id)
            total, flagged = scored.agg(
                F.count(F.lit(1)), count_where(F.col("is_flagged"))
            ).first()
            rate = flagged / total if total else 0.0
            tripped = rate > self.threshold
            if tripped:
                held = now + timedelta(seconds=self.hold_seconds)
            log = spark.createDataFrame(
                [(batch_id, total, flagged, rate, tripped, held)], BREAKER_LOG
            )
            self._log.write(log.coalesce(1), run, batch_id)
            alerts = al.to_alerts(scored.filter("is_flagged"), F.lit(batch_id))
            self._alerts.write(alerts, run, batch_id)
            self._rollup.write(al.alert_rollup(alerts), run, batch_id)
            if flagged and (held is None or held <= now):
                self.publish(al.alert_payload(alerts), batch_id)
        finally:
            scored.unpersist()

    def _hold_before(self, spark: SparkSession, run: str, batch_id: int):
        """The hold in force: from the row of the batch before, or at a run's start the latest of all."""
        before = self._log.read_batch(spark, run, batch_id - 1)
        if before is not None:
            return before.select("flag_until").first()["flag_until"]
        log = self._log.read(spark, run=True)
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        return log.filter(~own).agg(F.max("flag_until").alias("held")).first()["held"]

    def alerts(self, spark: SparkSession) -> DataFrame:
        return self._alerts.read(spark)

    def rollup(self, spark: SparkSession) -> DataFrame:
        """What the feeds read instead of the alerts (``alerts.rollup_*``)."""
        return self._rollup.read(spark)

    def breaker_log(self, spark: SparkSession) -> DataFrame:
        return self._log.read(spark)


class IngestSink:
    """Message sink: new transactions to one table, dead letters to another.

    Of copies the first to arrive is kept.  Which keys are stored an index tells, which opens only the
    files that may hold a batch's keys; a batch is compared with all but itself, so replaying a batch, a
    file or, under a new checkpoint, the whole input changes nothing.  The high-water mark is in the
    table's manifest.
    """

    def __init__(self, root: str, use_mark: bool = False, fan: int = FAN) -> None:
        self._table = BatchTable(f"{root}/raw_transactions", STORED, fan, self._latest)
        self._dead = BatchTable(f"{root}/dead_letters", DEAD_LETTERS, fan)
        self.index = KeyIndex(f"{root}/raw_keys", "tx_id", fan)
        self.use_mark = use_mark

    @staticmethod
    def _latest(stats: list[dict]) -> dict:
        return {"mark": max((s["mark"] for s in stats if s["mark"]), default=None)}

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        run = run_of(spark)
        good, dead = split_dead_letters(positioned(messages))
        incoming = ingest.with_defaults(good)
        self._index_all(spark, run, batch_id)
        if self.use_mark:
            mark = self._latest([e["stats"] for e in self._table.entries(spark)
                                 if e["tier"] or not covers(e, run, batch_id)])["mark"]
            if mark is not None:
                incoming = incoming.filter(F.col("tx_at") > F.lit(mark).cast("timestamp_ntz"))
        first = ingest.first_per_key(incoming).drop("arrival").persist()
        try:
            new = self.index.absent(first, run, batch_id)
            self._table.write(new, run, batch_id, lambda rows: rows.agg(
                F.max("tx_at").cast("string").alias("mark")).first().asDict())
        finally:
            first.unpersist()
        self._index(spark, run, batch_id)
        self._dead.write(dead, run, batch_id)

    def _index(self, spark: SparkSession, run: str, batch_id: int) -> None:
        keys = self._table.read_batch(spark, run, batch_id).select("tx_id")
        self.index.write(keys, run, batch_id, lambda rows: {"keys": rows.count()})

    def _index_all(self, spark: SparkSession, run: str, batch_id: int) -> None:
        """Index what a run stored just before it was stopped; its batch is still the run's newest."""
        for entry in self._table.entries(spark):
            (r, _, last), *_ = entry["spans"]
            if not entry["tier"] and (r, last) != (run, batch_id) and not self.index.has(spark, r, last):
                self._index(spark, r, last)

    def table(self, spark: SparkSession) -> DataFrame:
        return self._table.read(spark)

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        return self._dead.read(spark)


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: str | None = TRIGGER) -> StreamingQuery:
    """Run ``sink`` per micro-batch; ``trigger=None`` works off what is there and stops."""
    writer = (
        stream.writeStream.foreachBatch(sink).outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()
