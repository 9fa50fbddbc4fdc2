"""The live pipelines, source to sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillwatch.session import checkpoint_root
from tillwatch.sources.messages import parse_transactions
from tillwatch.streaming.exact import exact_scores
from tillwatch.streaming.sinks import TRIGGER, AlertSink, IngestSink, start
from tillwatch.streaming.trailing import trailing_score
from tillwatch.streaming.windows import WATERMARK, deduplicated, watermarked


def live_scores(messages: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Messages -> one scored row per transaction.  Needs the RocksDB state store
    (:data:`STATE_SETTINGS`)."""
    return trailing_score(deduplicated(watermarked(parse_transactions(messages), delay)))


def settled_scores(messages: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """As :func:`live_scores`, but what the batch rules find: a row comes out when its last window has closed."""
    return exact_scores(deduplicated(watermarked(parse_transactions(messages), delay)))


STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_alerts(messages: DataFrame, sink: AlertSink, checkpoint: str | None = None,
               trigger: str | None = TRIGGER,
               scores: Callable[[DataFrame], DataFrame] = live_scores) -> StreamingQuery:
    """Score the stream into ``sink``, at once or (``settled_scores``) a day later and exactly; the
    checkpoint defaults to the cluster's shared folder."""
    checkpoint = checkpoint or f"{checkpoint_root(messages.sparkSession)}/alerts"
    for key, value in STATE_SETTINGS.items():
        messages.sparkSession.conf.set(key, value)
    return start(scores(messages), sink, checkpoint, trigger)


def run_ingest(messages: DataFrame, sink: IngestSink, checkpoint: str | None = None,
               trigger: str | None = TRIGGER) -> StreamingQuery:
    """Store the stream's transactions and dead letters; offsets live in the checkpoint."""
    checkpoint = checkpoint or f"{checkpoint_root(messages.sparkSession)}/ingest"
    return start(messages, sink, checkpoint, trigger)
