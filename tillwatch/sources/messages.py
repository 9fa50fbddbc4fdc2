"""Transaction messages: readers, decoding, the dead-letter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.schemas import TX_PAYLOAD

BAD_JSON = "bad_json"
MISSING_KEY = "missing_key"
BAD_TIME = "bad_time"

FILE_PLACE = ["file_modification_time", "file_path", "file_block_start"]
ARRIVAL = "struct<written: timestamp, source: string, place: bigint, line: bigint>"


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_per_trigger: int = 1000) -> DataFrame:
    """Subscribe to a topic; needs Spark's own Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
    )


def kafka_replay(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The whole topic as a batch, from the earliest offset."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def _lines(text: DataFrame) -> DataFrame:
    """``value`` and where the line stands, for :func:`positioned`."""
    return text.select("value", *[F.col(f"_metadata.{c}").alias(c) for c in FILE_PLACE])


def file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Text files, one JSON message per line, as a stream with a ``value`` column."""
    return _lines(
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )


def file_replay(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark.read.text(path))


def positioned(messages: DataFrame) -> DataFrame:
    """``value`` and ``arrival``, the message's place in its source, where the source has one.

    A topic's order is (topic and partition, offset); files are taken in the order they were written,
    their lines in order (lines of one block are one task's, in order, so a running number tells them
    apart).  A batch only: in a stream, apply it to the micro-batch.  A message of neither has no arrival.
    """
    have = set(messages.columns)
    none = F.lit(None)
    if {"topic", "partition", "offset"} <= have:
        place = (none, F.concat_ws("/", "topic", F.col("partition").cast("string")), F.col("offset"), F.lit(0))
    elif set(FILE_PLACE) <= have:
        place = (F.col("file_modification_time"), F.col("file_path"), F.col("file_block_start"), F.monotonically_increasing_id())
    else:
        return messages.select("value", none.cast(ARRIVAL).alias("arrival"))
    return messages.select("value", F.struct(*place).cast(ARRIVAL).alias("arrival"))


def json_columns(messages: DataFrame, schema: str, options: dict | None = None, *keep: Column
                 ) -> DataFrame:
    """``value`` decoded into the columns of ``schema`` (nulls where it is not such JSON).

    Unpacked by a generator, below which no filter is moved: each message is parsed once, whatever
    is later asked of its fields.
    """
    record = F.from_json(F.col("value").cast("string"), schema, options or {})
    return messages.select(*keep, F.inline(F.array(record)))


def _iso_time(text: Column) -> Column:
    """ISO-8601 with or without a zone; a zone-less time is UTC; anything else is null."""
    return F.try_to_timestamp(text)


def decode(messages: DataFrame) -> DataFrame:
    """``value`` -> payload columns plus ``tx_time`` (parsed tx_at) and ``reject_reason``.

    ``reject_reason`` is null for a usable message.  A field of the wrong type only nulls that
    field; a value that is not a JSON object is ``bad_json``.  ``arrival`` is carried along.
    """
    arrival = [F.col("arrival")] if "arrival" in messages.columns else []
    decoded = json_columns(
        messages, TX_PAYLOAD + ", _corrupt string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
        F.col("value").cast("string").alias("value"), *arrival,
    ).withColumn("tx_time", _iso_time(F.col("tx_at")))
    no_key = [F.col(c).isNull() for c in ("tx_id", "user_id", "tx_at")]
    reason = (
        F.when(F.col("value").isNull()
               | (F.col("_corrupt").isNotNull() & no_key[0] & no_key[1] & no_key[2]), BAD_JSON)
        .when(no_key[0] | no_key[1] | no_key[2], MISSING_KEY)
        .when(F.col("tx_time").isNull(), BAD_TIME)
    )
    return decoded.withColumn("reject_reason", reason).drop("_corrupt")


def parse_transactions(messages: DataFrame) -> DataFrame:
    """Payload columns of every message that has a tx_id and a readable tx_at.

    Batch or stream; ``tx_at`` becomes a timestamp.  Streams add their watermark on top
    (:func:`tillwatch.streaming.live.watermarked`).
    """
    return (
        json_columns(messages, TX_PAYLOAD)
        .withColumn("tx_at", _iso_time(F.col("tx_at")))
        .filter(F.col("tx_id").isNotNull() & F.col("tx_at").isNotNull())
    )


def split_dead_letters(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable transactions, dead letters).  Dead letters keep the message text and the reason."""
    decoded = decode(messages)
    good = (
        decoded.filter(F.col("reject_reason").isNull())
        .drop("value", "reject_reason", "tx_at")
        .withColumnRenamed("tx_time", "tx_at")
    )
    dead = decoded.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")
    return good, dead


def dead_letter_counts(messages: DataFrame) -> DataFrame:
    return (
        decode(messages)
        .groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )
