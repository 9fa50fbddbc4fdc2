"""Sinks over more than one checkpoint, and reads before the first write."""

from pyspark.sql import functions as F

from tillwatch.operators import ingest, observe
from tillwatch.streaming import sinks

ROWS = {c: '{"tx_id": "%s", "user_id": "u", "amount": 5, "merchant": "Tiki", "country": "VN", ' % c
        + '"tx_at": "2024-05-01T12:00:00+00:00"}' for c in "abcd"}


def messages(spark, ids):
    return spark.createDataFrame([("u", ROWS[i]) for i in ids], "key string, value string")


def test_a_new_run_keeps_what_is_stored(spark, tmp_path, monkeypatch):
    sink = sinks.IngestSink(str(tmp_path))
    for batch, ids in enumerate(["a", "b", "c"]):
        sink(messages(spark, ids), batch)
    monkeypatch.setattr(sinks, "run_of", lambda _: "second")
    for _ in range(2):
        sink(messages(spark, "bd"), 0)
    assert sorted(r["tx_id"] for r in sink.table(spark).collect()) == ["a", "b", "c", "d"]


def test_reads_before_the_first_batch_are_empty(spark, tmp_path):
    sink = sinks.AlertSink(str(tmp_path / "none"), lambda *_: None)
    assert sink.alerts(spark).count() == sink.breaker_log(spark).count() == 0


def test_a_copy_without_a_time_comes_last(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", "2024-05-01 00:00:00", 2), ("b", None, 3)],
                                 "tx_id string, tx_at string, n int")
    rows = rows.withColumn("tx_at", F.col("tx_at").cast("timestamp_ntz"))
    got = {r["tx_id"]: r["n"] for r in ingest.first_per_key(rows).collect()}
    assert got == {"a": 2, "b": 3}


def test_freshness_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    table = spark.sql("select timestamp'2024-05-01 11:00:00Z' as tx_at")
    now = F.expr("timestamp_ntz'2024-05-01 12:00:00'")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = observe.check_freshness({"t": table}, now, {"t": 2.0}, {"t": "tx_at"}).first()
            assert row["hours_since_update"] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
