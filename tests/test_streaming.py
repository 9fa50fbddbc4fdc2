import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import alerts as al
from tillwatch.operators import rules
from tillwatch.sources.messages import file_replay, file_stream, parse_transactions
from tillwatch.streaming import sinks, windows
from tillwatch.streaming.live import STATE_SETTINGS, run_alerts, run_ingest
from tillwatch.streaming.trailing import RunningMedian

T0 = datetime(2024, 5, 1, 12, 0, 0)


def message(tx, user, seconds, amount=10.0, country="VN", **more):
    at = (T0 + timedelta(seconds=seconds)).isoformat() + "+00:00"
    return json.dumps({"tx_id": tx, "user_id": user, "merchant": "Grab", "amount": amount,
                       "currency": "VND", "country": country, "tx_at": at, "device": "pos",
                       "is_fraud": False, "fraud_reason": None, **more})


def write_file(folder, n, lines):
    """Files are consumed in modification-time order."""
    path = os.path.join(folder, f"f{n:03d}.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return str(path)


def drain(stream, out, checkpoint):
    query = (stream.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination(300)
    assert query.exception() is None


def sample(folder):
    """Two users over several files, then a far later row that closes every window."""
    lines = []
    for i in range(60):
        lines.append(message(f"a{i}", "a", i * 90, 10 + i % 7, "US" if i % 9 == 4 else "VN"))
        lines.append(message(f"b{i}", "b", i * 90 + 10, 5 + i % 11, "VN"))
    for n in range(4):
        write_file(folder, n, lines[n * 30:(n + 1) * 30])
    write_file(folder, 4, [message("z0", "z", 90 * 3600)])
    write_file(folder, 5, [message("z1", "z", 91 * 3600)])


def stream_of(spark, folder, delay="10 seconds"):
    return windows.watermarked(parse_transactions(file_stream(spark, folder)), delay)


def batch_of(spark, folder):
    parsed = parse_transactions(file_replay(spark, folder)).filter(~F.col("tx_id").startswith("z"))
    return parsed.withColumn("country_code", F.col("country")).withColumn(
        "tx_at", F.col("tx_at").cast("timestamp_ntz"))


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_window_rules_equal_batch(spark, folder, tmp_path):
    sample(folder)
    for name, made, batch, column in [
        ("vel", windows.velocity_per_window(stream_of(spark, folder), "10 minutes", "5 minutes"),
         rules.velocity_score(batch_of(spark, folder), "10 minutes", "5 minutes"), "tx_count_60s"),
        ("amt", windows.amount_per_window(stream_of(spark, folder), "2 hours", "1 hour"),
         rules.amount_spike(batch_of(spark, folder), "2 hours", "1 hour"), "user_median_amount"),
    ]:
        out = str(tmp_path / name)
        drain(made, out, str(tmp_path / f"{name}_cp"))
        emitted = spark.read.parquet(out).filter(~F.col("tx_id").startswith("z"))
        assert emitted.count() == 120 * 2  # two windows hold each row
        assert pairs(windows.per_transaction(emitted), "tx_id", column) == pairs(
            batch, "tx_id", column)


def test_window_rules_keep_rows_without_a_user(spark, folder, tmp_path):
    write_file(folder, 0, [message(f"t{n}", None if n % 2 else "u", n * 30, n - 2) for n in range(8)])
    for n in range(1, 4):
        write_file(folder, n, [message(f"z{n}", "z", n * 90 * 3600)])
    stream = stream_of(spark, folder)
    for name, made, batch, column in [
        ("vel", windows.velocity_per_window(stream, "10 minutes", "5 minutes"),
         rules.velocity_score(batch_of(spark, folder), "10 minutes", "5 minutes"), "tx_count_60s"),
        ("amt", windows.amount_per_window(stream, "2 hours", "1 hour"),
         rules.amount_spike(batch_of(spark, folder), "2 hours", "1 hour"), "user_median_amount"),
    ]:
        drain(made, str(tmp_path / name), str(tmp_path / f"{name}_cp"))
        emitted = spark.read.parquet(str(tmp_path / name)).filter(~F.col("tx_id").startswith("z"))
        assert emitted.count() == 8 * 2
        assert pairs(windows.per_transaction(emitted), "tx_id", column) == pairs(batch, "tx_id", column)


def test_geo_hits_equal_batch(spark, folder, tmp_path):
    sample(folder)
    drain(windows.geo_hits(stream_of(spark, folder)), str(tmp_path / "o"), str(tmp_path / "c"))
    hits = spark.read.parquet(str(tmp_path / "o"))
    want = rules.geo_anomaly(batch_of(spark, folder)).filter("geo_anomaly_flag")
    got = pairs(hits, "tx_id")
    assert len(got) > 10
    assert got == pairs(want, "tx_id")


def test_late_rows_and_duplicates(spark, folder, tmp_path):
    write_file(folder, 0, [message("a", "u", 0), message("a", "u", 0), message("b", "u", 600)])
    write_file(folder, 1, [message("a", "u", 1), message("c", "u", 1200)])
    write_file(folder, 2, [message("late", "u", 5), message("d", "u", 1800)])
    write_file(folder, 3, [message("e", "u", 3600)])
    stream = windows.deduplicated(stream_of(spark, folder))
    drain(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    got = [t for (t,) in pairs(spark.read.parquet(str(tmp_path / "o")), "tx_id")]
    assert got == ["a", "b", "c", "d", "e"]


@pytest.fixture
def rocks(spark):
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


def trailing_brute(rows):
    """rows: (tx, user, seconds, amount, country) in arrival order = time order."""
    out = {}
    base = int((T0 - datetime(1970, 1, 1)).total_seconds())
    for i, (tx, user, s, amount, country) in enumerate(rows):
        mine = [r for r in rows[:i + 1] if r[1] == user]
        n = sum(s - 60 < r[2] <= s for r in mine)
        hour = (base + s) // 3600
        values = sorted(r[3] for r in mine if hour - 24 < (base + r[2]) // 3600 <= hour)
        geo = any(r[4] != country and s - 1800 <= r[2] for r in mine)
        out[tx] = (n, float(values[(len(values) - 1) // 2]), geo)
    return out


def test_live_alerts_end_to_end(spark, rocks, folder, tmp_path):
    rows = []
    for i in range(90):
        burst = 3 if i % 30 < 8 else 1400
        s = (rows[-1][2] if rows else 0) + burst
        rows.append((f"t{i:03d}", "u", s, float(10 + (i * 37) % 50), "US" if i % 13 == 5 else "VN"))
    for n in range(6):
        write_file(folder, n, [message(*r) for r in rows[n * 15:(n + 1) * 15]])
    write_file(folder, 6, [message(*rows[-1])])  # delivered again
    seen = []
    sink = sinks.AlertSink(str(tmp_path), lambda df, i: seen.append((i, df.count())), threshold=1.1)
    inner = sink.__call__
    kept = {}

    def recording(df, batch_id):
        for r in df.collect():
            assert r["tx_id"] not in kept
            kept[r["tx_id"]] = (r["tx_count_60s"], r["user_median_amount"], r["geo_anomaly_flag"])
        inner(df, batch_id)

    query = run_alerts(file_stream(spark, folder), recording, str(tmp_path / "cp"), trigger=None)
    query.awaitTermination(300)
    assert query.exception() is None
    assert kept == trailing_brute(rows)
    alerts = sink.alerts(spark)
    assert alerts.count() == sum(n for _, n in seen) > 10
    assert sink.breaker_log(spark).agg(F.sum("scored_tx")).first()[0] == 90
    top = al.top_flagged_users(alerts).first()
    assert top["user_id"] == "u" and top["total_score"] >= alerts.count()


def scored(spark, flagged, clean):
    rows = [(f"t{i}", f"u{i % 3}", "Grab", 5.0, "VN", T0, i < flagged, 1 if i < flagged else 0)
            for i in range(flagged + clean)]
    return spark.createDataFrame(
        rows, "tx_id string, user_id string, merchant string, amount double, country_code string, "
              "tx_at timestamp_ntz, is_flagged boolean, fraud_score int"
    ).withColumns({"triggered_rules": F.lit("velocity"), "velocity_score": F.col("fraud_score"),
                   "amount_spike_flag": F.lit(None).cast("boolean"),
                   "geo_anomaly_flag": F.lit(False)})


def make_sink(tmp_path, clock):
    sent = []
    sink = sinks.AlertSink(
        str(tmp_path), lambda df, i: sent.append((i, sorted(r["key"] for r in df.collect()))),
        now=lambda: F.lit(clock[0]).cast("timestamp_ntz"))
    return sink, sent


def test_breaker_holds_for_300_seconds(spark, tmp_path):
    clock = [T0]
    sink, sent = make_sink(tmp_path, clock)
    sink(scored(spark, 1, 4), 0)            # 20 %: not above
    assert [i for i, _ in sent] == [0]
    sink(scored(spark, 21, 79), 1)          # 21 %
    clock[0] = T0 + timedelta(seconds=200)
    sink(scored(spark, 1, 9), 2)            # still held
    clock[0] = T0 + timedelta(seconds=299)
    sink(scored(spark, 0, 5), 3)
    assert [i for i, _ in sent] == [0]
    clock[0] = T0 + timedelta(seconds=300)
    sink(scored(spark, 3, 30), 4)
    assert sent[-1] == (4, ["u0", "u1", "u2"])
    log = pairs(sink.breaker_log(spark), "batch_id", "tripped", "flag_until")
    until = T0 + timedelta(seconds=300)
    assert log == [(0, False, None), (1, True, until), (2, False, until), (3, False, until),
                   (4, False, until)]
    assert sink.alerts(spark).count() == 1 + 21 + 1 + 3   # stored although not published


def test_retried_batch_replaces_itself(spark, tmp_path):
    sink, sent = make_sink(tmp_path, [T0])
    for _ in range(2):
        sink(scored(spark, 1, 9), 0)
    assert sink.alerts(spark).count() == 1
    sink(scored(spark, 0, 0), 1)            # an empty batch is harmless
    assert sink.alerts(spark).count() == 1


def test_published_files_hold_the_payload(spark, tmp_path):
    sink = sinks.AlertSink(str(tmp_path), sinks.publish_to_files(str(tmp_path / "topic")))
    sink(scored(spark, 2, 18), 0)
    sent = al.read_alert_payload(spark.read.schema("key string, value string")
                                 .json(str(tmp_path / "topic" / "batch_id=0")))
    assert pairs(sent, "tx_id", "fraud_score", "amount_spike") == [("t0", 1, False), ("t1", 1, False)]


@pytest.mark.parametrize("use_mark,ids", [
    (False, ["a", "b", "c", "older"]), (True, ["a", "b", "c"]),
])
def test_ingest_replay(spark, folder, tmp_path, use_mark, ids):
    first = [message("a", "u", 100), message("a", "u", 100), message("b", "u", 200),
             '{"tx_id": "cut', message(None, "u", 5)]
    write_file(folder, 0, first)
    write_file(folder, 1, first)
    write_file(folder, 2, [message("older", "u", 50), message("c", "u", 300, currency=None,
                                                              is_fraud=None)])
    sink = sinks.IngestSink(str(tmp_path / "t"), use_mark)
    query = run_ingest(file_stream(spark, folder), sink, str(tmp_path / "cp"), trigger=None)
    query.awaitTermination(300)
    assert query.exception() is None
    table = sink.table(spark)
    assert [t for (t,) in pairs(table, "tx_id")] == ids
    row = table.filter("tx_id = 'c'").first()
    assert (row["currency"], row["is_fraud"]) == ("VND", False) and row["ingested_at"] is not None
    dead = pairs(sink.dead_letters(spark).groupBy("reject_reason").count(), "reject_reason", "count")
    assert dead == [("bad_json", 2), ("missing_key", 2)]
    before = table.count()
    sink(file_replay(spark, folder), 3)     # the whole input once more
    assert sink.table(spark).count() == before


def test_running_median_is_the_lower_median():
    import random

    import numpy as np

    rng = random.Random(5)
    values = [rng.randrange(30) / 4 for _ in range(300)]
    none = np.array([])
    assert RunningMedian(none, none, none).median() is None
    start = np.array(values[:100])
    ranks, so_far = RunningMedian(start, np.ones(100), np.array(values)), values[:100]
    for v in values[100:]:
        ranks.add(v)
        so_far = so_far + [v]
        assert ranks.median() == sorted(so_far)[(len(so_far) - 1) // 2]


def test_window_medians_are_exact_in_large_groups(spark):
    n = 60_000
    rows = spark.range(n, numPartitions=4).select(
        F.lit("u").alias("user_id"), F.concat(F.lit("t"), "id").alias("tx_id"),
        F.lit("VN").alias("country_code"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 100 + 1000).alias("amount"),
        F.timestamp_seconds(F.lit(1_714_564_800) + F.col("id") % 3000).alias("tx_at"))
    rows = rows.unionByName(rows.limit(2).select(
        F.lit("z").alias("user_id"), F.concat(F.lit("z"), "tx_id").alias("tx_id"), "country_code",
        (F.when(F.col("tx_id") == "t0", 0.0).otherwise(4.0)).alias("amount"), "tx_at"))
    got = windows.amount_per_window(rows, "2 hours", "1 hour").filter("user_id = 'u'")
    assert {r[0] for r in got.select("user_median_amount").distinct().collect()} == {1000 + (n // 2 - 1) / 100}
    batch = rules.amount_spike(rows.withColumn("tx_at", F.col("tx_at").cast("timestamp_ntz")), "2 hours", "1 hour")
    both = windows.per_transaction(windows.amount_per_window(rows, "2 hours", "1 hour")).alias("w").join(
        batch.alias("b"), "tx_id").filter("not (w.user_median_amount <=> b.user_median_amount)")
    assert both.count() == 0


def test_live_medians_are_exact_and_rows_without_a_user_stay(spark, rocks, folder, tmp_path):
    import random

    from tillwatch.streaming.live import live_scores

    rng = random.Random(3)
    n = 24_000
    amounts = [round(rng.lognormvariate(9, 0.001) if i % 2 else rng.uniform(-5, 20_000), 4) for i in range(n)]
    rows = [(f"t{i:06d}", "u", i * 7200 // n, amounts[i], "VN") for i in range(n)]
    for k in range(3):
        alone = [message(f"x{k}{i}", None, k * 2400 + i, 5.0 + i, "US" if i % 2 else "VN") for i in range(3)]
        write_file(folder, k, [message(*r) for r in rows[k * 8000:(k + 1) * 8000]] + alone)
    out = str(tmp_path / "o")
    drain(live_scores(file_stream(spark, folder)), out, str(tmp_path / "c"))
    got = {r["tx_id"]: r for r in spark.read.parquet(out).collect()}
    assert len(got) == n + 9
    for k in range(3):
        for i in range(3):
            r = got[f"x{k}{i}"]
            assert (r["user_id"], r["tx_count_60s"], r["user_median_amount"], r["geo_anomaly_flag"]) == (None, 1, 5.0 + i, False)
    import bisect

    so_far = []
    for tx, _, _, amount, _ in rows:
        bisect.insort(so_far, amount)
        assert got[tx]["user_median_amount"] == so_far[(len(so_far) - 1) // 2]
