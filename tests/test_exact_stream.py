"""The window-exact stream against the batch rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_streaming import drain, folder, message, rocks, stream_of, write_file  # noqa: F401

from tillwatch.operators import rules
from tillwatch.sources.messages import file_replay, file_stream, parse_transactions
from tillwatch.streaming.exact import country_changes, exact_scores, lowest_median, window_counts
from tillwatch.streaming.live import run_alerts, settled_scores
from tillwatch.streaming.sinks import AlertSink

COLUMNS = ["tx_id", "user_id", "amount", "country_code", "tx_count_60s", "velocity_score", "user_median_amount", "amount_ratio",
           "amount_spike_flag", "geo_anomaly_flag", "fraud_score", "triggered_rules", "is_flagged"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def batch_of(spark, folder):  # noqa: F811
    parsed = parse_transactions(file_replay(spark, folder)).filter(~F.col("tx_id").startswith("z"))
    return parsed.withColumn("country_code", F.upper(F.trim("country"))).withColumn("tx_at", F.col("tx_at").cast("timestamp_ntz")) \
        .dropDuplicates(["tx_id"])


def sample(folder, seed, hours=60):  # noqa: F811
    """Bursts, gaps, missing users, amounts and countries, equal times; disorder within a minute."""
    rnd = random.Random(seed)
    at, lines = 0.0, []
    for n in range(420):
        at += rnd.choice([0, 0.5, 3, 9, 11, 61, 600, hours * 3600 / 420 * 3])
        user = rnd.choice(["a", "a", "a", "b", "c", None])
        lines.append(message(f"t{n}", user, round(at - rnd.choice([0, 0, 20, 45]), 3), rnd.choice([10, 12, 5, 100, 0, None, -3]),
                             rnd.choice(["VN", "VN", "VN", " us", "SG", None])))
    for n in range(7):
        write_file(folder, n, lines[n * 60:(n + 1) * 60])
    write_file(folder, 7, [message("z0", "z", at + 90 * 3600)])
    write_file(folder, 8, [message("z1", "z", at + 200 * 3600)])


@pytest.mark.parametrize("seed,spans", [(1, {}), (2, {"velocity_window": "10 minutes", "velocity_slide": "5 minutes", "amount_window": "2 hours", "geo_within": "3 hours"})])
def test_stream_equals_batch(spark, rocks, folder, tmp_path, seed, spans):  # noqa: F811
    sample(folder, seed)
    out = str(tmp_path / "out")
    drain(exact_scores(stream_of(spark, folder, "2 minutes"), **spans), out, str(tmp_path / "cp"))
    got = spark.read.parquet(out).filter(~F.col("tx_id").startswith("z"))
    want = rows_of(rules.score_transactions(batch_of(spark, folder), **spans))
    assert any(r[1] is None for r in want) and any(r[8] for r in want) and any(r[9] for r in want) and any(r[5] for r in want)
    assert rows_of(got) == want


def test_state_is_below_two_rows_a_transaction_and_goes(spark, rocks, folder, tmp_path):  # noqa: F811
    lines = [message(f"t{n}", f"u{n % 5}", n * 7) for n in range(300)]
    write_file(folder, 0, lines)
    write_file(folder, 1, [message("z0", "z", 300 * 3600)])
    write_file(folder, 2, [message("z1", "z", 600 * 3600)])
    query = (exact_scores(stream_of(spark, folder)).writeStream.format("parquet").option("path", str(tmp_path / "o"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination(300)
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(state) < 2 * 300 and state[-1] < 20
    assert spark.read.parquet(str(tmp_path / "o")).filter("tx_id like 't%'").count() == 300


def test_parts_against_plain_loops():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randrange(1, 30)
        at = np.sort(np.array([rnd.randrange(0, 300) for _ in range(n)]))
        amount = np.array([rnd.choice([1.0, 2.0, 7.0, 0.0, -1.0, np.nan]) for _ in range(n)])
        country = np.array([rnd.choice(["VN", "US", None]) for _ in range(n)], object)
        counts = [max(sum(w <= x < w + 60 for x in at) for w in range(-60, 300, 10) if w <= t < w + 60) for t in at]
        assert window_counts(at, at, 60, 10).tolist() == counts
        medians = []
        for w in range(100 - 50, 101, 10):
            inside = sorted(a for x, a in zip(at, amount) if w <= x < w + 60 and not np.isnan(a))
            if inside:
                m = inside[(len(inside) - 1) // 2]
                medians.append(m if m > 0 else float("inf"))
        assert lowest_median(at, amount, 100, 60, 10) == min(medians, default=None)
        flags = [c is not None and any(d is not None and d != c and 0 <= y - x <= 20 for y, d in zip(at, country)) for x, c in zip(at, country)]
        assert country_changes(at, country, 20).tolist() == flags


def test_settled_alerts_reach_the_sink(spark, rocks, folder, tmp_path):  # noqa: F811
    lines = [message(f"t{n}", "u", n * 5) for n in range(12)] + [message("t0", "u", 0)]
    write_file(folder, 0, lines)
    write_file(folder, 1, [message("z0", "z", 90 * 3600)])
    write_file(folder, 2, [message("z1", "z", 200 * 3600)])
    sink = AlertSink(str(tmp_path / "s"), lambda *_: None)
    run_alerts(file_stream(spark, folder), sink, str(tmp_path / "cp"), trigger=None, scores=settled_scores).awaitTermination(300)
    assert sorted(r["tx_id"] for r in sink.alerts(spark).collect()) == sorted(f"t{n}" for n in range(12))
    assert sink.rollup(spark).agg(F.sum("alerts")).first()[0] == 12
