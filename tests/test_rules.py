import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import rules

T0 = datetime(2024, 5, 1, 12, 0, 0)
SCHEMA = ("tx_id string, user_id string, merchant string, amount decimal(15,2), "
          "country_code string, tx_at timestamp_ntz")


def table(spark, rows):
    """rows: (tx_id, user, seconds after T0, amount, country)"""
    from decimal import Decimal

    return spark.createDataFrame(
        [(i, u, "Grab", None if a is None else Decimal(str(a)), c, T0 + timedelta(seconds=s))
         for i, u, s, a, c in rows], SCHEMA)


def by_tx(df, *cols):
    return {r["tx_id"]: tuple(r[c] for c in cols) for r in df.collect()}


PATHS = pytest.mark.parametrize("hot_user_rows", [rules.HOT_USER_ROWS, 0])


@PATHS
@pytest.mark.parametrize("n,score", [(5, 0), (6, 1), (10, 1), (11, 2)])
def test_velocity_thresholds(spark, n, score, hot_user_rows):
    df = table(spark, [(f"t{i}", "u", i * 5, 1, "VN") for i in range(n)])
    got = by_tx(rules.velocity_score(df, hot_user_rows=hot_user_rows), "tx_count_60s",
                "velocity_score")
    assert set(got.values()) == {(n, score)}


@PATHS
def test_velocity_burst_is_flagged_throughout(spark, hot_user_rows):
    df = table(spark, [(f"t{i}", "u", i * 7, 1, "VN") for i in range(8)]
               + [("later", "u", 3600, 1, "VN")])
    got = by_tx(rules.velocity_score(df, hot_user_rows=hot_user_rows), "velocity_score")
    assert got.pop("later") == (0,)
    assert set(got.values()) == {(1,)}


@PATHS
@pytest.mark.parametrize("amount,rest,flag,ratio", [
    ("50000", "50000", False, 1.0),
    ("150000", "50000", False, 3.0),
    ("150001", "50000", True, 3.0),
    ("500000", "50000", True, 10.0),
    ("5", "0", None, None),
])
def test_amount_boundaries(spark, amount, rest, flag, ratio, hot_user_rows):
    rows = [(f"r{i}", "u", i, rest, "VN") for i in range(9)] + [("x", "u", 20, amount, "VN")]
    got = by_tx(rules.amount_spike(table(spark, rows), hot_user_rows=hot_user_rows),
                "amount_spike_flag", "amount_ratio")
    assert got["x"] == (flag, ratio)


def test_rounding_before_comparing_is_an_option(spark):
    rows = [(f"r{i}", "u", i, 50000, "VN") for i in range(9)] + [("x", "u", 20, 150001, "VN")]
    got = by_tx(rules.amount_spike(table(spark, rows), round_before_compare=True),
                "amount_spike_flag")
    assert got["x"] == (False,)


@PATHS
@pytest.mark.parametrize("minutes,country,flag", [
    (5, "VN", False), (15, "US", True), (30, "US", True), (31, "US", False), (-1, "US", False),
    (0, "US", True), (10, None, False),
])
def test_geo_boundaries(spark, minutes, country, flag, hot_user_rows):
    df = table(spark, [("x", "u", 0, 1, "VN"), ("y", "u", minutes * 60, 1, country)])
    got = by_tx(rules.geo_anomaly(df, hot_user_rows=hot_user_rows), "geo_anomaly_flag")
    assert got["x"] == (flag,)


@PATHS
def test_geo_looks_past_same_country_and_missing_countries(spark, hot_user_rows):
    df = table(spark, [("a", "u", 0, 1, "VN"), ("b", "u", 60, 1, None), ("c", "u", 120, 1, "VN"),
                       ("d", "u", 1700, 1, "US"), ("e", "u", 1900, 1, "US")])
    got = by_tx(rules.geo_anomaly(df, hot_user_rows=hot_user_rows), "geo_anomaly_flag")
    assert got == {"a": (True,), "b": (False,), "c": (True,), "d": (False,), "e": (False,)}


def test_rows_without_user_match_nobody(spark):
    df = table(spark, [(f"t{i}", None, i, 10 ** i, "VN" if i % 2 else "US") for i in range(8)])
    got = by_tx(rules.score_transactions(df), "tx_count_60s", "amount_ratio", "geo_anomaly_flag",
                "fraud_score")
    assert set(got.values()) == {(1, 1.0, False, 0)}


def test_all_rule_combinations(spark):
    rows = [(f"{v}{a}{g}", v, bool(a), bool(g)) for v in (0, 1, 2) for a in (0, 1) for g in (0, 1)]
    df = spark.createDataFrame(rows + [("null", 0, None, None)],
                               "tx_id string, velocity_score int, amount_spike_flag boolean, "
                               "geo_anomaly_flag boolean")
    got = by_tx(rules.combine_scores(df), "fraud_score", "triggered_rules", "is_flagged")
    names = ["velocity", "amount_spike", "geo_anomaly"]
    for tx, v, a, g in rows:
        fired = [n for n, on in zip(names, (v > 0, a, g)) if on]
        assert got[tx] == (len(fired), ",".join(fired), bool(fired))
    assert got["null"] == (0, "", False)


def brute(rows, velocity, amount, geo):
    """Plain-Python scores: every window of every row looked at."""
    def starts(t, w, s):
        first = t - t % s
        return range(first - w + s, first + 1, s)

    out = {}
    for i, u, t, a, c in rows:
        mine = [r for r in rows if r[1] == u]
        count = max(sum(w <= r[2] < w + velocity[0] for r in mine) for w in starts(t, *velocity))
        medians = []
        for w in starts(t, *amount):
            values = sorted(r[3] for r in mine if w <= r[2] < w + amount[0])
            medians.append(values[(len(values) - 1) // 2])
        hit = any(r[4] != c and t <= r[2] <= t + geo for r in mine)
        out[i] = (count, float(min(medians)), hit)
    return out


@pytest.mark.parametrize("seed", range(3))
@PATHS
def test_against_brute_force(spark, seed, hot_user_rows):
    rng = random.Random(seed)
    rows = [(f"t{i:03d}", f"u{int(rng.random() ** 3 * 4)}", rng.randrange(0, 6 * 3600, 5),
             rng.randrange(1, 60), rng.choice(["VN", "VN", "VN", "US", "JP"])) for i in range(150)]
    df = rules.score_transactions(
        table(spark, rows), velocity_window="10 minutes", velocity_slide="2 minutes",
        amount_window="2 hours", amount_slide="30 minutes", geo_within="20 minutes",
        hot_user_rows=hot_user_rows)
    got = by_tx(df, "tx_count_60s", "user_median_amount", "geo_anomaly_flag")
    # T0 is a multiple of every slide used here
    assert got == brute(rows, (600, 120), (7200, 1800), 1200)


def test_order_and_partitioning_do_not_matter(spark, staged):
    def rows(df):
        return sorted(map(str, rules.score_transactions(df).collect()))

    want = rows(staged)
    assert rows(staged.repartition(13)) == want
    assert rows(staged.orderBy(F.rand(7))) == want


def test_mixed_sizes_take_both_paths(spark, staged):
    split = rules.score_transactions(staged, hot_user_rows=60)
    assert sorted(map(str, split.collect())) == sorted(
        map(str, rules.score_transactions(staged).collect()))


def test_median_of_a_large_user_is_exact_on_both_paths(spark):
    n = F.col("id")
    df = spark.range(60_000).select(
        n.cast("string").alias("tx_id"), F.lit("u").alias("user_id"), F.lit("Grab").alias("merchant"),
        F.when(n % 50 != 7, F.pmod(F.xxhash64("id"), F.lit(9_000_000)) / 100).cast("decimal(15,2)")
        .alias("amount"),
        F.lit("VN").alias("country_code"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=n * 3)).alias("tx_at"))
    paths = [by_tx(rules.amount_spike(df, hot_user_rows=k), "user_median_amount", "amount_spike_flag")
             for k in (100_000, 0)]
    assert paths[0] == paths[1]
    windows = [sorted(map(tuple, rules.amount_windows(df, hot_user_rows=k).collect()))
               for k in (100_000, 0)]
    assert windows[0] == windows[1]
    rows = [(r["tx_at"], float(r["amount"])) for r in df.collect() if r["amount"] is not None]
    for _, start, end, median in windows[0][::10]:
        held = sorted(a for t, a in rows if start <= t < end)
        assert median == held[(len(held) - 1) // 2]


def test_windows_without_amounts_and_negative_amounts_on_both_paths(spark):
    df = table(spark, [("a", "u", 0, None, "VN"), ("b", "u", 90_000, -5, "VN"),
                       ("c", "u", 90_001, -71234, "VN"), ("d", "u", 90_002, 3, "VN"),
                       ("e", None, 0, None, "VN"), ("f", "v", 0, 0.5, "VN")])
    small, hot = (sorted(map(str, rules.amount_windows(df, hot_user_rows=k).collect()))
                  for k in (100, 0))
    assert small == hot and len(small) > 90


def test_pairs_name_every_flagged_moment(spark):
    df = table(spark, [("a", "u", 0, 1, "VN"), ("b", "u", 0, 1, "US"), ("c", "u", 60, 1, "US"),
                       ("d", "v", 0, 1, "JP"), ("e", "v", 1800, 1, "VN"), ("f", "v", 1800, 1, "SG"),
                       ("g", "v", 1800, 1, "US"), ("h", "w", 0, 1, "VN"), ("i", "w", 9, 1, "VN")])
    pairs = {(r["tx_id"], r["pair_tx_id"]) for r in rules.geo_pairs(df).collect()}
    assert pairs == {("a", "b"), ("b", "a"), ("d", "f"), ("e", "f"), ("f", "g"), ("g", "f")}
    flagged = {t for t, (f,) in by_tx(rules.geo_anomaly(df), "geo_anomaly_flag").items() if f}
    assert flagged == {a for a, _ in pairs}


def test_usual_plan_has_one_exchange_and_no_hot_branch(spark, staged):
    df = rules.score_transactions(staged)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")]
    assert "Union" not in final
    assert final.count("Exchange hashpartitioning") == 1


def test_hot_rows_are_read_from_the_source_three_times(spark, tmp_path):
    rows = [(f"t{i:03d}", "hot" if i % 3 == 0 else f"u{i % 7}" if i % 11 else None, i * 37, i % 50 + 1, "VN" if i % 5 else "US") for i in range(300)]
    table(spark, rows).write.parquet(str(tmp_path / "t"))
    reads = []
    df = spark.read.parquet(str(tmp_path / "t"))

    def watched(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        reads.append(plan.split("Initial Plan")[0].count("FileScan parquet"))
        return frame

    scored = rules.score_transactions(df, hot_user_rows=50)
    # one scan told who is hot, one stored the hot rows, one is left for the other users
    watched(scored)
    assert reads == [1]
    usual = rules.score_transactions(df)
    assert sorted(map(str, scored.collect())) == sorted(map(str, usual.select(scored.columns).collect()))
    watched(usual)
    assert reads[-1] == 1


def test_a_longer_list_of_hot_users_is_joined(spark, staged, monkeypatch):
    want = sorted(map(str, rules.score_transactions(staged).collect()))
    monkeypatch.setattr(rules, "MOST_LISTED", 1)
    assert sorted(map(str, rules.score_transactions(staged, hot_user_rows=20).select(rules.score_transactions(staged).columns).collect())) == want


def test_window_has_to_be_whole_slides(spark, staged):
    with pytest.raises(ValueError):
        rules.velocity_score(staged, "25 seconds", "10 seconds")
