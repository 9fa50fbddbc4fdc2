from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import alerts as al
from tillwatch.operators import observe
from tillwatch.plans import observability
from tillwatch.plans.observability import BreakingSchemaChange
from tillwatch.schemas import ALERTS, BREAKER_LOG, FRESHNESS_HISTORY, SCHEMA_DIFFS

T0 = datetime(2024, 5, 1, 12, 0, 0)     # a Wednesday


def alerts(spark, rows):
    """rows: (batch, tx, user, tx_at text, score)"""
    return spark.createDataFrame(
        [(b, t, u, "Grab", 1.0, "VN", at, s, "velocity", 1, False, False)
         for b, t, u, at, s in rows], ALERTS)


def test_empty_alerts(spark):
    none = alerts(spark, [])
    assert al.alert_totals(none).first()[0] == 0
    assert al.recent_alerts(none).count() == 0
    assert al.alert_heatmap(none).agg(F.count("*"), F.sum("count")).first() == (168, 0)
    stats = al.alert_stats(none, spark.createDataFrame([], BREAKER_LOG),
                           F.lit(T0).cast("timestamp_ntz")).first()
    assert (stats[0], stats[1], stats[2]) == (0, False, [])


def test_counters_ranking_and_ties(spark):
    df = alerts(spark, [(0, "a", "u1", "2024-05-01 12:00:00", 2), (0, "b", "u1", "x", 1),
                        (1, "c", "u2", "2024-05-01 12:00:00", 3), (1, "d", "u0", "x", 1)])
    assert al.alert_totals(df).first()[0] == 4
    assert [(r[0], r[1]) for r in al.top_flagged_users(df).collect()] == [
        ("u2", 3), ("u1", 3), ("u0", 1)]
    by_user = {r["user_id"]: (r["alert_count"], r["total_score"])
               for r in al.alerts_by_user(df).collect()}
    assert by_user == {"u1": (2, 3), "u2": (1, 3), "u0": (1, 1)}
    assert [r["tx_id"] for r in al.recent_alerts(df, 2).collect()] == ["d", "c"]


def test_counts_read_all_alerts(spark):
    df = alerts(spark, [(i, f"t{i:04d}", "u", "2024-05-01 12:30:00", 1) for i in range(1200)])
    assert al.recent_alerts(df, 1000).count() == 1000
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            al.recent_alerts(df, limit)
    cell = F.col("count") > 0
    assert [(r["day"], r["hour"], r["count"]) for r in al.alert_heatmap(df).filter(cell).collect()] \
        == [("Wed", 12, 1200)]
    pivot = al.alert_heatmap_pivot(df).collect()
    assert [r["day"] for r in pivot] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert pivot[2]["h12"] == 1200 and pivot[2]["h13"] == 0


def test_trend_reads_every_time_form(spark):
    df = alerts(spark, [(0, str(i), "u", at, 1) for i, at in enumerate([
        "2024-05-01 11:59:59.5", "2024-05-01T12:10:00", "2024-05-01T12:20:00Z",
        "2024-05-01T19:30:00+07:00", "2024-04-30T12:00:00", "2024-04-30 11:59:59", "garbage", None,
    ])])
    got = [tuple(r) for r in al.alert_trend_hourly(df, F.lit(T0).cast("timestamp_ntz")).collect()]
    assert got == [("2024-04-30T12:00:00", 1), ("2024-05-01T11:00:00", 1), ("2024-05-01T12:00:00", 3)]


def test_breaker_is_strict(spark):
    scored = spark.createDataFrame(
        [(b, i < n, T0) for b, n in ((0, 20), (1, 21)) for i in range(100)],
        "batch_id bigint, is_flagged boolean, tx_at timestamp_ntz")
    log = al.circuit_breaker(scored, F.max("tx_at"))
    assert [(r["batch_id"], r["tripped"], r["flag_until"])
            for r in log.orderBy("batch_id").collect()] == [
        (0, False, None), (1, True, T0 + timedelta(seconds=300))]
    for seconds, active in ((299, True), (300, False)):
        now = F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp_ntz")
        assert al.breaker_active(log, now).first()[0] is active


def test_unreadable_alert_records_are_skipped(spark):
    good = al.alert_payload(alerts(spark, [(0, "a", "u", "x", 1)]))
    bad = spark.createDataFrame([("u", "{oops"), ("u", '{"user_id": "u"}')], "key string, value string")
    (row,) = al.read_alert_payload(good.unionByName(bad)).collect()
    assert row["tx_id"] == "a" and row["geo_anomaly"] is False


def tables(spark, **schemas):
    return {name: spark.createDataFrame([], ddl) for name, ddl in schemas.items()}


def test_schema_diff_classes(spark):
    def snap(at, **schemas):
        return observe.snapshot_schema(spark, tables(spark, **schemas), at)

    old = snap(T0, add="a int", drop="a int, b int", retype="a int, b int", same="a int",
               forgotten="a int").unionByName(snap(T0 - timedelta(1), same="z int"))
    new = snap(T0 + timedelta(1), add="a int, c int", drop="a int", retype="a int, b string",
               same="a int", fresh="a int")
    new = new.withColumn("is_nullable", F.lit(False)).withColumn("column_default", F.lit("0"))
    now = F.lit(T0).cast("timestamp_ntz")
    got = {r["source_name"]: (r["has_changes"], r["is_breaking"], r["added"], r["removed"],
                              [tuple(c) for c in r["type_changed"]])
           for r in observe.diff_snapshots(new, old, now).collect()}
    assert got == {
        "add": (True, False, ["c"], [], []),
        "drop": (True, True, [], ["b"], []),
        "retype": (True, True, [], [], [("b", "int", "string")]),
        "same": (False, False, [], [], []),
        "fresh": (False, False, [], [], []),
    }
    assert observe.diff_snapshots(new, old, now).schema.simpleString() == \
        spark.createDataFrame([], SCHEMA_DIFFS).schema.simpleString()


@pytest.mark.parametrize("hours,sla,status", [
    (0.75, 1.0, "fresh"), (0.76, 1.0, "warning"), (1.0, 1.0, "warning"), (1.01, 1.0, "stale"),
    (None, 1.0, "stale"), (0.1, 0.0, "stale"),
])
def test_freshness_boundaries(spark, hours, sla, status):
    updated = None if hours is None else T0 - timedelta(hours=hours)
    df = spark.createDataFrame([("t", T0, updated, sla)],
                               "source_name string, checked_at timestamp_ntz, "
                               "last_updated timestamp_ntz, sla_hours double")
    row = observe.with_freshness(df).first()
    assert row["status"] == status
    assert row["hours_since_update"] == (float("inf") if hours is None else pytest.approx(hours))


def test_missing_timestamp_column_is_stale(spark):
    checked = observe.check_freshness(
        {"mart_revenue_daily": spark.range(3).toDF("tx_count"),
         "raw_transactions": spark.createDataFrame([(T0,)], "ingested_at timestamp_ntz")},
        F.lit(T0 + timedelta(minutes=30)).cast("timestamp_ntz"))
    assert {r["source_name"]: r["status"] for r in checked.collect()} == {
        "mart_revenue_daily": "stale", "raw_transactions": "fresh"}
    (notice,) = observe.stale_notices(checked).collect()
    assert notice["notice"] == ("mart_revenue_daily: no update for inf hours, allowed are 2.0; "
                                "newest row: none")


@pytest.mark.parametrize("statuses,drift,score,grade", [
    (["stale", "stale", "fresh"], [(True, True), (True, False)], 70, "D"),
    (["stale"] * 6, [], 100, "F"),
    (["warning"], [(False, False)], 10, "A"),
    (["warning"], [(True, False)], 15, "B"),
    (["stale", "warning"], [(True, False)], 35, "C"),
    ([], [], 0, "A"),
])
def test_data_debt(spark, statuses, drift, score, grade):
    fresh = spark.createDataFrame(
        [(f"t{i}", T0, None, 0.0, 1.0, s) for i, s in enumerate(statuses)]
        + [("t0", T0 - timedelta(1), None, 0.0, 1.0, "stale")] * bool(statuses), FRESHNESS_HISTORY)
    diffs = spark.createDataFrame(
        [(f"t{i}", T0, c, b, [], [], []) for i, (c, b) in enumerate(drift)], SCHEMA_DIFFS)
    row = observe.data_debt(fresh, diffs).first()
    assert (row["data_debt_score"], row["grade"]) == (score, grade)
    assert len(row["details"]) == sum(s != "fresh" for s in statuses) + sum(c for c, _ in drift)


def test_drift_gate_and_history(spark):
    hour = timedelta(hours=1)
    assert observability.latest(spark, "obs_")["freshness"].count() == 0
    assert observability.debt(spark, "obs_").first()["data_debt_score"] == 0
    observability.run_schema_check(spark, tables(spark, t="a int"), T0, "obs_")
    observability.run_schema_check(spark, tables(spark, t="a int, b int"), T0 + hour, "obs_")
    with pytest.raises(BreakingSchemaChange, match="t"):
        observability.run_schema_check(spark, tables(spark, t="a int"), T0 + 2 * hour, "obs_")
    diffs = spark.table("obs_schema_diffs").orderBy("checked_at").collect()
    assert [(r["has_changes"], r["is_breaking"]) for r in diffs] == [
        (False, False), (True, False), (True, True)]
    notices = observability.run_freshness_check(
        spark, {"t": spark.createDataFrame([(T0,)], "at timestamp_ntz")}, T0 + 2 * hour, "obs_",
        sla_hours={"t": 1.0}, columns={"t": "at"})
    assert notices.count() == 1
    debt = observability.debt(spark, "obs_").first()
    assert (debt["data_debt_score"], debt["grade"]) == (45, "C")
    drift = observability.latest(spark, "obs_")["schema_drift"].first()
    assert drift["diff_json"] == '{"added":[],"removed":["b"],"type_changed":[]}'


def test_stats_of_scored_equal_the_stats_of_alerts_and_breaker_log(spark):
    rows = [(b, f"t{b}-{i}", u, f, score, datetime(2024, 1, 1, b, i))
            for b, flags in ((1, "10000"), (2, "11010"), (3, "0000"))
            for i, (u, f, score) in enumerate(
                (("u%d" % (i % 3) if i < 4 else None), x == "1", 1 + i % 2) for i, x in enumerate(flags))]
    schema = ("batch_id bigint, tx_id string, user_id string, is_flagged boolean, fraud_score int, "
              "tx_at timestamp_ntz")
    scored = spark.createDataFrame(rows, schema)
    for part in (scored, scored.filter("false"), scored.withColumn("user_id", F.lit(None).cast("string"))):
        log = al.circuit_breaker(part, F.max("tx_at"))
        for minute in (0, 7, 30):
            now = F.lit(datetime(2024, 1, 1, 2, minute)).cast("timestamp_ntz")
            for top in (1, 10):
                want = al.alert_stats(part.filter("is_flagged"), log, now, top).collect()
                assert al.stats_of_scored(part, F.max("tx_at"), now, top).collect() == want
