"""Incremental builds, fused checks, the alert roll-up and table metadata."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_batch_models import raw
from test_streaming import T0, make_sink, scored

from tillwatch.operators import alerts as al
from tillwatch.operators import observe, quality, revenue
from tillwatch.operators.staging import stg_transactions
from tillwatch.plans import batch, catalogue
from tillwatch.plans.batch import QualityError
from tillwatch.plans.incremental import MODELS, IncrementalBuild

DAYS = [datetime(2024, 5, d, 12) for d in (1, 2, 3)]


def day_rows(spark, d, n=20, start=0, **more):
    return raw(spark, [{"tx_id": f"t{DAYS[d].day}-{k}", "user_id": f"u{k % 4}", "tx_at": DAYS[d] + timedelta(minutes=k),
                        "is_fraud": k % 10 == 0, "merchant": ["Grab", "Tiki"][k % 2], **more} for k in range(start, start + n)])


def files(spark, table):
    return sorted(os.path.basename(f) for f in spark.table(table).inputFiles())


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def full(spark, rows):
    staged = stg_transactions(rows)
    merchant, users = revenue.int_merchant_revenue(staged), revenue.int_user_daily_summary(staged)
    return {"int_merchant_revenue": merchant, "int_user_daily_summary": users, "mart_revenue_daily": revenue.mart_revenue_daily(merchant),
            "mart_fraud_report": revenue.mart_fraud_report(users)}


def test_a_new_day_rewrites_one_date(spark):
    build = IncrementalBuild(spark, "inc_")
    assert build.run(day_rows(spark, 0).unionByName(day_rows(spark, 1))) == [date(2024, 5, 1), date(2024, 5, 2)]
    before = {m: {d: [f for f in spark.table(f"inc_{m}").inputFiles() if d in f] for d in ("2024-05-01", "2024-05-02")} for m in MODELS}
    # the new day, and copies of what is stored
    assert build.run(day_rows(spark, 2).unionByName(day_rows(spark, 0, 5))) == [date(2024, 5, 3)]
    for m, old in before.items():
        now = spark.table(f"inc_{m}").inputFiles()
        assert all(f in now for fs in old.values() for f in fs) and any("2024-05-03" in f for f in now)
    every = day_rows(spark, 0).unionByName(day_rows(spark, 1)).unionByName(day_rows(spark, 2))
    for name, want in full(spark, every).items():
        assert same(spark.table(f"inc_{name}"), want), name
    assert spark.table("inc_raw_transactions").count() == 60
    assert {f.split("tx_date=")[1][:10] for f in build.raw_slice([date(2024, 5, 3)]).inputFiles()} == {"2024-05-03"}
    # a late transaction of an old day rewrites that day alone
    assert build.run(day_rows(spark, 0, 1, start=50)) == [date(2024, 5, 1)]
    assert all(f in spark.table("inc_mart_revenue_daily").inputFiles() for f in before["mart_revenue_daily"]["2024-05-02"])
    for name, want in full(spark, every.unionByName(day_rows(spark, 0, 1, start=50))).items():
        assert same(spark.table(f"inc_{name}"), want), name
    assert build.run(day_rows(spark, 0)) == []


def test_a_stopped_run_is_completed_by_the_next(spark, monkeypatch):
    build = IncrementalBuild(spark, "stop_")
    build.run(day_rows(spark, 0))
    with monkeypatch.context() as stopped:
        stopped.setattr(build, "build", lambda dates: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            build.run(day_rows(spark, 1))
    assert build.run(day_rows(spark, 2)) == [date(2024, 5, 2), date(2024, 5, 3)]
    every = day_rows(spark, 0).unionByName(day_rows(spark, 1)).unionByName(day_rows(spark, 2))
    assert same(spark.table("stop_mart_fraud_report"), full(spark, every)["mart_fraud_report"])
    assert spark.table("stop_pending_dates").count() == 0


def test_bad_rows_stop_before_any_model(spark):
    build = IncrementalBuild(spark, "bad_")
    with pytest.raises(QualityError) as stopped:
        build.run(day_rows(spark, 0, device="fridge"))
    assert stopped.value.violations == [("stg_transactions", "accepted_values", "device", 20)]
    assert not spark.catalog.tableExists("bad_int_merchant_revenue")


def scans(df, text="Scan parquet"):
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    return plan.count(text)


def test_one_scan_per_relation_gives_the_rows_of_the_single_checks(spark, sf):
    relations = catalogue._relations(spark, sf)
    assert same(quality.profile_all(relations), quality.check_columns(relations))
    for name, df in relations.items():
        assert scans(quality.profile(df, name)) == 1
    dirty = raw(spark, [{"tx_id": "a"}, {"tx_id": "a", "amount": None}, {"tx_id": None, "device": "x"}, {"tx_id": None}])
    found = {(r["rule"], r["column"]): r["violations"] for r in quality.profile(dirty, "raw_transactions", {"cheap": F.col("amount") < 10**6}).collect()}
    assert (found["unique", "tx_id"], found["not_null", "tx_id"], found["not_null", "amount"], found["condition", "cheap"]) == (1, 2, 1, 3)
    assert all(r["violations"] == 0 for r in quality.profile(dirty.limit(0), "raw_transactions").collect())


def test_checks_are_taken_while_a_model_is_written(spark, tmp_path):
    merchant = revenue.int_merchant_revenue(stg_transactions(day_rows(spark, 0, merchant=None)))
    mart = revenue.mart_revenue_daily(merchant)
    checks = quality.Observed("mart_revenue_daily")
    checks.on(mart).write.parquet(str(tmp_path / "mart"))
    want = [tuple(r) for r in quality.check_not_null({"mart_revenue_daily": mart}).filter("violations > 0").collect()]
    assert sorted(checks.violations()) == sorted((r, k, c, n) for r, k, c, n in want) != []


def test_the_rollup_gives_the_feeds_of_the_alerts(spark, sf):
    alerts = catalogue.alerts(spark, sf).persist()
    odd = alerts.limit(3).withColumns({"tx_at": F.lit("unreadable"), "tx_id": F.lit("odd")})
    alerts = alerts.unionByName(odd)
    halves = [al.alert_rollup(alerts.filter(F.crc32(F.col("tx_id").cast("binary")) % 2 == k)) for k in (0, 1)]
    rollup = al.merge_rollups(halves[0].unionByName(halves[1]))
    pairs = [(al.rollup_totals(rollup), al.alert_totals(alerts)), (al.rollup_by_user(rollup), al.alerts_by_user(alerts)),
             (al.rollup_top_users(rollup), al.top_flagged_users(alerts)), (al.rollup_heatmap(rollup), al.alert_heatmap(alerts)),
             (al.rollup_heatmap_pivot(rollup), al.alert_heatmap_pivot(alerts))]
    for now in (datetime(2024, 1, 31), datetime(2024, 1, 20, 7, 41, 3)):
        column = F.lit(now).cast("timestamp_ntz")
        pairs.append((al.rollup_trend_hourly(rollup, now, alerts), al.alert_trend_hourly(alerts, column)))
    for got, want in pairs:
        assert [tuple(r) for r in got.select(sorted(got.columns)).collect()] == [tuple(r) for r in want.select(sorted(want.columns)).collect()] \
            or same(got, want)
    with pytest.raises(ValueError):
        al.rollup_trend_hourly(rollup, datetime(2024, 1, 20, 7, 41))


def test_the_sink_keeps_a_rollup_of_few_rows(spark, tmp_path):
    sink, _ = make_sink(tmp_path, [T0])
    sink._rollup.fan = 3
    for n in range(9):
        for _ in range(2):      # each batch twice: a retry replaces itself
            sink(scored(spark, 6, 60).withColumn("user_id", F.concat(F.lit("u"), (F.length("tx_id") % 2).cast("string"))), n)
    alerts, rollup = sink.alerts(spark), sink.rollup(spark)
    assert alerts.count() == 54 and al.rollup_totals(rollup).first()[0] == 54
    assert same(al.rollup_by_user(rollup), al.alerts_by_user(alerts))
    assert rollup.count() < 9


def test_metadata_comes_from_footers(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, [1]), (2, "a", None), (None, "b", [2])], "n int, t string, l array<int>")
    path = str(tmp_path / "t")
    rows.repartition(3).write.parquet(path)
    found = observe.table_metadata(spark, {"t": path})
    assert [(r["ordinal"], r["column_name"], r["data_type"], r["row_count"], r["nulls"]) for r in found.collect()] == [
        (1, "n", "int", 3, 1), (2, "t", "string", 3, 1), (3, "l", "array<int>", 3, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    snapshot = observe.metadata_snapshot(found, F.lit(T0).cast("timestamp_ntz"))
    wider = observe.metadata_snapshot(observe.table_metadata(spark, {"t": path}).filter("ordinal < 3"), F.lit(T0 - timedelta(days=1)).cast("timestamp_ntz"))
    assert observe.diff_snapshots(snapshot, wider, F.lit(T0)).first()["added"] == ["l"]


def test_run_batch_scans_the_raw_table_few_times(spark, monkeypatch):
    rows = raw(spark, [{"is_fraud": i % 10 == 0, "user_id": f"u{i % 3}"} for i in range(50)])
    calls = []
    inner = quality.profile
    monkeypatch.setattr(quality, "profile", lambda df, relation, more=None: calls.append(relation) or inner(df, relation, more))
    batch.run_batch(spark, rows, "few_")
    assert sorted(calls) == ["mart_fraud_report", "raw_transactions", "stg_transactions"]
