from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import ingest, quality, revenue
from tillwatch.operators.staging import stg_transactions
from tillwatch.plans import catalogue
from tillwatch.plans.batch import QualityError, run_batch, run_scoring
from tillwatch.schemas import RAW_TRANSACTIONS
from tillwatch.sources.messages import dead_letter_counts, parse_transactions, split_dead_letters
from tillwatch.sources.tables import append_bucketed, read_or_empty

T0 = datetime(2024, 5, 1, 12, 0, 0, 123456)


def raw(spark, rows):
    """rows: dicts of what differs from a clean transaction"""
    base = {"user_id": "u1", "merchant": "Grab", "amount": Decimal("10.00"), "currency": "VND",
            "country": "VN", "tx_at": T0, "device": "pos", "is_fraud": False, "fraud_reason": None,
            "ingested_at": T0}
    columns = ["tx_id", *base]
    return spark.createDataFrame(
        [tuple({"tx_id": f"t{i}", **base, **r}[c] for c in columns) for i, r in enumerate(rows)],
        RAW_TRANSACTIONS)


def test_staging_cleans_and_drops(spark):
    df = stg_transactions(raw(spark, [
        {"user_id": " u ", "merchant": " MoMo", "currency": " vnd", "country": "sg ",
         "device": " Web", "is_fraud": None},
        {"tx_id": None}, {"tx_at": None}, {"amount": Decimal("0.00")}, {"amount": None},
        {"amount": Decimal("-1.00")},
    ]))
    (row,) = df.collect()
    assert (row["user_id"], row["merchant"], row["currency"], row["country_code"], row["device"],
            row["is_fraud"]) == ("u", "MoMo", "VND", "SG", "web", False)
    assert row["tx_at"] == T0.replace(microsecond=123000) and row["tx_date"] == date(2024, 5, 1)
    assert dict(df.dtypes)["tx_at"] == "timestamp_ntz"


def test_mart_rates_category_and_null_merchant(spark):
    df = stg_transactions(raw(spark, [
        {"is_fraud": True}, {}, {"user_id": "u2"}, {"merchant": None}, {"merchant": "Corner Shop"},
    ]))
    mart = {r["merchant"]: r for r in revenue.mart_revenue_daily(
        revenue.int_merchant_revenue(df)).collect()}
    assert mart["Grab"]["category"] == "transport"
    assert mart["Corner Shop"]["category"] == "other"
    assert mart[None]["category"] is None
    assert mart["Grab"]["unique_users"] == 2
    assert mart["Grab"]["fraud_rate_pct"] == Decimal("33.3333")
    assert mart[None]["fraud_amount_vnd"] == 0


def test_half_up_average(spark):
    df = stg_transactions(raw(spark, [{"amount": Decimal("40.00")}, {"amount": Decimal("40.57")}]))
    row = revenue.mart_revenue_daily(revenue.int_merchant_revenue(df)).first()
    assert row["avg_tx_value_vnd"] == Decimal("40.29")


def test_fraud_report_covers_fraud_days_only(spark):
    day = timedelta(days=1)
    df = stg_transactions(raw(spark, [
        {"is_fraud": True}, {"tx_at": T0 + timedelta(hours=1)}, {"tx_at": T0 + day},
        {"user_id": "clean"},
    ]))
    (row,) = revenue.mart_fraud_report(revenue.int_user_daily_summary(df)).collect()
    assert row["user_id"] == "u1" and row["user_fraud_rate_pct"] == Decimal("50.00")
    assert row["last_fraud_at"] == (T0 + timedelta(hours=1)).replace(microsecond=123000)


def test_limits_are_checked(spark, sf):
    with pytest.raises(ValueError):
        revenue.revenue_daily(catalogue.mart(spark, sf), limit=366)


def test_quality_counts(spark):
    rows = raw(spark, [
        {}, {"tx_id": "t0"}, {"tx_id": None, "device": None}, {"device": "kiosk"},
        {"amount": Decimal("-1.00")}, {"currency": "USD"},
    ])
    got = {(r["rule"], r["column"]): r["violations"]
           for r in quality.check_columns({"raw_transactions": rows}).collect()}
    assert got == {
        ("not_null", "tx_id"): 1, ("not_null", "user_id"): 0, ("not_null", "amount"): 0,
        ("not_null", "tx_at"): 0, ("unique", "tx_id"): 1, ("accepted_values", "currency"): 1,
        ("accepted_values", "device"): 1,
    }
    assert [r["amount"] for r in quality.negative_amounts(rows).collect()] == [Decimal("-1.00")]


@pytest.mark.parametrize("fraud,total,outside", [
    (0, 0, 0), (1, 2000, 1), (1, 1000, 0), (20, 100, 0), (25, 100, 1),
])
def test_fraud_rate_band(spark, fraud, total, outside):
    mart = spark.createDataFrame([(total, fraud)] if total else [],
                                 "tx_count bigint, fraud_tx_count bigint")
    assert quality.fraud_rate_outside(revenue.overall_fraud_rate(mart)).count() == outside


def test_parse_boundaries(spark):
    def body(tx, at):
        return '{"tx_id": %s, "user_id": "u", "amount": 1.5, "tx_at": "%s"}' % (tx, at)

    messages = spark.createDataFrame([
        (body('"zone"', "2024-05-01T12:00:00+07:00"),), (body('"plain"', "2024-05-01T12:00:00"),),
        (body('"zulu"', "2024-05-01T12:00:00Z"),), ("{not json",), (body("null", "2024-05-01"),),
        (body('"bad"', "garbage"),),
    ], "value string")
    got = {r["tx_id"]: r["at"] for r in parse_transactions(messages).select(
        "tx_id", F.col("tx_at").cast("timestamp_ntz").alias("at")).collect()}
    assert got == {"zone": datetime(2024, 5, 1, 5), "plain": datetime(2024, 5, 1, 12),
                   "zulu": datetime(2024, 5, 1, 12)}
    good, dead = split_dead_letters(messages)
    assert good.count() == 3
    assert {r["reject_reason"] for r in dead.collect()} == {"bad_json", "missing_key", "bad_time"}
    assert {r["outcome"]: r["messages"] for r in dead_letter_counts(messages).collect()} == {
        "accepted": 3, "bad_json": 1, "missing_key": 1, "bad_time": 1}
    binary = messages.select(F.col("value").cast("binary").alias("value"))
    assert parse_transactions(binary).count() == 3


def test_insert_if_absent_keeps_the_first_arrival(spark):
    table = raw(spark, [{"tx_id": "old"}])
    incoming = raw(spark, [
        {"tx_id": "old"}, {"tx_id": "new", "tx_at": T0 + timedelta(1), "merchant": "second"},
        {"tx_id": "new", "merchant": "first"}, {"tx_id": None},
    ])
    (row,) = ingest.insert_if_absent(incoming, table).collect()
    assert (row["tx_id"], row["merchant"]) == ("new", "first")
    assert ingest.insert_if_absent(incoming, table.limit(0)).count() == 2


def test_high_water_mark(spark):
    table = raw(spark, [{"tx_at": T0}])
    incoming = raw(spark, [{"tx_at": T0}, {"tx_at": T0 + timedelta(seconds=1)}])
    assert ingest.above_mark(incoming, table).count() == 1
    assert ingest.above_mark(incoming, table.limit(0)).count() == 2


def test_bucketed_table_stays_in_place(spark):
    incoming = raw(spark, [{} for _ in range(20)])
    append_bucketed(incoming.limit(10), "bucketed_raw", buckets=4)
    new = ingest.insert_if_absent(incoming, spark.table("bucketed_raw"))
    assert new.count() == 10
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = ingest.insert_if_absent(incoming, spark.table("bucketed_raw"))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", off)
    stored = text[text.index("bucketed_raw") - 1500:text.index("bucketed_raw")]
    assert "Bucketed: true" in text and stored.count("Exchange") <= 1


def test_gates(spark, sf):
    clean = raw(spark, [{"is_fraud": i % 10 == 0, "user_id": f"u{i % 3}"} for i in range(50)])
    tables = run_batch(spark, clean, "ok_")
    assert tables["mart_revenue_daily"].first()["fraud_tx_count"] == 5
    assert tables["mart_fraud_report"].count() == 3

    with pytest.raises(QualityError) as staged:
        run_batch(spark, catalogue.raw(spark, sf), "dirty_")
    assert staged.value.violations[0][:3] == ("stg_transactions", "accepted_values", "device")
    assert not spark.catalog.tableExists("dirty_mart_revenue_daily")

    suspicious = raw(spark, [{"is_fraud": i % 2 == 0} for i in range(50)])
    with pytest.raises(QualityError) as late:
        run_batch(spark, suspicious, "late_")
    assert [v[1] for v in late.value.violations] == ["fraud_rate_band"]
    assert spark.catalog.tableExists("late_mart_revenue_daily")


def test_scoring_is_stored_once(spark, staged):
    tables = run_scoring(spark, staged, "score_", velocity_window="24 hours",
                         velocity_slide="1 hour")
    flagged = tables["scored"].filter("is_flagged").count()
    assert tables["alerts"].count() == flagged > 0


def test_missing_table_reads_as_empty(spark):
    df = read_or_empty(spark, "no_such_table", "a int, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]
