"""Every named query against its SQL on the same tables."""

import oracle_compare as oc
import pytest

from oracle_queries import ORACLES
from tillwatch.plans import catalogue

QUERIES = catalogue.queries()


@pytest.fixture(scope="module")
def con(sf):
    return oc.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert oc.type_differences(df, con, ORACLES[name]) == []
    cols, got = oc.spark_rows(df)
    want_cols, want = oc.duck_rows(con, ORACLES[name])
    assert cols == want_cols
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_alert_payload_matches_alert_rows(spark, sf):
    from tillwatch.operators.alerts import read_alert_payload

    alerts = catalogue.alerts(spark, sf).drop("batch_id")
    back = read_alert_payload(QUERIES["alert_payload_json"](spark, sf))
    assert oc.spark_rows(back) == oc.spark_rows(alerts)
