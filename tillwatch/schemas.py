"""Declared schemas.  Nothing in this package infers one."""

from __future__ import annotations

# JSON payload of one transaction message; tx_at is an ISO-8601 string
TX_PAYLOAD = (
    "tx_id string, user_id string, merchant string, amount double, currency string, "
    "country string, tx_at string, device string, is_fraud boolean, fraud_reason string"
)

RAW_TRANSACTIONS = (
    "tx_id string, user_id string, merchant string, amount decimal(15,2), currency string, "
    "country string, tx_at timestamp_ntz, device string, is_fraud boolean, fraud_reason string, "
    "ingested_at timestamp_ntz"
)

# the eleven fields of a published alert
ALERT_FIELDS = (
    "tx_id string, user_id string, merchant string, amount double, country string, tx_at string, "
    "fraud_score int, triggered_rules string, velocity_score int, amount_spike boolean, "
    "geo_anomaly boolean"
)

ALERTS = "batch_id bigint, " + ALERT_FIELDS

# alerts and score per hour and user
ROLLUP = "hour timestamp_ntz, user_id string, alerts bigint, score bigint"

BREAKER_LOG = (
    "batch_id bigint, scored_tx bigint, flagged_tx bigint, fraud_rate double, tripped boolean, "
    "flag_until timestamp_ntz"
)

SCHEMA_SNAPSHOTS = (
    "source_name string, snapshot_at timestamp_ntz, ordinal int, column_name string, "
    "data_type string, is_nullable boolean, column_default string"
)

SCHEMA_DIFFS = (
    "source_name string, checked_at timestamp_ntz, has_changes boolean, is_breaking boolean, "
    "added array<string>, removed array<string>, "
    "type_changed array<struct<column:string,`from`:string,`to`:string>>"
)

FRESHNESS_HISTORY = (
    "source_name string, checked_at timestamp_ntz, last_updated timestamp_ntz, "
    "hours_since_update double, sla_hours double, status string"
)
