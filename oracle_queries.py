"""DuckDB SQL for every named query, written on its own terms: self-joins and unnested windows
instead of frames, integer half-up arithmetic instead of decimals."""

from __future__ import annotations

RAW = """raw as (
select
  event_id as _n,
  case when event_id % 499 = 7 then null
       else concat('tx-', cast(event_id as varchar)) end              as tx_id,
  concat(' user_', lpad(cast(user_id as varchar), 4, '0'), ' ')       as user_id,
  case event_id % 11 when 0 then 'Grab' when 1 then ' Shopee' when 2 then 'VinMart' when 3 then 'MoMo '
    when 4 then 'Tiki' when 5 then 'Highlands' when 6 then 'Circle K' when 7 then 'ZaloPay'
    when 8 then 'VNPay' when 9 then 'Lazada' else 'Corner Shop' end   as merchant,
  cast(case when event_id % 97 = 5 then -value when event_id % 103 = 9 then null
            else value end as decimal(15,2))                          as amount,
  ' vnd'                                                              as currency,
  case when (event_id*37)%100 < 85 then 'vn' when (event_id*37)%100 < 90 then 'US'
       when (event_id*37)%100 < 94 then 'SG ' when (event_id*37)%100 < 97 then 'JP'
       when (event_id*37)%100 < 99 then 'KR' else 'GB' end            as country,
  case when event_id % 503 = 11 then null else ts end                 as tx_at,
  case event_type when 'click' then 'Mobile' when 'view' then ' web'
       when 'purchase' then 'kiosk' else 'pos' end                    as device,
  case when event_type = 'error' and event_id % 4 = 0 then true
       when event_type = 'signup' then null else false end            as is_fraud,
  case when event_type = 'error' and event_id % 4 = 0 then 'amount_spike' end as fraud_reason,
  ts + interval '7' minute                                            as ingested_at,
  ts as _ts
from events)"""

STG = RAW + """, stg as (
select tx_id, trim(user_id) as user_id, trim(merchant) as merchant, amount,
  upper(trim(currency)) as currency, upper(trim(country)) as country_code,
  date_trunc('millisecond', tx_at) as tx_at, lower(trim(device)) as device,
  coalesce(is_fraud, false) as is_fraud, fraud_reason, ingested_at, cast(tx_at as date) as tx_date
from raw where tx_id is not null and tx_at is not null and amount > 0)"""


def half_up(num: str, den: str, places: int) -> str:
    """Integer half-up of num/den as a double."""
    unit = 10**places
    return f"(cast(({num}) * {2 * unit} + ({den}) as bigint) // cast(2 * ({den}) as bigint)) / {unit}.0"


_FRAUD = "count(*) filter (where is_fraud)"

INT_MR = STG + f""", mr as (
select tx_date, merchant, country_code, count(*) as tx_count,
  count(distinct user_id) as unique_users, sum(amount) as revenue,
  {_FRAUD} as fraud_tx_count, sum(amount) filter (where is_fraud) as fraud_amount,
  {half_up('100 * ' + _FRAUD, 'count(*)', 4)} as fraud_rate_pct,
  cast(({_FRAUD}) * 100 * 20000 + count(*) as bigint) // cast(2 * count(*) as bigint) as rate4
from stg group by tx_date, merchant, country_code)"""

INT_UD = STG + f""", ud as (
select tx_date, user_id, count(*) as total_tx, {_FRAUD} as fraud_tx, sum(amount) as total_amount,
  sum(amount) filter (where is_fraud) as fraud_amount,
  cast(sum(amount) as double) / count(*) as avg_amount, max(tx_at) as last_tx_at,
  {half_up('100 * ' + _FRAUD, 'count(*)', 2)} as daily_fraud_rate_pct
from stg group by tx_date, user_id)"""

_CATEGORY = """case merchant when 'Grab' then 'transport' when 'Shopee' then 'ecommerce'
  when 'VinMart' then 'grocery' when 'MoMo' then 'fintech' when 'Tiki' then 'ecommerce'
  when 'Highlands' then 'food' when 'Circle K' then 'grocery' when 'ZaloPay' then 'fintech'
  when 'VNPay' then 'fintech' when 'Lazada' then 'ecommerce' else 'other' end"""

MART = INT_MR + f""", cat as (
select tx_date, merchant, {_CATEGORY} as category from stg group by tx_date, merchant),
mart as (
select mr.tx_date as date, mr.merchant, cat.category, mr.country_code, tx_count, unique_users,
  cast(revenue as double) as total_revenue_vnd,
  {half_up('cast(revenue * 100 as bigint)', '100 * tx_count', 2)} as avg_tx_value_vnd,
  fraud_tx_count, fraud_rate_pct, cast(coalesce(fraud_amount, 0) as double) as fraud_amount_vnd,
  revenue, rate4
from mr left join cat on mr.tx_date = cat.tx_date and mr.merchant = cat.merchant)"""

_MART_COLUMNS = """date, merchant, category, country_code, tx_count, unique_users,
  total_revenue_vnd, avg_tx_value_vnd, fraud_tx_count, fraud_rate_pct, fraud_amount_vnd"""

REPORT = INT_UD + f""", report as (
select user_id, cast(sum(fraud_tx) as bigint) as total_fraud_tx,
  cast(sum(fraud_amount) as double) as total_fraud_amount, max(last_tx_at) as last_fraud_at,
  {half_up('100 * sum(fraud_tx)', 'sum(total_tx)', 2)} as user_fraud_rate_pct
from ud where fraud_tx > 0 group by user_id)"""

_LAT = """case country_code when 'VN' then 14.0583 when 'US' then 37.0902 when 'SG' then 1.3521
  when 'JP' then 36.2048 when 'KR' then 35.9078 when 'CN' then 35.8617 when 'TH' then 15.87
  when 'MY' then 4.2105 when 'AU' then -25.2744 when 'GB' then 55.3781 else 0 end"""
_LON = """case country_code when 'VN' then 108.2772 when 'US' then -95.7129 when 'SG' then 103.8198
  when 'JP' then 138.2529 when 'KR' then 127.7669 when 'CN' then 104.1954 when 'TH' then 100.9925
  when 'MY' then 101.9758 when 'AU' then 133.7751 when 'GB' then -3.436 else 0 end"""
_ALPHA3 = """case country_code when 'VN' then 'VNM' when 'US' then 'USA' when 'SG' then 'SGP'
  when 'JP' then 'JPN' when 'KR' then 'KOR' when 'CN' then 'CHN' when 'TH' then 'THA'
  when 'MY' then 'MYS' when 'AU' then 'AUS' when 'GB' then 'GBR' end"""

_TOTALS = """cast(sum(tx_count) as bigint) as total_tx, cast(sum(revenue) as double) as total_revenue_vnd,
  cast(sum(rate4) as double) / 10000.0 / count(*) as avg_fraud_rate_pct"""


def _windows(alias: str, slot: str, back: str, step: str) -> str:
    """Every (row, window start) pair."""
    return f"""{alias} as (
select stg.*, unnest(generate_series({slot} - interval '{back}', {slot}, interval '{step}')) as ws
from stg)"""


_HOUR = "date_trunc('hour', tx_at)"
_TEN = "time_bucket(interval '10 seconds', tx_at)"

DAY_ROWS = STG + ", " + _windows("w24", _HOUR, "23 hours", "1 hour")
MINUTE_ROWS = STG + ", " + _windows("w60", _TEN, "50 seconds", "10 seconds")


def _velocity(rows: str) -> str:
    return f"""vel as (
select tx_id, max(n) as tx_count_60s from (
  select tx_id, count(*) over (partition by user_id, ws) as n from {rows}) group by tx_id)"""


_MEDIAN = """med as (
select tx_id, min(m) as user_median_amount from w24 join (
  select user_id, ws, quantile_disc(amount, 0.5) as m from w24 group by user_id, ws)
  using (user_id, ws) group by tx_id)"""

_GEO = """geo as (
select a.tx_id from stg a where exists (
  select 1 from stg b where b.user_id = a.user_id and b.tx_id <> a.tx_id
    and b.country_code <> a.country_code and b.tx_at >= a.tx_at
    and b.tx_at <= a.tx_at + interval '30 minutes'))"""

_VELOCITY_SCORE = "case when tx_count_60s > 10 then 2 when tx_count_60s > 5 then 1 else 0 end"

SCORED = DAY_ROWS + ", " + _velocity("w24") + ", " + _MEDIAN + ", " + _GEO + f""", flags as (
select stg.*, tx_count_60s, {_VELOCITY_SCORE} as velocity_score,
  cast(user_median_amount as double) as user_median_amount,
  cast(amount as double) / cast(user_median_amount as double) > 3.0 as amount_spike_flag,
  stg.tx_id in (select tx_id from geo) as geo_anomaly_flag
from stg join vel using (tx_id) join med using (tx_id)),
scored as (
select *,
  (case when velocity_score > 0 then 1 else 0 end) + (case when amount_spike_flag then 1 else 0 end)
  + (case when geo_anomaly_flag then 1 else 0 end) as fraud_score,
  concat_ws(',', case when velocity_score > 0 then 'velocity' end,
    case when amount_spike_flag then 'amount_spike' end,
    case when geo_anomaly_flag then 'geo_anomaly' end) as triggered_rules,
  velocity_score > 0 or amount_spike_flag or geo_anomaly_flag as is_flagged
from flags)"""

_SCORE_COLUMNS = """tx_id, user_id, tx_at, tx_count_60s, velocity_score, user_median_amount,
  amount_spike_flag, geo_anomaly_flag, fraud_score, triggered_rules, is_flagged"""

ALERTS = SCORED + """, alerts as (
select cast(tx_date - date '1970-01-01' as bigint) as batch_id, tx_id, user_id, merchant,
  cast(amount as double) as amount, country_code as country, cast(tx_at as varchar) as tx_at,
  fraud_score, triggered_rules, velocity_score, amount_spike_flag as amount_spike,
  geo_anomaly_flag as geo_anomaly
from scored where is_flagged)"""

BREAKER = SCORED + """, breaker as (
select *, fraud_rate > 0.20 as tripped,
  case when fraud_rate > 0.20 then closed_at + interval '300 seconds' end as flag_until
from (
  select cast(tx_date - date '1970-01-01' as bigint) as batch_id, count(*) as scored_tx,
    count(*) filter (where is_flagged) as flagged_tx,
    cast(count(*) filter (where is_flagged) as double) / count(*) as fraud_rate,
    max(tx_at) as closed_at
  from scored group by tx_date))"""


def _heatmap(source: str) -> str:
    return f""", grid as (
select d as day_no, h as hour from range(7) t(d), range(24) u(h)),
cells as (
select isodow(cast(tx_at as timestamp)) - 1 as day_no, hour(cast(tx_at as timestamp)) as hour,
  count(*) as n from {source} group by all),
heat as (
select cast(day_no as int) as day_no, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][day_no + 1] as day,
  cast(hour as int) as hour, coalesce(n, 0) as count
from grid left join cells using (day_no, hour))"""


FRESH = """fresh as (
select *, case when last_updated is null then 'stale' when h / sla_hours <= 0.75 then 'fresh'
  when h / sla_hours <= 1.0 then 'warning' else 'stale' end as status
from (select *, (epoch_us(checked_at) - epoch_us(last_updated)) / 3600000000.0::double as h from (
  select event_type as source_name, cast(cast(ts as date) + 1 as timestamp) as checked_at,
    max(ts) as last_updated,
    cast(case event_type when 'click' then 0.5 when 'view' then 0.4 when 'purchase' then 1.0
      when 'signup' then 0.25 when 'error' then 0.6 else 1.0 end as double) as sla_hours
  from events group by event_type, cast(ts as date)) a) b)"""
_FRESH_COLUMNS = "source_name, checked_at, last_updated, h as hours_since_update, sla_hours, status"
_LATEST = "qualify row_number() over (partition by source_name order by checked_at desc) = 1"

SNAP = """snap as (
select event_type as source_name, cast(cast(ts as date) as timestamp) as snapshot_at,
  cast(regexp_extract(props, '[0-9]+') as int) as ordinal,
  concat('k', regexp_extract(props, '[0-9]+')) as column_name,
  case when max(value) >= 100 then 'double' else 'int' end as data_type
from events group by all)"""

DIFFS = SNAP + """, taken as (select distinct source_name, snapshot_at from snap),
steps as (select source_name, snapshot_at as checked_at,
  lag(snapshot_at) over (partition by source_name order by snapshot_at) as before from taken),
added as (select s.source_name, s.checked_at, c.column_name from steps s
  join snap c on c.source_name = s.source_name and c.snapshot_at = s.checked_at
  where s.before is not null and not exists (select 1 from snap p where p.source_name = s.source_name
    and p.snapshot_at = s.before and p.column_name = c.column_name)),
removed as (select s.source_name, s.checked_at, p.column_name from steps s
  join snap p on p.source_name = s.source_name and p.snapshot_at = s.before
  where not exists (select 1 from snap c where c.source_name = s.source_name
    and c.snapshot_at = s.checked_at and p.column_name = c.column_name)),
retyped as (select s.source_name, s.checked_at, c.column_name,
  concat_ws(':', c.column_name, p.data_type, c.data_type) as change from steps s
  join snap p on p.source_name = s.source_name and p.snapshot_at = s.before
  join snap c on c.source_name = s.source_name and c.snapshot_at = s.checked_at
    and p.column_name = c.column_name where p.data_type <> c.data_type),
diffs as (
select source_name, checked_at, a is not null or r is not null or t is not null as has_changes,
  r is not null or t is not null as is_breaking,
  coalesce(a, '') as added, coalesce(r, '') as removed, coalesce(t, '') as type_changed
from (select * from steps
  left join (select source_name, checked_at, string_agg(column_name, ',' order by column_name) as a
    from added group by all) using (source_name, checked_at)
  left join (select source_name, checked_at, string_agg(column_name, ',' order by column_name) as r
    from removed group by all) using (source_name, checked_at)
  left join (select source_name, checked_at, string_agg(change, ',' order by column_name) as t
    from retyped group by all) using (source_name, checked_at)))"""

_STORED_DIFFS = DIFFS.replace(
    DIFFS[DIFFS.index("steps as ("):DIFFS.index("added as (")],
    """steps as (select source_name, max(snapshot_at) as checked_at,
  max(snapshot_at) filter (where snapshot_at < newest) as before
  from (select *, max(snapshot_at) over (partition by source_name) as newest from taken) group by source_name),
""")
_DIFF_COLUMNS = "source_name, checked_at, has_changes, is_breaking, added, removed, type_changed"


def _check(relation: str, rule: str, column: str, condition: str, source: str) -> str:
    return (f"select '{relation}' as relation, '{rule}' as rule, '{column}' as \"column\", "
            f"count(*) as violations from {source} where {condition}")


def _metadata() -> str:
    """Rows, nulls and types of all columns, counted from the data; lists have no null count."""
    tables = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
              "conversations").split()
    counted = " union all ".join(
        f"select '{t}' as source_name, column_name, (select count(*) from {t}) as row_count, non_null from "
        f"(unpivot (select count(columns(*)) from {t}) on columns(*) into name column_name value non_null)"
        for t in tables)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
             "FLOAT[]": "array<float>"}
    kind = " ".join(f"when '{a}' then '{b}'" for a, b in kinds.items())
    return f"""with counted as ({counted})
        select source_name, column_index as ordinal, column_name, case data_type {kind} end as data_type, is_nullable, row_count,
          case when data_type like '%[]' then null else row_count - non_null end as nulls
        from counted c join (select table_name, column_name as name, data_type, column_index, is_nullable from duckdb_columns()
          where table_name in ({", ".join(f"'{t}'" for t in tables)})) d on d.table_name = source_name and d.name = c.column_name"""


def _not_null() -> str:
    declared = {
        ("raw_transactions", "raw"): ["tx_id", "user_id", "amount", "tx_at"],
        ("stg_transactions", "stg"): ["tx_id", "user_id", "amount", "device"],
        ("mart_revenue_daily", "mart"): ["date", "merchant", "category", "country_code", "tx_count",
                                         "unique_users", "total_revenue_vnd", "fraud_tx_count"],
        ("mart_fraud_report", "report"): ["user_id", "total_fraud_tx"],
    }
    return " union all ".join(
        _check(rel, "not_null", c, f"{c} is null", src)
        for (rel, src), columns in declared.items() for c in columns
    )


def _accepted() -> str:
    return " union all ".join([
        _check("raw_transactions", "accepted_values", "currency", "currency not in ('VND')", "raw"),
        _check("raw_transactions", "accepted_values", "device", _DEVICE, "raw"),
        _check("stg_transactions", "accepted_values", "device", _DEVICE, "stg"),
    ])


def _unique() -> str:
    declared = [("raw_transactions", "raw", "tx_id"), ("stg_transactions", "stg", "tx_id"),
                ("mart_fraud_report", "report", "user_id")]
    return " union all ".join(
        _check(rel, "unique", c, "n > 1",
               f"(select {c}, count(*) as n from {src} where {c} is not null group by {c})")
        for rel, src, c in declared
    )


_BOTH_MARTS = MART + REPORT[len(STG):]
_DEVICE = "device not in ('mobile', 'web', 'pos')"
_TOP = "select user_id, cast(sum(fraud_score) as bigint) as total_score from alerts group by user_id"
_TOP_ORDER = "order by total_score desc, user_id desc limit 10"
_RAW_COLUMNS = """tx_id, user_id, merchant, cast(amount as double) as amount, currency, country,
  tx_at, device, is_fraud, fraud_reason, ingested_at"""
_OVERALL = f"""overall as (
select cast(sum(tx_count) as bigint) as total_tx, cast(sum(fraud_tx_count) as bigint) as total_fraud_tx,
  {half_up('100 * sum(fraud_tx_count)', 'sum(tx_count)', 4)} as overall_fraud_rate_pct from mart)"""

ORACLES = {
    "parse_json_events": f"""with {RAW} select tx_id, user_id, merchant,
        cast(amount as double) as amount, currency, country, tx_at, device, is_fraud, fraud_reason
        from raw where tx_id is not null and tx_at is not null
        and _n % 211 <> 3 and _n % 223 <> 4""",
    "dead_letter_counts": f"""with {RAW} select case when _n % 211 = 3 then 'bad_json'
        when tx_id is null or (tx_at is null and _n % 223 <> 4) then 'missing_key'
        when _n % 223 = 4 then 'bad_time' else 'accepted' end as outcome, count(*) as messages
        from raw group by 1""",
    "ingest_above_watermark": f"""with {RAW} select {_RAW_COLUMNS} from raw
        where tx_at > (select max(tx_at) from raw where 2 * _n < (select max(_n) from raw))""",
    "insert_if_absent": f"""with {RAW}, arrived as (
        select * replace (case when _n % 7 = 3 then tx_at - interval 1 hour else tx_at end as tx_at) from raw)
        select {_RAW_COLUMNS} from arrived where tx_id is not null and tx_id not in (
        select tx_id from raw where tx_id is not null and 2 * _n < (select max(_n) from raw))""",
    "stg_transactions": f"with {STG} select * replace (cast(amount as double) as amount) from stg",
    "int_merchant_revenue": f"""with {INT_MR} select tx_date, merchant, country_code, tx_count,
        unique_users, cast(revenue as double) as total_revenue_vnd,
        cast(revenue as double) / tx_count as avg_tx_value_vnd, fraud_tx_count,
        cast(fraud_amount as double) as fraud_amount_vnd, fraud_rate_pct from mr""",
    "int_user_daily_summary": f"""with {INT_UD} select * replace (
        cast(total_amount as double) as total_amount, cast(fraud_amount as double) as fraud_amount)
        from ud""",
    "merchant_category": f"with {MART} select tx_date, merchant, category from cat",
    "mart_revenue_daily": f"with {MART} select {_MART_COLUMNS} from mart",
    "mart_fraud_report": f"with {REPORT} select * from report",
    "revenue_by_merchant": f"with {MART} select merchant, {_TOTALS} from mart group by merchant",
    "revenue_by_country": f"""with {MART} select country_code, {_TOTALS},
        cast({_LAT} as double) as lat, cast({_LON} as double) as lon
        from mart where country_code is not null group by country_code""",
    "country_distribution": f"""with {MART} select country_code, {_ALPHA3} as iso_alpha3,
        cast(sum(tx_count) as double) as total_tx, cast(sum(revenue) as double) as total_revenue_vnd,
        {half_up('sum(rate4)', '10000 * count(*)', 2)} as avg_fraud_rate_pct
        from mart where country_code is not null group by country_code""",
    "revenue_daily_recent": f"""with {MART} select {_MART_COLUMNS} from mart
        order by date desc, merchant nulls first, country_code nulls first limit 30""",
    "revenue_daily_by_merchant": f"""with {MART} select {_MART_COLUMNS} from mart
        where merchant = 'Grab' order by date desc, country_code nulls first limit 30""",
    "fraud_rate_trend": f"""with {MART} select date, sum(tx_count)::bigint as total_tx,
        sum(fraud_tx_count)::bigint as total_fraud_tx,
        {half_up('100 * sum(fraud_tx_count)', 'sum(tx_count)', 4)} as fraud_rate_pct
        from mart group by date""",
    "overall_fraud_rate": f"with {MART}, {_OVERALL} select * from overall",
    "velocity_windows": f"""with {DAY_ROWS} select user_id, ws as window_start,
        ws + interval '24 hours' as window_end, count(*) as tx_count_60s from w24 group by all""",
    "velocity_score": f"""with {DAY_ROWS}, {_velocity('w24')} select tx_id, user_id, tx_at,
        tx_count_60s, {_VELOCITY_SCORE} as velocity_score from stg join vel using (tx_id)""",
    "velocity_score_60s": f"""with {MINUTE_ROWS}, {_velocity('w60')} select tx_id, user_id, tx_at,
        tx_count_60s, {_VELOCITY_SCORE} as velocity_score from stg join vel using (tx_id)""",
    "amount_windows": f"""with {DAY_ROWS} select user_id, ws as window_start,
        ws + interval '24 hours' as window_end,
        cast(quantile_disc(amount, 0.5) as double) as user_median_amount
        from w24 group by user_id, ws""",
    "amount_spike": f"""with {DAY_ROWS}, {_MEDIAN} select tx_id, user_id, tx_at,
        cast(amount as double) as amount, cast(user_median_amount as double) as user_median_amount,
        cast(amount as double) / cast(user_median_amount as double) > 3.0 as amount_spike_flag
        from stg join med using (tx_id)""",
    "geo_pairs": f"""with {STG}, moments as (
        select user_id, tx_at, country_code, min(tx_id) as tx_id from stg
        where user_id is not null and country_code is not null group by all)
        select a.user_id, a.tx_at, a.country_code, a.tx_id, b.tx_at as pair_tx_at,
        b.country_code as pair_country_code, b.tx_id as pair_tx_id
        from moments a join moments b on a.user_id = b.user_id and a.country_code <> b.country_code
        and b.tx_at between a.tx_at and a.tx_at + interval '30 minutes'
        qualify row_number() over (partition by a.user_id, a.tx_at, a.country_code
          order by b.tx_at, b.country_code) = 1""",
    "geo_anomaly": f"""with {STG}, {_GEO} select tx_id, user_id, country_code, tx_at,
        tx_id in (select tx_id from geo) as geo_anomaly_flag from stg""",
    "fraud_score": f"with {SCORED} select {_SCORE_COLUMNS} from scored",
    "flagged_transactions": f"with {SCORED} select {_SCORE_COLUMNS} from scored where is_flagged",
    "alerts": f"with {ALERTS} select * from alerts",
    "alert_payload_json": f"""with {ALERTS} select user_id as key, cast(to_json({{'tx_id': tx_id,
        'user_id': user_id, 'merchant': merchant, 'amount': amount, 'country': country,
        'tx_at': tx_at, 'fraud_score': fraud_score, 'triggered_rules': triggered_rules,
        'velocity_score': velocity_score, 'amount_spike': amount_spike,
        'geo_anomaly': geo_anomaly}}) as varchar) as value from alerts""",
    "alert_state_totals": f"""with {ALERTS} select count(*) as total_fraud_alerts,
        (select count(*) from raw) as raw_transactions from alerts""",
    "alert_state_by_user": f"""with {ALERTS} select user_id, count(*) as alert_count,
        cast(sum(fraud_score) as bigint) as total_score from alerts group by user_id""",
    "top_flagged_users": f"with {ALERTS} {_TOP} {_TOP_ORDER}",
    "recent_alerts": f"""with {ALERTS} select * from alerts
        order by batch_id desc, tx_at desc, tx_id desc limit 50""",
    "fraud_trend_hourly": f"""with {ALERTS} select
        strftime(date_trunc('hour', cast(tx_at as timestamp)), '%Y-%m-%dT%H:00:00') as hour,
        count(*) as count from alerts
        where cast(tx_at as timestamp) >= timestamp '2024-01-30 00:00:00' group by 1""",
    "fraud_heatmap": f"with {ALERTS}{_heatmap('alerts')} select * from heat",
    "alert_rollup": f"""with {ALERTS} select date_trunc('hour', cast(tx_at as timestamp)) as hour, user_id,
        count(*) as alerts, cast(sum(fraud_score) as bigint) as score from alerts group by all""",
    "fraud_heatmap_pivot": f"with {ALERTS}{_heatmap('alerts')} select day_no, day, "
        + ", ".join(f"cast(sum(count) filter (where hour = {h}) as bigint) as h{h:02d}"
                    for h in range(24))
        + " from heat group by day_no, day",
    "circuit_breaker_rate": f"""with {BREAKER} select batch_id, scored_tx, flagged_tx, fraud_rate,
        tripped, flag_until from breaker""",
    "alert_stats": f"""with {ALERTS}{BREAKER[len(SCORED):]}, top as ({_TOP} {_TOP_ORDER}) select
        (select count(*) from alerts) as total_fraud_alerts,
        (select coalesce(bool_or(flag_until > timestamp '2024-01-15 00:00:00'), false) from breaker)
          as circuit_breaker_active,
        (select string_agg(concat_ws(':', user_id, total_score), ','
          order by total_score desc, user_id desc) from top) as top_flagged_users""",
    "alerts_read_back": f"""with {ALERTS} select tx_id, user_id, cast(null as varchar) as merchant,
        amount, cast(null as varchar) as country, cast(null as varchar) as tx_at, fraud_score,
        triggered_rules, cast(0 as int) as velocity_score, false as amount_spike,
        false as geo_anomaly from alerts where not geo_anomaly and fraud_score > 1""",
    "dq_not_null": f"with {_BOTH_MARTS} {_not_null()}",
    "dq_unique": f"with {_BOTH_MARTS} {_unique()}",
    "dq_accepted_values": f"with {STG} {_accepted()}",
    "dq_profile": f"with {_BOTH_MARTS} {_not_null()} union all {_unique()} union all {_accepted()}",
    "dq_no_negative_amount": f"""with {RAW} select tx_id, cast(amount as double) as amount
        from raw where amount < 0""",
    "dq_fraud_rate_band": f"""with {MART}, {_OVERALL} select overall_fraud_rate_pct from overall
        where overall_fraud_rate_pct < 0.1 or overall_fraud_rate_pct > 20.0""",
    "dq_fraud_rate_tight_band": f"""with {MART}, {_OVERALL} select overall_fraud_rate_pct from overall
        where overall_fraud_rate_pct < 0.1 or overall_fraud_rate_pct > 1.0""",
    "schema_snapshot": f"""with {SNAP} select *, true as is_nullable,
        cast(null as varchar) as column_default from snap
        qualify snapshot_at = max(snapshot_at) over (partition by source_name)""",
    "schema_diff": f"with {DIFFS} select {_DIFF_COLUMNS} from diffs",
    "stored_schema_drift": f"""with {_STORED_DIFFS} select * replace (timestamp '2024-01-31 00:00:00'
        as checked_at) from (select {_DIFF_COLUMNS} from diffs)""",
    "latest_schema_drift": f"with {DIFFS} select {_DIFF_COLUMNS} from diffs {_LATEST}",
    "freshness_status": f"""with {STG}, newest as (
        select 'raw_transactions' as source_name, max(ingested_at) as last_updated, 1.0::double as sla_hours
          from raw
        union all select 'stg_transactions', max(tx_at), 0.1::double from stg
        union all select 'orders', max(o_orderdate), 24.0::double from orders),
        hours as (select *, timestamp '2024-01-31 00:00:00' as checked_at,
          (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_updated)) / 3600000000.0::double
          as h from newest)
        select source_name, checked_at, last_updated, h as hours_since_update, sla_hours,
          case when h / sla_hours <= 0.75 then 'fresh' when h / sla_hours <= 1.0 then 'warning'
            else 'stale' end as status from hours""",
    "freshness_history": f"with {FRESH} select {_FRESH_COLUMNS} from fresh",
    "latest_freshness": f"with {FRESH} select {_FRESH_COLUMNS} from fresh {_LATEST}",
    "stale_notices": f"""with {FRESH} select source_name, checked_at, concat(source_name, ': no update for ',
        printf('%.1f', h), ' hours, allowed are ', cast(sla_hours as varchar), '; newest row: ',
        cast(last_updated as varchar)) as notice
        from fresh where status = 'stale'""",
    "data_debt": f"""with {FRESH}, {DIFFS}, points as (
        select case status when 'stale' then 20 else 10 end as p,
          case status when 'stale' then 'stale table (+20)' else 'warning table (+10)' end as d
          from (select * from fresh {_LATEST}) where status <> 'fresh'
        union all select case when is_breaking then 25 else 5 end,
          case when is_breaking then 'breaking schema change (+25)'
            else 'non-breaking schema change (+5)' end
          from (select * from diffs {_LATEST}) where has_changes)
        select *, case when data_debt_score <= 10 then 'A' when data_debt_score <= 30 then 'B'
          when data_debt_score <= 50 then 'C' when data_debt_score <= 70 then 'D' else 'F' end as grade
        from (select cast(least(coalesce(sum(p), 0), 100) as int) as data_debt_score,
          coalesce(string_agg(d, '; ' order by d), '') as details from points)""",
}
# the roll-up gives the feeds that the alerts give
ORACLES |= {f"rollup_{feed}": ORACLES[name] for feed, name in (
    ("top_users", "top_flagged_users"), ("heatmap", "fraud_heatmap"), ("trend_hourly", "fraud_trend_hourly"))}
ORACLES["table_metadata"] = _metadata()
