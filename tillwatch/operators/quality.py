"""Declared data-quality checks: every result is (relation, rule, column, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwatch.functions.exact import count_where
from tillwatch.functions.fixed import CURRENCIES, DEVICES

# The declared column checks.
NOT_NULL = {
    "raw_transactions": ["tx_id", "user_id", "amount", "tx_at"],
    "stg_transactions": ["tx_id", "user_id", "amount", "device"],
    "mart_revenue_daily": ["date", "merchant", "category", "country_code", "tx_count",
                           "unique_users", "total_revenue_vnd", "fraud_tx_count"],
    "mart_fraud_report": ["user_id", "total_fraud_tx"],
}
UNIQUE = {
    "raw_transactions": ["tx_id"],
    "stg_transactions": ["tx_id"],
    "mart_fraud_report": ["user_id"],
}
ACCEPTED = {
    "raw_transactions": {"currency": CURRENCIES, "device": DEVICES},
    "stg_transactions": {"device": DEVICES},
}
FRAUD_RATE_BAND = (0.1, 20.0)

_RESULT = ["relation", "rule", "column", "violations"]


def _one_pass(df: DataFrame, relation: str, rule: str, conditions: dict) -> DataFrame:
    """Violation counts of several columns from a single scan, one row per column."""
    counts = df.agg(*[count_where(bad).alias(c) for c, bad in conditions.items()])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("violations")) for c in conditions
    ])).alias("_p")
    return counts.select(
        F.lit(relation).alias("relation"), F.lit(rule).alias("rule"), pairs
    ).select("relation", "rule", "_p.column", "_p.violations")


def not_null(df: DataFrame, relation: str, columns: list[str]) -> DataFrame:
    return _one_pass(df, relation, "not_null", {c: F.col(c).isNull() for c in columns})


def accepted_values(df: DataFrame, relation: str, allowed: dict[str, list[str]]) -> DataFrame:
    """Values outside the list; nulls pass."""
    return _one_pass(df, relation, "accepted_values", {
        c: F.col(c).isNotNull() & ~F.col(c).isin(*values) for c, values in allowed.items()
    })


def unique(df: DataFrame, relation: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(relation).alias("relation"), F.lit("unique").alias("rule"),
        F.lit(column).alias("column"), "violations",
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_not_null(relations: dict[str, DataFrame]) -> DataFrame:
    return _union([not_null(df, r, NOT_NULL[r]) for r, df in relations.items() if r in NOT_NULL])


def check_unique(relations: dict[str, DataFrame]) -> DataFrame:
    return _union([unique(df, r, c) for r, df in relations.items() for c in UNIQUE.get(r, [])])


def check_accepted_values(relations: dict[str, DataFrame]) -> DataFrame:
    return _union([
        accepted_values(df, r, ACCEPTED[r]) for r, df in relations.items() if r in ACCEPTED
    ])


def check_columns(relations: dict[str, DataFrame]) -> DataFrame:
    """Every declared check on the given relations, in one DataFrame."""
    parts = [check_not_null(relations)]
    if any(r in UNIQUE for r in relations):
        parts.append(check_unique(relations))
    if any(r in ACCEPTED for r in relations):
        parts.append(check_accepted_values(relations))
    return _union(parts).select(*_RESULT)


def profile(df: DataFrame, relation: str, conditions: dict[str, Column] | None = None) -> DataFrame:
    """Every declared check of a relation from one scan of it; ``conditions`` adds counts of rows by name
    (rule ``condition``).

    With a unique check, rows first become counters per key, summed in each task before they move, and the
    keys' totals are then added up: the null, domain and row counts ride on the key count.
    """
    bad = {("not_null", c): F.col(c).isNull() for c in NOT_NULL.get(relation, [])}
    bad |= {("accepted_values", c): F.col(c).isNotNull() & ~F.col(c).isin(*values)
            for c, values in ACCEPTED.get(relation, {}).items()}
    bad |= {("condition", c): when for c, when in (conditions or {}).items()}
    counts = {k: count_where(when).alias(f"_{n}") for n, (k, when) in enumerate(bad.items())}
    keys = UNIQUE.get(relation, [])
    if len(keys) > 1:
        raise ValueError("one key per relation")
    if keys:
        per_key = df.groupBy(keys[0]).agg(*counts.values(), F.count(F.lit(1)).alias("_rows"))
        sums = [F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"_{n}") for n in range(len(bad))]
        repeated = count_where(F.col(keys[0]).isNotNull() & (F.col("_rows") > 1))
        found = per_key.agg(*sums, repeated.alias(f"_{len(bad)}"))
    else:
        found = df.agg(*counts.values())
    return _listed(found, relation, [*bad, *(("unique", k) for k in keys)])


def _listed(counts: DataFrame, relation: str, names: list[tuple[str, str]]) -> DataFrame:
    """Columns _0, _1, ... of one row as check rows."""
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(f"_{n}").cast("bigint").alias("violations"))
        for n, (rule, c) in enumerate(names)
    ])
    return counts.select(F.lit(relation).alias("relation"), F.inline(rows)).select(*_RESULT)


def profile_all(relations: dict[str, DataFrame]) -> DataFrame:
    """Every declared check on the given relations, one scan for each."""
    return _union([profile(df, r) for r, df in relations.items()])


class Observed:
    """The checks of a model taken while it is written: no scan of its own.

    Unique checks are not among them, since an observation holds no distinct counts; a model grouped by
    its key has none to fail.
    """

    def __init__(self, relation: str) -> None:
        self.relation = relation
        self.names = [("not_null", c) for c in NOT_NULL.get(relation, [])]
        self.names += [("accepted_values", c) for c in ACCEPTED.get(relation, {})]
        self._seen = Observation(relation)

    def on(self, df: DataFrame, *more: Column) -> DataFrame:
        bad = {"not_null": lambda c: F.col(c).isNull(),
               "accepted_values": lambda c: F.col(c).isNotNull() & ~F.col(c).isin(*ACCEPTED[self.relation][c])}
        return df.observe(self._seen, *[count_where(bad[rule](c)).alias(f"_{n}") for n, (rule, c) in enumerate(self.names)], *more)

    @property
    def seen(self) -> dict:
        return self._seen.get

    def violations(self) -> list[tuple]:
        """(relation, rule, column, violations) of the failed checks, after the write."""
        return [(self.relation, rule, c, self.seen[f"_{n}"]) for n, (rule, c) in enumerate(self.names) if self.seen[f"_{n}"]]


def negative_amounts(transactions: DataFrame) -> DataFrame:
    """Offending rows; none means the check passes."""
    return transactions.filter(F.col("amount") < 0).select("tx_id", "amount")


def fraud_rate_outside(overall: DataFrame, low: float = FRAUD_RATE_BAND[0],
                       high: float = FRAUD_RATE_BAND[1]) -> DataFrame:
    """The overall fraud rate when it is outside the band.  A null rate (empty mart) passes."""
    rate = F.col("overall_fraud_rate_pct")
    return overall.filter((rate < low) | (rate > high)).select(rate)
