"""Window-exact scores on a stream: the batch rules' result, one row per transaction.

A transaction comes out once, when the last window that holds it has closed: its own slots and their
neighbours are complete then, so the highest count, the lowest median and the country change ahead are
what the batch rules find.  Nothing is repeated per window.  The state of a user is one map entry per
velocity slot with the transactions of that slot, so never more entries than transactions, and one
timer per amount slot.  When an amount slot's timer fires, its transactions are scored and what no later
slot needs is removed.  Rows without a user share no state and are scored alone as they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwatch.functions.timegrid import micros, window_grid
from tillwatch.operators.rules import amount_points, combine_scores, velocity_points

COLUMNS = ["tx_id", "merchant", "amount", "country_code", "at"]
SLOT = "tx_id array<string>, merchant array<string>, amount array<double>, country_code array<string>, at array<bigint>"
SCORED = (
    "tx_id string, user_id string, merchant string, amount double, country_code string, "
    "tx_at timestamp, tx_count_60s bigint, _median double, geo_anomaly_flag boolean"
)


def window_counts(at: np.ndarray, own: np.ndarray, length: int, step: int) -> np.ndarray:
    """Per time in ``own``, the highest count of ``at`` among the windows that hold it."""
    slots, n = np.unique(at // step, return_counts=True)
    upto = np.concatenate([[0], np.cumsum(n)])
    best = np.zeros(len(own), "int64")
    for back in range(length // step):
        start = own // step - back
        inside = upto[np.searchsorted(slots, start + length // step)] - upto[np.searchsorted(slots, start)]
        best = np.maximum(best, inside)
    return best


def lowest_median(at: np.ndarray, amount: np.ndarray, slot: int, length: int, step: int) -> float | None:
    """Lowest positive median of the windows that hold a slot, infinity if none is positive, None without amounts."""
    found: float | None = None
    for back in range(length // step):
        start = slot - back * step
        values = amount[(at >= start) & (at < start + length)]
        values = values[~np.isnan(values)]
        if len(values):
            half = (len(values) - 1) // 2
            median = float(np.partition(values, half)[half])
            median = median if median > 0 else float("inf")
            found = median if found is None else min(found, median)
    return found


def country_changes(at: np.ndarray, country: np.ndarray, span: int) -> np.ndarray:
    """Whether another country follows at the same time or within ``span``; a missing one never matches."""
    flags = np.zeros(len(at), bool)
    known = np.flatnonzero(np.array([c is not None for c in country], bool))
    if not len(known):
        return flags
    codes = np.unique(country[known].astype(str), return_inverse=True)[1]
    order = np.lexsort((codes, at[known]))
    t, c = at[known][order], codes[order]
    # a run of one country is followed by the first row of the next run
    changes = np.flatnonzero(c[1:] != c[:-1]) + 1
    follows = np.append(changes, len(c))[np.searchsorted(changes, np.arange(len(c)), "right")]
    soon = (follows < len(c)) & (t[np.minimum(follows, len(c) - 1)] - t <= span)
    # rows of one moment see each other
    moment = np.unique(t, return_inverse=True)[1]
    lowest = np.full(moment.max() + 1, len(codes))
    highest = np.full(moment.max() + 1, -1)
    np.minimum.at(lowest, moment, c)
    np.maximum.at(highest, moment, c)
    flags[known[order]] = soon | (lowest != highest)[moment]
    return flags


class ExactScorer(StatefulProcessor):
    def __init__(self, velocity: tuple[int, int], amount: tuple[int, int], within: int) -> None:
        self.velocity, self.amount, self.within = velocity, amount, within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot bigint", SLOT)

    def _final(self, slot: int) -> int:
        """When nothing that arrives can change the scores of an amount slot."""
        (v_length, _), (a_length, a_step) = self.velocity, self.amount
        return slot + max(a_length, a_step + v_length, a_step + self.within)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            at = batch["tx_at"].to_numpy("datetime64[us]").astype("int64")
            if key[0] is None:
                amounts = [None if pd.isna(a) else float(a) for a in batch["amount"]]
                yield self._scored(key, batch.assign(at=at)[COLUMNS], np.ones(len(batch), "int64"),
                                   [a if a is None or a > 0 else float("inf") for a in amounts], np.zeros(len(batch), bool))
                continue
            batch = batch.assign(at=at, amount=[None if pd.isna(a) else float(a) for a in batch["amount"]])
            for slot, part in batch.groupby(at // self.velocity[1]):
                held = self.slots.getValue((int(slot),)) if self.slots.containsKey((int(slot),)) else ([],) * len(COLUMNS)
                more = [[None if pd.isna(v) else v for v in part[c].tolist()] for c in COLUMNS]
                self.slots.updateValue((int(slot),), tuple(list(h) + m for h, m in zip(held, more)))
            step = self.amount[1]
            for slot in np.unique(at // step * step).tolist():
                self.handle.registerTimer(-(-self._final(slot) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, (length, step) = expiredTimerInfo.getExpiryTimeInMs() * 1000, self.amount
        rows = {k[0]: v for k, v in self.slots.iterator()}
        if not rows:
            return
        every = {c: [x for k in sorted(rows) for x in rows[k][n]] for n, c in enumerate(COLUMNS)}
        at = np.array(every["at"], "int64")
        amount = np.array([np.nan if a is None else a for a in every["amount"]], "float64")
        slot = at // step * step
        # exactly the slots of this timer: later ones have timers of their own, earlier ones have come out
        for due in [s for s in np.unique(slot).tolist() if -(-self._final(s) // 1000) * 1000 == now]:
            own = np.flatnonzero(slot == due)
            changes = country_changes(at, np.array(every["country_code"], object), self.within)
            found = pd.DataFrame({c: [v[i] for i in own.tolist()] for c, v in every.items()})
            yield self._scored(key, found, window_counts(at, at[own], *self.velocity),
                               [lowest_median(at, amount, due, length, step)] * len(own), changes[own])
            # what the next slot does not look back on; a transaction yet to come looks back on none of them
            later = slot[slot > due]
            oldest = later.min() - max(length - step, self.velocity[0]) if len(later) else None
            for k in [k for k in rows if oldest is None or (k + 1) * self.velocity[1] <= oldest]:
                self.slots.removeKey((k,))
                del rows[k]

    def _scored(self, key, rows: pd.DataFrame, counts, medians, changes) -> pd.DataFrame:
        return pd.DataFrame({
            "tx_id": rows["tx_id"], "user_id": pd.Series([key[0]] * len(rows), dtype=object, index=rows.index), "merchant": rows["merchant"],
            "amount": rows["amount"].astype("float64"), "country_code": rows["country_code"],
            "tx_at": pd.to_datetime(rows["at"], unit="us"), "tx_count_60s": counts,
            "_median": pd.Series(medians, dtype="float64", index=rows.index), "geo_anomaly_flag": changes,
        })

    def close(self) -> None:
        pass


def exact_scores(stream: DataFrame, velocity_window: str = "60 seconds", velocity_slide: str = "10 seconds",
                 amount_window: str = "24 hours", amount_slide: str = "1 hour", geo_within: str = "30 minutes",
                 round_before_compare: bool = False) -> DataFrame:
    """Watermarked transactions -> the same with the columns of the batch rules and the combined score.

    Needs the RocksDB state store (:data:`tillwatch.streaming.live.STATE_SETTINGS`).  The watermark's delay
    is how late a transaction may be; later ones are dropped, as by any window of the stream.
    """
    rows = stream.select(
        "tx_id", "user_id", "merchant", F.col("amount").cast("double").alias("amount"),
        F.upper(F.trim("country")).alias("country_code"), "tx_at",
    ).withColumn("alone", F.when(F.col("user_id").isNull(), F.col("tx_id")))
    scorer = ExactScorer(window_grid(velocity_window, velocity_slide), window_grid(amount_window, amount_slide), micros(geo_within))
    ruled = rows.groupBy("user_id", "alone").transformWithStateInPandas(
        statefulProcessor=scorer, outputStructType=SCORED, outputMode="append", timeMode="EventTime")
    ruled = ruled.withColumn("_median", F.when(~F.isnan("_median"), F.col("_median"))).withColumn(
        "amount", F.when(~F.isnan("amount"), F.col("amount")))
    return combine_scores(amount_points(velocity_points(ruled), round_before_compare))
