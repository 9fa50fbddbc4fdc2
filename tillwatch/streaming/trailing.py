"""Low-latency scorer: one output row per transaction, in the micro-batch it arrives in.

Looks back only: count of the user's last 60 seconds, median of the current and the 23 previous hour
slots, another country in the last 30 minutes.  So it flags the *later* transaction of a country
pair, where the batch rules, which can see ahead, flag the earlier one.

State per user: millisecond counts of one minute and the last time per country; in a map, by hour slot, a
count for each range of amounts (some thousand ranges at most); in another, by slot and range, the amounts
themselves with their counts.  A batch rewrites the slots it touches, usually one or two of a day's.  A
median is found by the range counts first; only the amounts of its range are then read.  So medians are
exact at any size.  Rows without a user each stand alone and have no state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwatch.operators.rules import SPIKE_RATIO, combine_scores, velocity_points

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
GEO_MS = 30 * MINUTE_MS
SLOTS = 24

INPUT = ["tx_id", "user_id", "merchant", "amount", "country_code", "tx_at"]
OUTPUT = (
    "tx_id string, user_id string, merchant string, amount double, country_code string, "
    "tx_at timestamp, tx_count_60s bigint, user_median_amount double, geo_anomaly_flag boolean"
)
STATE = "ms array<bigint>, ms_n array<bigint>, country array<string>, country_ms array<bigint>"
COUNTS = "range array<bigint>, n array<bigint>"
AMOUNTS_KEY = "slot bigint, range bigint"
AMOUNTS = "amount array<double>, n array<bigint>"


def _merge(slot: np.ndarray, amount: np.ndarray, n: np.ndarray) -> tuple:
    """Sum ``n`` over equal (slot, amount); the result is ordered by both."""
    order = np.lexsort((amount, slot))
    slot, amount, n = slot[order], amount[order], n[order]
    first = np.flatnonzero(np.concatenate(
        [[True], (slot[1:] != slot[:-1]) | (amount[1:] != amount[:-1])])[:len(slot)])
    return slot[first], amount[first], np.add.reduceat(n, first) if len(first) else n


class RunningMedian:
    """Lower median of a growing multiset (counts in a binary indexed tree).

    Starts with ``n`` copies of each of ``start``; ``later`` names the values still to be added.
    """

    def __init__(self, start: np.ndarray, n: np.ndarray, later: np.ndarray) -> None:
        self.values = np.unique(np.concatenate([start, later]))
        size = len(self.values)
        counts = np.bincount(np.searchsorted(self.values, start), weights=n, minlength=size)
        upto = np.concatenate([[0], np.cumsum(counts)]).astype("int64")
        i = np.arange(1, size + 1)
        self.tree = np.concatenate([[0], upto[i] - upto[i - (i & -i)]])
        self.total = int(upto[-1])
        self.top = 1 << max(size.bit_length() - 1, 0)

    def add(self, value: float) -> None:
        i = int(np.searchsorted(self.values, value)) + 1
        self.total += 1
        while i < len(self.tree):
            self.tree[i] += 1
            i += i & -i

    def median(self) -> float | None:
        return self.ranked((self.total + 1) // 2)[0] if self.total else None

    def ranked(self, wanted: int) -> tuple[float, int]:
        """The value of a rank from 1, and the rank among its equals."""
        i, step = 0, self.top
        while step:
            if i + step < len(self.tree) and self.tree[i + step] < wanted:
                i += step
                wanted -= self.tree[i]
            step >>= 1
        return float(self.values[i]), int(wanted)


def counts_to(at: np.ndarray, ms: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per time, the count over the 60 seconds up to and including it."""
    order = np.argsort(ms, kind="stable")
    ms, before = ms[order], np.concatenate([[0], np.cumsum(n[order])])
    return (before[np.searchsorted(ms, at, "right")]
            - before[np.searchsorted(ms, at - MINUTE_MS, "right")])


def amount_range(amount: np.ndarray) -> np.ndarray:
    """A range that holds the amount: sign, power of two and 128 steps in it.  Larger amounts never have a
    smaller range."""
    size = np.abs(amount).view("int64") >> 45
    return np.where(amount < 0, -size - 1, size)


def running_medians(slot: np.ndarray, value: np.ndarray, counts: tuple,
                    amounts: Callable[[int, int], tuple]) -> list[float | None]:
    """Per new value (in time order), the median of the SLOTS hour slots that end with its own, over
    what is stored and the new values so far.

    ``counts`` are the stored (slot, range, n); ``amounts`` gives those of one slot and range.
    """
    medians: list[float | None] = []
    known = ~np.isnan(value)
    ranges = np.where(known, amount_range(value), 0)
    for start in np.unique(slot):
        # everything of the earlier slots, and what was stored of this one
        stored = (counts[0] > start - SLOTS * HOUR_MS) & (counts[0] <= start)
        earlier = known & (slot > start - SLOTS * HOUR_MS) & (slot < start)
        own = np.flatnonzero(slot == start)
        mine = own[known[own]]
        begin = np.concatenate([counts[1][stored], ranges[earlier]])
        n = np.concatenate([counts[2][stored], np.ones(int(earlier.sum()), "int64")])
        ranks = RunningMedian(begin, n, ranges[mine])
        inside: dict[int, RunningMedian] = {}
        added: dict[int, list[float]] = {}
        for i in own.tolist():
            if known[i]:
                at = int(ranges[i])
                ranks.add(at)
                added.setdefault(at, []).append(value[i])
                if at in inside:
                    inside[at].add(value[i])
            if not ranks.total:
                medians.append(None)
                continue
            at, rank = ranks.ranked((ranks.total + 1) // 2)
            at = int(at)
            if at not in inside:
                old = [amounts(int(s), at) for s in counts[0][stored & (counts[1] == at)]]
                new = value[earlier & (ranges == at)]
                first = np.concatenate([*(np.asarray(a, "float64") for a, _ in old), new, np.zeros(0)])
                times = np.concatenate([*(np.asarray(k, "int64") for _, k in old), np.ones(len(new), "int64")])
                inside[at] = RunningMedian(first, times, value[mine[ranges[mine] == at]])
                for v in added.get(at, []):
                    inside[at].add(v)
            medians.append(inside[at].ranked(rank)[0])
    return medians


def seen_elsewhere(at: np.ndarray, country: pd.Series, last: dict[str, int]) -> list[bool]:
    """Per new row, was another country seen in the 30 minutes up to it.  Updates ``last``."""
    found = []
    for t, place in zip(at.tolist(), country):
        known = place is not None
        found.append(known and any(
            c != place and 0 <= t - seen <= GEO_MS for c, seen in last.items()))
        if known:
            last[place] = max(t, last.get(place, t))
    return found


class TrailingScorer(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trailing", STATE)
        self.counts = handle.getMapState("counts", "slot bigint", COUNTS)
        self.amounts = handle.getMapState("amounts", AMOUNTS_KEY, AMOUNTS)

    def _counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stored slot, range, n, ordered by slot and range."""
        stored = sorted((k[0], v) for k, v in self.counts.iterator())
        slot = np.repeat(np.array([s for s, _ in stored], "int64"), [len(v[0]) for _, v in stored])
        ranges, n = (np.array([x for _, v in stored for x in v[c]], "int64") for c in (0, 1))
        return slot, ranges, n

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        # one user's share of one micro-batch; the source's rate cap bounds it
        frames = list(rows)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        if len(batch) > 1:
            batch = batch.sort_values(["tx_at", "tx_id"])
        if batch["user_id"].iloc[0] is None:
            yield batch.assign(
                tx_count_60s=1, user_median_amount=batch["amount"], geo_anomaly_flag=False,
            )[[*INPUT, "tx_count_60s", "user_median_amount", "geo_anomaly_flag"]]
            return
        at = batch["tx_at"].to_numpy("datetime64[us]").astype("int64") // 1000
        stored = self.state.get() if self.state.exists() else ([],) * 4
        one = np.ones(len(at), "int64")
        ms = np.concatenate([np.asarray(stored[0], "int64"), at])
        ms_n = np.concatenate([np.asarray(stored[1], "int64"), one])
        last = dict(zip(stored[2], stored[3]))
        counts = self._counts()
        now_slot, value = at - at % HOUR_MS, batch["amount"].to_numpy("float64") + 0.0
        read: dict[tuple[int, int], tuple] = {}

        def amounts(slot: int, of: int) -> tuple:
            if (slot, of) not in read:
                read[slot, of] = self.amounts.getValue((slot, of)) or ([], [])
            return read[slot, of]

        scored = batch.assign(
            tx_count_60s=counts_to(at, ms, ms_n),
            user_median_amount=running_medians(now_slot, value, counts, amounts),
            geo_anomaly_flag=seen_elsewhere(at, batch["country_code"], last),
        )

        newest = int(ms.max())
        near = ms > newest - 2 * MINUTE_MS
        keep_ms, where = np.unique(ms[near], return_inverse=True)
        keep_n = np.bincount(where, weights=ms_n[near]).astype("int64")
        oldest = newest - (SLOTS + 1) * HOUR_MS
        for old, of in zip(counts[0][counts[0] <= oldest].tolist(), counts[1][counts[0] <= oldest].tolist()):
            self.amounts.removeKey((old, of))
        recent = ~np.isnan(value) & (now_slot > oldest)
        new_slot, new_value = now_slot[recent], value[recent]
        new_range, new_n = amount_range(new_value), np.ones(len(new_value), "int64")
        held = {(s, r) for s, r in zip(counts[0].tolist(), counts[1].tolist())}
        order = np.lexsort((new_range, new_slot))
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(new_slot[order]) != 0) | (np.diff(new_range[order]) != 0), [True]]))
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if i == j:
                continue
            key = (int(new_slot[order[i]]), int(new_range[order[i]]))
            had = amounts(*key) if key in held else ([], [])
            values = np.concatenate([np.asarray(had[0], "float64"), new_value[order[i:j]]])
            n = np.concatenate([np.asarray(had[1], "int64"), new_n[i:j]])
            _, values, n = _merge(np.zeros(len(values), "int64"), values, n)
            self.amounts.updateValue(key, (values.tolist(), n.tolist()))
        for old in np.unique(counts[0][counts[0] <= oldest]).tolist():
            self.counts.removeKey((old,))
        touched = np.isin(counts[0], new_slot)
        slot, ranges, n = _merge(*(np.concatenate([c[touched], new]) for c, new in
                                   zip(counts, (new_slot, new_range, new_n))))
        for one in np.unique(slot).tolist():
            own = slot == one
            self.counts.updateValue((one,), (ranges[own].tolist(), n[own].tolist()))
        last = {c: t for c, t in last.items() if t >= newest - 2 * GEO_MS}
        self.state.update((
            keep_ms.tolist(), keep_n.tolist(), list(last), list(last.values()),
        ))
        self.handle.registerTimer(newest + (SLOTS + 1) * HOUR_MS)
        yield scored[[*INPUT, "tx_count_60s", "user_median_amount", "geo_anomaly_flag"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget a user a day after the last transaction; earlier timers are outdated."""
        if self.state.exists():
            newest = max(self.state.get()[0], default=0)
            if newest <= expiredTimerInfo.getExpiryTimeInMs() - SLOTS * HOUR_MS:
                self.state.clear()
                self.counts.clear()
                self.amounts.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing_score(stream: DataFrame) -> DataFrame:
    """Watermarked transactions -> the same with trailing rule columns and the combined score."""
    rows = stream.select(
        "tx_id", "user_id", "merchant", F.col("amount").cast("double").alias("amount"),
        F.upper(F.trim("country")).alias("country_code"), "tx_at",
    )
    # rows without a user share no state; the transaction spreads them over tasks
    rows = rows.withColumn("alone", F.when(F.col("user_id").isNull(), F.col("tx_id")))
    ruled = rows.groupBy("user_id", "alone").transformWithStateInPandas(
        statefulProcessor=TrailingScorer(),
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="EventTime",
    )
    ratio = F.col("amount") / F.nullif(F.col("user_median_amount"), F.lit(0.0))
    return combine_scores(velocity_points(
        ruled.withColumn("amount_ratio", F.round(ratio, 4))
        .withColumn("amount_spike_flag", ratio > SPIKE_RATIO)
    ))
