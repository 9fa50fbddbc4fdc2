"""The three per-user risk rules and their combined score, in batch.

Input: staged transactions, one row per ``tx_id`` (``user_id``, ``tx_at``, ``amount``,
``country_code`` are read).  Output: the same rows with score columns, again one row per ``tx_id``.
A transaction lies in several sliding windows; the rules take the most suspicious one (highest
count, lowest median).  A null user matches nobody, not even another null user.

Two ways to compute the same columns, chosen per user by row count:

* Users with at most ``hot_user_rows`` rows: window functions over ``user_id``.  All rules share one
  exchange, and a group never exceeds ``hot_user_rows`` rows.
* Hot users: their rows are never gathered.  Partial aggregation reduces them to time slots (or
  distinct moments), the rules run on those, and the result is joined back on (user, slot), which
  spreads one user over many tasks.  A user's slots are bounded by time span / slide.

Who is hot is found before the plan is made, by one narrow count: without hot users the plan has no
second branch, and the list is broadcast only up to a checked number of entries.  Hot rows are written
once to the cluster's checkpoint folder, so that the rules, which read them several times, do not read
the source again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillwatch.functions.timegrid import at_micros, epoch_micros, micros, slot, window_grid
from tillwatch.session import checkpointed

HOT_USER_ROWS = 500_000
#: hot users that are broadcast; a longer list is joined by a shuffle
MOST_LISTED = 100_000

# Rule thresholds.
VELOCITY_WARNING = 5
VELOCITY_CRITICAL = 10
SPIKE_RATIO = 3.0
LEAST_ACCURACY = 10_000

RowRule = Callable[[DataFrame], DataFrame]


# ---------------------------------------------------------------- splitting by user size

def _listed(df: DataFrame, hot_user_rows: int) -> DataFrame | None:
    """The hot users (``_hot``), null among them if so many rows have no user; None if nobody is hot.

    An action: a count per user, of which the hot ones, at most rows / ``hot_user_rows``, come back.
    """
    counts = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_user_rows)
    users = counts.select(F.col("user_id").alias("_hot"))
    first = users.limit(MOST_LISTED + 1).collect()
    if not first:
        return None
    if len(first) > MOST_LISTED:
        return users
    return F.broadcast(df.sparkSession.createDataFrame(first, users.schema))


def _split(df: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other users, rows of the listed ones, stored)."""
    is_listed = F.col("user_id").eqNullSafe(F.col("_hot"))
    return df.join(listed, is_listed, "left_anti"), checkpointed(df.join(listed, is_listed, "left_semi"))


def _by_user_size(df: DataFrame, small: RowRule, hot: RowRule, hot_user_rows: int) -> DataFrame:
    def alone(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_alone", F.when(F.col("user_id").isNull(), F.col("tx_id")))

    # rows without a user are many small groups, whatever their number
    listed = _listed(df.filter(F.col("user_id").isNotNull()), hot_user_rows)
    if listed is None:
        return small(alone(df)).drop("_alone")
    usual, heavy = _split(df, listed)
    return small(alone(usual)).drop("_alone").unionByName(hot(heavy))


# One user's rows; rows without a user each stand alone.  Every window of the small path partitions
# by these same two columns, so one exchange serves them all.
USER_GROUP = ["user_id", "_alone"]


def _per_user(*order: Column) -> WindowSpec:
    return Window.partitionBy(*USER_GROUP).orderBy(*order)


# ---------------------------------------------------------------- window relations

def _spread(start: Column, length: int, step: int) -> Column:
    """Starts of all windows that hold the slot beginning at ``start``."""
    return F.explode(F.sequence(start - (length - step), start, F.lit(step)))


def _window_bounds(length: int) -> list[Column]:
    return [at_micros(F.col("_start")).alias("window_start"),
            at_micros(F.col("_start") + length).alias("window_end")]


def velocity_windows(df: DataFrame, window: str = "60 seconds", slide: str = "10 seconds"
                     ) -> DataFrame:
    """Transactions per (user, sliding window).

    Rows become slot counts before anything is multiplied by the number of windows; the windows of a
    user are then summed where the user's slots are, without a further exchange.
    """
    length, step = window_grid(window, slide)
    slots = df.groupBy("user_id", slot(F.col("tx_at"), step).alias("_slot")).agg(
        F.count(F.lit(1)).alias("_n"))
    return (
        slots.repartition("user_id")
        .select("user_id", "_n", _spread(F.col("_slot"), length, step).alias("_start"))
        .groupBy("user_id", "_start")
        .agg(F.sum("_n").alias("tx_count_60s"))
        .select("user_id", *_window_bounds(length), "tx_count_60s")
    )


def _median_accuracy(hot_user_rows: int) -> int:
    """Accuracy at which ``percentile_approx`` keeps every value of a group of ``hot_user_rows``."""
    return min(max(LEAST_ACCURACY, 4 * hot_user_rows), 2**31 - 1)


def _amount_range(amount: Column) -> Column:
    """A range that holds the amount: number of digits, then the three leading ones.  Larger amounts
    never have a smaller range, and there are at most some thousand of them."""
    size = F.abs(amount)
    digits = F.length(F.floor(size).cast("string"))
    range_no = digits * 1000 + F.floor(size / F.pow(F.lit(10.0), digits - 3))
    return F.when(amount < 0, -range_no).otherwise(range_no)


def _counted_medians(rows: DataFrame, length: int, step: int) -> DataFrame:
    """Exact lower median ``_m`` per (user_id, ``_start``) of rows (user_id, amount, ``_slot``).

    For users of any size: equal amounts of a slot become one count before they move.  Counts per
    amount range, few for each slot, are repeated per window and tell in which range the median lies
    and at which rank there; only amounts of that range are then looked at.
    """
    counts = rows.groupBy("user_id", "_slot", "amount").agg(F.count("amount").alias("_n"))
    counts = counts.withColumn("_range", _amount_range(F.col("amount")))
    keys = ["user_id", "_start"]
    ranges = (
        counts.groupBy("user_id", "_slot", "_range").agg(F.sum("_n").alias("_n"))
        .select("user_id", "_range", "_n", _spread(F.col("_slot"), length, step).alias("_start"))
        .groupBy(*keys, "_range").agg(F.sum("_n").alias("_n"))
    )
    whole = Window.partitionBy(*keys)
    half = F.floor((F.sum("_n").over(whole) + 1) / 2)
    chosen = (
        ranges.withColumns({"_half": half, "_upto": F.sum("_n").over(whole.orderBy("_range"))})
        .filter((F.col("_upto") >= F.col("_half")) & (F.col("_upto") - F.col("_n") < F.col("_half")))
        .select(*keys, "_range", (F.col("_half") - F.col("_upto") + F.col("_n")).alias("_rank"))
    )
    per_slot = chosen.withColumn("_slot", F.explode(F.sequence(
        F.col("_start"), F.col("_start") + (length - step), F.lit(step))))
    same_user = F.col("c.user_id").eqNullSafe(F.col("p.user_id"))
    inside = counts.alias("c").join(
        per_slot.alias("p"),
        same_user & (F.col("c._slot") == F.col("p._slot")) & (F.col("c._range") == F.col("p._range")))
    return (
        inside.groupBy("p.user_id", "_start", "amount")
        .agg(F.sum("_n").alias("_n"), F.first("_rank").alias("_rank"))
        .withColumn("_upto", F.sum("_n").over(whole.orderBy("amount")))
        .filter(F.col("_upto") >= F.col("_rank"))
        .groupBy(*keys).agg(F.min("amount").alias("_m"))
    )


def _window_runs(rows: DataFrame, length: int, step: int, accuracy: int) -> DataFrame:
    """Exact median ``_m`` per (user_id, ``_start``) of rows (user_id, amount, ``_slot``), groups of a bounded size.

    Sliding along the grid, what a window holds changes only where a slot enters at its end or leaves at
    its start.  So each row stands at its slot and marks those two starts; the median is taken once per
    mark, over the rows ahead of it, and holds until the next mark.  Windows are told apart last.
    """
    def mark(at: Column, real: bool) -> Column:
        return F.struct(at.alias("_at"), (F.col("amount") if real else F.lit(None).cast("double")).alias("_amount"), F.lit(real).alias("_real"))

    slot_at = F.col("_slot")
    marks = rows.repartition("user_id").select("user_id", F.inline(F.array(
        mark(slot_at, True), mark(slot_at - (length - step), False), mark(slot_at + step, False))))
    per_user = Window.partitionBy("user_id").orderBy("_at")
    ahead = per_user.rangeBetween(0, length - step)
    runs = marks.withColumns({
        "_m": F.percentile_approx("_amount", 0.5, accuracy).over(ahead),
        "_held": F.count(F.when(F.col("_real"), 1)).over(ahead),
        "_next": F.min(F.when(~F.col("_real"), F.col("_at"))).over(per_user.rangeBetween(1, Window.unboundedFollowing)),
    }).filter(~F.col("_real") & (F.col("_held") > 0))
    once = runs.groupBy("user_id", "_at").agg(F.first("_m").alias("_m"), F.first("_next").alias("_next"))
    return once.select("user_id", "_m", F.explode(F.sequence(F.col("_at"), F.col("_next") - step, F.lit(step))).alias("_start"))


def amount_windows(df: DataFrame, window: str = "24 hours", slide: str = "1 hour",
                   hot_user_rows: int = HOT_USER_ROWS) -> DataFrame:
    """Exact median amount per (user, sliding window), null where a window has no amount.

    Usual users: rows move once to their user's partition, medians are taken where the content changes.
    Hot users (rows without a user share a group here) are counted instead, see ``_counted_medians``.
    """
    length, step = window_grid(window, slide)
    amounts = df.select("user_id", F.col("amount").cast("double").alias("amount"),
                        slot(F.col("tx_at"), step).alias("_slot"))
    listed = _listed(amounts, hot_user_rows)
    usual, heavy = (amounts, None) if listed is None else _split(amounts, listed)
    found = _window_runs(usual, length, step, _median_accuracy(hot_user_rows)).select("user_id", "_start", "_m")
    if heavy is not None:
        # windows without any amount have no median but are windows
        bare = heavy.groupBy("user_id", "_slot").agg(F.max("amount").alias("amount"))
        bare = bare.select("user_id", "amount", _spread(F.col("_slot"), length, step).alias("_start"))
        bare = bare.groupBy("user_id", "_start").agg(F.max("amount").alias("_m")).filter("_m is null")
        found = found.unionByName(_counted_medians(heavy, length, step)).unionByName(bare)
    return found.select("user_id", *_window_bounds(length), F.col("_m").alias("user_median_amount"))


# ---------------------------------------------------------------- velocity

def _busiest(cell: str, count: Column, length: int, step: int, spec: WindowSpec
             ) -> tuple[Column, Callable[[str], Column]]:
    """Count of the window opening at a slot, and the best such count among windows that hold it.

    A window that opens on an empty slot never counts more than the one that opens on its first
    non-empty slot, so windows opening on present slots are enough.
    """
    opening = count.over(spec.rangeBetween(0, length - step))
    return opening, lambda name: F.max(name).over(spec.rangeBetween(step - length, 0))


def _velocity_small(df: DataFrame, window: str, slide: str) -> DataFrame:
    length, step = window_grid(window, slide)
    df = df.withColumn("_slot_v", slot(F.col("tx_at"), step))
    opening, best = _busiest("_slot_v", F.count(F.lit(1)), length, step, _per_user(F.col("_slot_v")))
    return (
        df.withColumn("_open_v", opening)
        .withColumn("tx_count_60s", best("_open_v"))
        .drop("_slot_v", "_open_v")
    )


def _velocity_hot(df: DataFrame, window: str, slide: str) -> DataFrame:
    length, step = window_grid(window, slide)
    df = df.withColumn("_slot_v", slot(F.col("tx_at"), step))
    spec = Window.partitionBy("user_id").orderBy("_slot_v")
    opening, best = _busiest("_slot_v", F.sum("_n"), length, step, spec)
    slots = (
        df.groupBy("user_id", "_slot_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_open_v", opening)
        .select("user_id", "_slot_v", best("_open_v").alias("tx_count_60s"))
    )
    return df.join(slots, ["user_id", "_slot_v"], "left").drop("_slot_v")


def velocity_points(df: DataFrame) -> DataFrame:
    """``velocity_score`` from ``tx_count_60s``."""
    n = F.col("tx_count_60s")
    return df.withColumn(
        "velocity_score",
        F.when(n > VELOCITY_CRITICAL, 2).when(n > VELOCITY_WARNING, 1).otherwise(0),
    )


def velocity_score(df: DataFrame, window: str = "60 seconds", slide: str = "10 seconds",
                   hot_user_rows: int = HOT_USER_ROWS) -> DataFrame:
    """Add ``tx_count_60s`` (highest count among the windows holding the row) and
    ``velocity_score``: over 10 -> 2, over 5 -> 1, else 0."""
    return velocity_points(_by_user_size(
        df,
        lambda d: _velocity_small(d, window, slide),
        lambda d: _velocity_hot(d, window, slide),
        hot_user_rows,
    ))


# ---------------------------------------------------------------- amount against median

def _usable(median: Column) -> Column:
    """The median, or infinity where it gives no ratio: a zero median must not hide a positive one
    when the lowest is taken."""
    return F.when(median > 0, median).when(median.isNotNull(), F.lit(float("inf")))


def _median_small(df: DataFrame, window: str, slide: str, accuracy: int) -> DataFrame:
    """Lowest median among the windows that hold a row, without repeating rows per window.

    Sliding along the grid, a window's content changes only where a slot enters at its end or one
    leaves at its start.  So it is enough to look at the windows ending with a present slot and at
    those opening right after one.
    """
    length, step = window_grid(window, slide)
    spec = _per_user(F.col("_slot_m"))
    median = F.percentile_approx("_amount", 0.5, accuracy)
    lowest_ending = F.min(_usable(F.col("_ending"))).over(spec.rangeBetween(0, length - step))
    lowest_after = F.min(_usable(F.col("_after"))).over(spec.rangeBetween(-length, -step))
    return (
        df.withColumns({"_slot_m": slot(F.col("tx_at"), step),
                        "_amount": F.col("amount").cast("double")})
        .withColumns({"_ending": median.over(spec.rangeBetween(step - length, 0)),
                      "_after": median.over(spec.rangeBetween(step, length))})
        .withColumn("_median", F.least(lowest_ending, lowest_after))
        .drop("_slot_m", "_amount", "_ending", "_after")
    )


def _median_hot(df: DataFrame, window: str, slide: str) -> DataFrame:
    length, step = window_grid(window, slide)
    df = df.withColumn("_slot_m", slot(F.col("tx_at"), step))
    per_window = _counted_medians(
        df.select("user_id", F.col("amount").cast("double").alias("amount"),
                  F.col("_slot_m").alias("_slot")), length, step)
    per_slot = (
        per_window.select("user_id", "_m", F.explode(F.sequence(
            F.col("_start"), F.col("_start") + (length - step), F.lit(step))).alias("_slot_m"))
        .groupBy("user_id", "_slot_m")
        .agg(F.min(_usable(F.col("_m"))).alias("_median"))
    )
    return df.join(per_slot, ["user_id", "_slot_m"], "left").drop("_slot_m")


def amount_points(df: DataFrame, round_before_compare: bool = False) -> DataFrame:
    """``user_median_amount``, ``amount_ratio`` and ``amount_spike_flag`` from ``_median``, the lowest usable one."""
    amount = F.col("amount").cast("double")
    no_ratio = F.col("_median") == float("inf")
    df = df.withColumn(
        "user_median_amount", F.when(no_ratio, 0.0).otherwise(F.coalesce("_median", amount))
    ).drop("_median")
    ratio = amount / F.nullif(F.col("user_median_amount"), F.lit(0.0))
    shown = F.round(ratio, 4)
    return df.withColumn("amount_ratio", shown).withColumn(
        "amount_spike_flag", (shown if round_before_compare else ratio) > SPIKE_RATIO
    )


def amount_spike(df: DataFrame, window: str = "24 hours", slide: str = "1 hour",
                 round_before_compare: bool = False, hot_user_rows: int = HOT_USER_ROWS
                 ) -> DataFrame:
    """Add ``user_median_amount`` (lowest positive window median, 0 if there is none),
    ``amount_ratio`` (4 places) and ``amount_spike_flag`` (ratio over 3; null where the median is 0).

    The unrounded ratio is compared unless ``round_before_compare``.
    """
    return amount_points(_by_user_size(
        df,
        lambda d: _median_small(d, window, slide, _median_accuracy(hot_user_rows)),
        lambda d: _median_hot(d, window, slide),
        hot_user_rows,
    ), round_before_compare)


# ---------------------------------------------------------------- country change

def _next_elsewhere(df: DataFrame, country: str, keys: list, carry: list[str]) -> DataFrame:
    """Add ``_next``: the next row in (time, country) order with another country, as a struct of
    (``_us``, country, *carry).  One running pass per group, whatever the group's density.

    Read backwards in time; rows without a country are passed over.
    """
    spec = Window.partitionBy(*keys).orderBy(F.desc("_us"), F.desc(country))
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    row = F.when(F.col(country).isNotNull(), F.struct("_us", country, *carry))
    following = F.last(row, ignorenulls=True).over(before)
    change = F.when(F.col("_follow")[country] != F.col(country), F.col("_follow"))
    return (
        df.withColumn("_follow", following)
        .withColumn("_change", change)
        .withColumn(
            "_next",
            F.last("_change", ignorenulls=True)
            .over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .drop("_follow", "_change")
    )


def _geo_small(df: DataFrame, within: str) -> DataFrame:
    span = micros(within)
    country = F.col("country_code")
    df = df.withColumn("_us", epoch_micros(F.col("tx_at")))
    df = _next_elsewhere(df, "country_code", USER_GROUP, [])
    same_time = _per_user(F.desc("_us")).rangeBetween(Window.currentRow, Window.currentRow)
    clash = F.min("country_code").over(same_time) != F.max("country_code").over(same_time)
    soon = F.coalesce(F.col("_next._us") <= F.col("_us") + span, F.lit(False))
    return (
        df.withColumn("_clash", clash)
        .withColumn(
            "geo_anomaly_flag",
            country.isNotNull() & (soon | F.coalesce("_clash", F.lit(False))),
        )
        .drop("_us", "_next", "_clash")
    )


def _moments(df: DataFrame, within: str, *more: Column) -> DataFrame:
    """Distinct (user, time, country), each in its own time bucket and as look-ahead in the one
    before.

    With millisecond times a (user, bucket) group has at most ``2 * within`` in milliseconds times
    the number of countries, however many rows the user has.
    """
    span = micros(within)
    bucket = slot(F.col("tx_at"), span)
    placed = df.filter(F.col("user_id").isNotNull() & F.col("country_code").isNotNull())
    keys = ["user_id", "tx_at", "country_code"]
    distinct = placed.groupBy(*keys).agg(*more) if more else placed.select(*keys).distinct()
    return (
        distinct
        .withColumn("_us", epoch_micros(F.col("tx_at")))
        .withColumn("_bucket", F.explode(F.array(bucket, bucket - span)))
    )


def _geo_hot(df: DataFrame, within: str) -> DataFrame:
    span = micros(within)
    keys = ["user_id", "_bucket"]
    same_time = Window.partitionBy(*keys).orderBy(F.desc("_us")).rangeBetween(
        Window.currentRow, Window.currentRow
    )
    flagged = (
        _next_elsewhere(_moments(df, within), "country_code", keys, [])
        .withColumn("_peers", F.count(F.lit(1)).over(same_time))
        .filter(F.col("_bucket") == slot(F.col("tx_at"), span))
        .filter((F.col("_next._us") <= F.col("_us") + span) | (F.col("_peers") > 1))
        .select("user_id", "tx_at", "country_code", F.lit(True).alias("_hit"))
    )
    return (
        df.join(flagged, ["user_id", "tx_at", "country_code"], "left")
        .withColumn("geo_anomaly_flag", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def geo_anomaly(df: DataFrame, within: str = "30 minutes", hot_user_rows: int = HOT_USER_ROWS
                ) -> DataFrame:
    """Add ``geo_anomaly_flag``: the user has a transaction in another country at the same time or
    up to ``within`` later.  Only the earlier one of a pair is flagged; a null country never
    matches."""
    return _by_user_size(
        df, lambda d: _geo_small(d, within), lambda d: _geo_hot(d, within), hot_user_rows
    )


def geo_pairs(df: DataFrame, within: str = "30 minutes") -> DataFrame:
    """For each (user, time, country) the first moment, in (time, country) order, in another country
    at the same time or up to ``within`` later; each side names its smallest tx_id.  So every flagged
    moment has a partner, both sides of a same-time pair included.

    One partner per moment: the full pair list grows with the square of a user's activity.
    """
    span = micros(within)
    moments = _moments(df, within, F.min("tx_id").alias("tx_id"))
    keys = ["user_id", "_bucket"]
    same_time = Window.partitionBy(*keys).orderBy(F.desc("_us")).rangeBetween(
        Window.currentRow, Window.currentRow
    )
    least = F.min(F.struct("_us", "country_code", "tx_id")).over(same_time)
    at_once = F.col("_least.country_code") != F.col("country_code")
    return (
        _next_elsewhere(moments, "country_code", keys, ["tx_id"])
        .withColumn("_least", least)
        .withColumn("_next", F.when(at_once, F.col("_least")).otherwise(F.col("_next")))
        .filter(F.col("_bucket") == slot(F.col("tx_at"), span))
        .filter(F.col("_next._us") <= F.col("_us") + span)
        .select(
            "user_id",
            "tx_at",
            "country_code",
            "tx_id",
            at_micros(F.col("_next._us")).alias("pair_tx_at"),
            F.col("_next.country_code").alias("pair_country_code"),
            F.col("_next.tx_id").alias("pair_tx_id"),
        )
    )


# ---------------------------------------------------------------- combined score

def combine_scores(df: DataFrame) -> DataFrame:
    """Add ``fraud_score`` (one point per fired rule), ``triggered_rules`` (comma separated, fixed
    order) and ``is_flagged``.  A null flag counts as not fired; velocity 2 is still one point."""
    fired = {
        "velocity": F.col("velocity_score") > 0,
        "amount_spike": F.col("amount_spike_flag"),
        "geo_anomaly": F.col("geo_anomaly_flag"),
    }
    points = [F.when(c, 1).otherwise(0) for c in fired.values()]
    names = [F.when(c, F.lit(name)) for name, c in fired.items()]
    return (
        df.withColumn("fraud_score", points[0] + points[1] + points[2])
        .withColumn("triggered_rules", F.concat_ws(",", *names))
        .withColumn("is_flagged", F.col("fraud_score") >= 1)
    )


def score_transactions(df: DataFrame, velocity_window: str = "60 seconds",
                       velocity_slide: str = "10 seconds", amount_window: str = "24 hours",
                       amount_slide: str = "1 hour", geo_within: str = "30 minutes",
                       round_before_compare: bool = False, hot_user_rows: int = HOT_USER_ROWS
                       ) -> DataFrame:
    """All three rules and the combined score, every input row kept."""

    def small(d: DataFrame) -> DataFrame:
        d = _velocity_small(d, velocity_window, velocity_slide)
        d = _median_small(d, amount_window, amount_slide, _median_accuracy(hot_user_rows))
        return _geo_small(d, geo_within)

    def hot(d: DataFrame) -> DataFrame:
        d = _velocity_hot(d, velocity_window, velocity_slide)
        d = _median_hot(d, amount_window, amount_slide)
        return _geo_hot(d, geo_within)

    ruled = _by_user_size(df, small, hot, hot_user_rows)
    return combine_scores(amount_points(velocity_points(ruled), round_before_compare))


def flagged_transactions(scored: DataFrame) -> DataFrame:
    """Only transactions on which at least one rule fired."""
    return scored.filter("is_flagged")


