"""Time slots in microseconds since 1970-01-01.

A sliding window whose length is a multiple of its slide starts on the slide grid, so every row of
one slide-wide slot lies in exactly the same windows.  The rules below work on these slots.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(interval: str) -> int:
    """Length of an interval text such as ``'24 hours'``."""
    return int(pd.Timedelta(interval).value // 1000)


def window_grid(window: str, slide: str) -> tuple[int, int]:
    """(window, slide) in microseconds; the window has to be a whole number of slides."""
    length, step = micros(window), micros(slide)
    if step <= 0 or length < step or length % step:
        raise ValueError(f"window {window!r} has to be a multiple of slide {slide!r}")
    return length, step


def epoch_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def slot(ts: Column, width: int) -> Column:
    """Start of the ``width``-microsecond slot that holds ``ts``."""
    us = epoch_micros(ts)
    return us - F.pmod(us, F.lit(width))


def at_micros(us: Column) -> Column:
    """Microseconds since the epoch as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def floor_millis(ts: Column) -> Column:
    """Cut a ``timestamp_ntz`` to milliseconds without passing through the session time zone."""
    return at_micros(slot(ts, 1000))


def floor_hour(ts: Column) -> Column:
    return at_micros(slot(ts, 3_600_000_000))


def hours_between(earlier: Column, later: Column) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(3.6e9)


def as_utc(ts: Column) -> Column:
    """A ``timestamp`` (an instant) as zone-less UTC, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def zoneless(df: DataFrame, name: str) -> Column:
    """Column ``name`` as zone-less UTC, be it an instant or zone-less already."""
    if isinstance(df.schema[name].dataType, TimestampType):
        return as_utc(F.col(name))
    return F.col(name).cast("timestamp_ntz")
