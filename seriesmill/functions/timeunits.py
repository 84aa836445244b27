"""Durations and epoch-second arithmetic.

Windows are computed on whole epoch seconds held in bigint columns, so that no
result depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def minutes_to_seconds(minutes: float) -> int:
    """Whole seconds in a (possibly fractional) number of minutes, truncated."""
    seconds = int(minutes * 60)
    if seconds <= 0:
        raise ValueError(f"a duration must be at least one second, got {minutes} minutes")
    return seconds


def durations(minutes: Iterable[float]) -> list[int]:
    """Distinct durations in seconds, shortest first."""
    seconds = sorted({minutes_to_seconds(m) for m in minutes})
    if not seconds:
        raise ValueError("at least one duration is needed")
    return seconds


def epoch_seconds(moment: int | dt.datetime) -> int:
    """Epoch seconds of a batch time; a naive datetime is taken as UTC."""
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=dt.timezone.utc)
        return (moment - EPOCH) // dt.timedelta(seconds=1)
    return int(moment)


def interval_text(seconds: int) -> str:
    return f"{seconds} seconds"


def floor_to(seconds: Column, step: int | Column) -> Column:
    """Greatest multiple of ``step`` not above ``seconds``; also right before 1970."""
    step = F.lit(step) if isinstance(step, int) else step
    return seconds - F.pmod(seconds, step)


def millis_to_seconds(millis: Column) -> Column:
    """Epoch milliseconds to epoch seconds, rounding down."""
    return F.unix_seconds(F.timestamp_millis(millis))


def iso_instant(seconds: Column) -> Column:
    """ISO-8601 UTC text of epoch seconds, whatever the session time zone."""
    elapsed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + elapsed
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
