"""Streaming windows whose state is kept by Spark's state store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seriesmill.functions.stats import DELTA, STDDEV
from seriesmill.functions.timeunits import interval_text, minutes_to_seconds
from seriesmill.operators.sliding import windowed_aggregates
from seriesmill.schemas import INGEST_TIME, SERIES_KEY


def streaming_sliding_aggregates(
    samples: DataFrame,
    window: float,
    slide: float,
    lateness: float | None = None,
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
) -> DataFrame:
    """Sliding statistics of one window length over a stream of samples.

    Samples up to ``lateness`` minutes late are counted; the default is one
    window length. State holds window / slide rows per series, so for long
    windows prefer :mod:`seriesmill.streaming.panes`.
    """
    delay = interval_text(minutes_to_seconds(window if lateness is None else lateness))
    return windowed_aggregates(samples, window, slide, STDDEV, time_col, keys, watermark=delay)


def streaming_interval_aggregates(
    samples: DataFrame,
    frequency: float,
    period: float,
    horizon: float,
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
    order: str = "total",
) -> DataFrame:
    """Look-back intervals of one frequency over a stream, for a batch every ``period``.

    With batches at multiples of the period, the intervals of all batches are the
    windows of length f that start at each multiple of the shorter of f and the
    period, provided one divides the other. Late samples update their interval
    while it is inside the horizon (minutes), the longest frequency of the job.
    Each sample is handed to f / p intervals: for long ones and short periods use the jobs in
    ``seriesmill.plans.jobs``, which merge panes.
    """
    f, p = minutes_to_seconds(frequency), minutes_to_seconds(period)
    if f % p and p % f:
        raise ValueError(f"neither of {f} s and {p} s divides the other")
    slide = period if f % p == 0 else frequency
    delay = interval_text(minutes_to_seconds(horizon))
    return windowed_aggregates(
        samples, frequency, slide, DELTA, time_col, keys, order, watermark=delay
    )
