"""Aggregates over all given samples of a series, and the time-range filter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.stats import STDDEV, stat_exprs, usable
from seriesmill.functions.timeunits import epoch_seconds
from seriesmill.schemas import INGEST_TIME, SERIES_KEY


def samples_between(
    samples: DataFrame,
    start: int | dt.datetime,
    end: int | dt.datetime,
    time_col: str = INGEST_TIME,
) -> DataFrame:
    """Samples with ``start <= time < end``.

    The raw column is compared with whole seconds, so the range reaches a
    Parquet scan.
    """
    seconds = F.col(time_col)
    return samples.where((seconds >= epoch_seconds(start)) & (seconds < epoch_seconds(end)))


def series_aggregates(
    samples: DataFrame,
    stat: str = STDDEV,
    keys: Sequence[str] = (SERIES_KEY,),
    order: str = "total",
) -> DataFrame:
    """One row of statistics per series."""
    return usable(samples, *keys).groupBy(*keys).agg(*stat_exprs(stat, order))
