"""Intervals counted back from a batch time, at several lengths at once."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.stats import DELTA, basic_exprs, first_key, last_key, stat_exprs, usable
from seriesmill.functions.timeunits import durations, epoch_seconds
from seriesmill.operators.series import samples_between
from seriesmill.schemas import INGEST_TIME, SERIES_KEY


def lookback_aggregates(
    samples: DataFrame,
    as_of: int | dt.datetime,
    frequencies: Sequence[float],
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
    order: str = "total",
    plan: str = "panes",
) -> DataFrame:
    """Statistics and delta per series for every look-back interval.

    With T the batch time and H the longest frequency, frequency f gives the
    intervals ``[T-(k+1)f, T-kf)`` for each k >= 0 with ``T-kf > T-H``. Only the
    samples of the last H seconds count; where f does not divide H the oldest
    interval is cut at T-H and marked ``isPartial``.

    ``plan="panes"`` reduces the samples once, to intervals as long as the
    greatest common divisor of the frequencies, and builds every frequency from
    those. ``plan="direct"`` repeats each sample once per frequency, which saves
    a small shuffle where a series has hardly more than one sample per interval.
    """
    lengths = durations(frequencies)
    end = epoch_seconds(as_of)
    horizon = lengths[-1]
    recent = samples_between(usable(samples, *keys, time_col), end - horizon, end, time_col)
    age = F.lit(end - 1) - F.col(time_col)  # 0 for the newest second
    every_length = F.explode(F.array(*[F.lit(n).cast("bigint") for n in lengths]))

    if plan == "direct" or len(lengths) == 1:
        grouped = (
            recent.withColumn("windowSeconds", every_length)
            .withColumn("age", age - F.pmod(age, F.col("windowSeconds")))
            .groupBy(*keys, "windowSeconds", "age")
            .agg(*stat_exprs(DELTA, order))
        )
    elif plan == "panes":
        step = math.gcd(*lengths)
        panes = (
            recent.withColumn("paneStart", F.lit(end - step) - age + F.pmod(age, F.lit(step)))
            .groupBy(*keys, "paneStart")
            .agg(*basic_exprs(), first_key(order).alias("oldest"), last_key(order).alias("newest"))
        )
        return lookback_from_panes(panes, end, frequencies, keys, step)
    else:
        raise ValueError(f"unknown plan {plan!r}")

    return _intervals(grouped, end, horizon, keys)


def lookback_from_panes(
    panes: DataFrame,
    as_of: int | dt.datetime,
    frequencies: Sequence[float],
    keys: Sequence[str] = (SERIES_KEY,),
    step: int | None = None,
) -> DataFrame:
    """The same intervals from panes with their oldest and newest samples.

    ``step`` is the panes' length in seconds, by default the greatest common divisor of the
    frequencies; it must divide each of these, and ``as_of`` must be the end of a pane.
    """
    lengths = durations(frequencies)
    end, horizon = epoch_seconds(as_of), lengths[-1]
    step = step or math.gcd(*lengths)
    pane = F.col("paneStart")
    grouped = (
        panes.where((pane >= end - horizon) & (pane < end))
        .withColumn("windowSeconds", F.explode(F.array(*[F.lit(n).cast("bigint") for n in lengths])))
        .withColumn("paneAge", F.lit(end - step) - pane)
        .withColumn("age", F.col("paneAge") - F.pmod("paneAge", "windowSeconds"))
        .groupBy(*keys, "windowSeconds", "age")
        .agg(
            F.sum("countOfSamples").alias("countOfSamples"),
            F.min("minValOfSamples").alias("minValOfSamples"),
            F.max("maxValOfSamples").alias("maxValOfSamples"),
            (F.sum("sumValOfSamples") / F.sum("countOfSamples")).alias("avgValOfSamples"),
            F.sum("sumValOfSamples").alias("sumValOfSamples"),
            F.min("oldest").alias("oldest"),
            F.max("newest").alias("newest"),
        )
        .withColumn("delta", F.col("newest.value") - F.col("oldest.value"))
        .drop("oldest", "newest")
    )
    return _intervals(grouped, end, horizon, keys)


#: A node is as long as so many of the next shorter ones.
NODE_FAN = 8


def node_sizes(step: int, horizon: int) -> list[int]:
    """Lengths of the nodes of panes as long as ``step``, each of which an interval can hold."""
    sizes = [step]
    while sizes[-1] * NODE_FAN <= horizon:
        sizes.append(sizes[-1] * NODE_FAN)
    return sizes


def _fits(start, size: int, as_of: int, lengths: Sequence[int], floor):
    """Whether a node lies in a single interval of each length, and within the longest."""
    fits = (start >= as_of - lengths[-1]) & (start + size <= as_of)
    for length in lengths:
        fits = fits & (floor((start - as_of) / length) == floor((start + size - 1 - as_of) / length))
    return fits


def in_cover(as_of: int, lengths: Sequence[int], size: int, longer: int | None) -> Column:
    """Whether the node at ``paneStart`` is one of the longest that make up all intervals.

    Nodes of a size start at its multiples. A node is used where it lies within an interval of each
    length, and the next longer node that holds it doesn't.
    """
    start = F.col("paneStart")
    used = _fits(start, size, as_of, lengths, F.floor)
    if longer is not None:
        used = used & ~_fits(start - F.pmod(start, F.lit(longer)), longer, as_of, lengths, F.floor)
    return used


def node_days(as_of: int, lengths: Sequence[int], size: int, longer: int | None) -> list[int]:
    """The days, since 1970, in which nodes of a size are used."""
    start = np.arange((as_of - lengths[-1]) // size * size, as_of, size)
    used = _fits(start, size, as_of, lengths, np.floor)
    if longer is not None:
        used &= ~_fits(start - start % longer, longer, as_of, lengths, np.floor)
    return np.unique(start[used] // (24 * 60 * 60)).tolist()


def _intervals(grouped: DataFrame, end: int, horizon: int, keys: Sequence[str]) -> DataFrame:
    interval_end = F.lit(end) - F.col("age")
    interval_start = interval_end - F.col("windowSeconds")
    return grouped.select(
        *keys,
        "windowSeconds",
        F.timestamp_seconds(interval_start).alias("windowStart"),
        F.timestamp_seconds(interval_end).alias("windowEnd"),
        (interval_start < end - horizon).alias("isPartial"),
        *[c for c in grouped.columns if c not in (*keys, "windowSeconds", "age")],
    )
