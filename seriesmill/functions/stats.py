"""Aggregate expressions over the samples of one series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.schemas import INGEST_TIME

STDDEV = "stddev"
DELTA = "delta"

# Name of the statistic in the published record.
STAT_COLUMN = {STDDEV: "stddevValOfSamples", DELTA: "delta"}

# Names and order of the statistics in the published record.
BASIC_COLUMNS = (
    "countOfSamples",
    "minValOfSamples",
    "maxValOfSamples",
    "avgValOfSamples",
    "sumValOfSamples",
)


def order_key(order: str = "total") -> Column:
    """What makes one sample of a series newer than another.

    ``total`` breaks ties on the ingest second by event time, id and value, so a
    result never depends on the order in which Spark reads the rows. The struct
    makes Spark use a sort-based aggregate. ``ingest`` compares the ingest
    second alone and keeps the hash aggregate; use it only where a series has at
    most one sample a second.
    """
    if order == "total":
        return F.struct(INGEST_TIME, "unixTimestamp", "id", "value")
    if order == "ingest":
        return F.col(INGEST_TIME)
    raise ValueError(f"unknown order {order!r}")


def usable(samples: DataFrame, *columns: str) -> DataFrame:
    """The rows with a value, a series and a time: no field of a sample is ever null.

    Sources put other rows with the rejects; here they are left out of every aggregate alike.
    """
    known = [F.col(name).isNotNull() for name in dict.fromkeys(("value", *columns))]
    return samples.where(reduce(Column.__and__, known))


def basic_exprs(value: str = "value") -> list[Column]:
    return [
        F.count(value).alias("countOfSamples"),
        F.min(value).alias("minValOfSamples"),
        F.max(value).alias("maxValOfSamples"),
        F.avg(value).alias("avgValOfSamples"),
        F.sum(value).alias("sumValOfSamples"),
    ]


def stddev_expr(value: str = "value") -> Column:
    """Sample standard deviation; NULL for a single sample."""
    return F.stddev_samp(value)


def first_expr(order: str = "total", value: str = "value") -> Column:
    return F.min_by(value, order_key(order))


def last_expr(order: str = "total", value: str = "value") -> Column:
    return F.max_by(value, order_key(order))


def first_key(order: str = "total") -> Column:
    """Order and ``value`` of the oldest sample in one struct, to be merged by the least."""
    return F.min(_ordered_value(order))


def last_key(order: str = "total") -> Column:
    """Order and ``value`` of the newest sample in one struct, to be merged by the greatest."""
    return F.max(_ordered_value(order))


def _ordered_value(order: str) -> Column:
    return order_key(order) if order == "total" else F.struct(order_key(order), "value")


def delta_expr(order: str = "total", value: str = "value") -> Column:
    """Newest value minus oldest value; 0 for a single sample."""
    return last_expr(order, value) - first_expr(order, value)


def stat_exprs(stat: str = STDDEV, order: str = "total") -> list[Column]:
    """The five basic statistics and the one that ``stat`` names."""
    extra = {STDDEV: stddev_expr, DELTA: lambda: delta_expr(order)}
    if stat not in extra:
        raise ValueError(f"unknown statistic {stat!r}")
    return [*basic_exprs(), extra[stat]().alias(STAT_COLUMN[stat])]
