"""Joining aggregates with the sensor dimension, and the published record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.stats import BASIC_COLUMNS, STAT_COLUMN
from seriesmill.schemas import POINT_FIELDS, SERIES_KEY
from seriesmill.sources.point_table import PART, PointTable

# Points whose plan promises at most so many bytes are broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(points: DataFrame | PointTable, most: int = BROADCAST_BYTES) -> bool:
    """Whether the dimension has at most ``most`` bytes by the statistics of its plan.

    No job is started. For files these are their sizes; for joins Spark multiplies the sizes of both
    sides, so that only small tables pass, and no large one does. A table in buckets is never broadcast.
    """
    if isinstance(points, PointTable):
        return False
    plan = points._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) <= most


def enrich(
    aggregates: DataFrame, points: DataFrame | PointTable, broadcast: bool | None = None
) -> DataFrame:
    """Inner join on the series; one row per matching point.

    A dimension of checked size is broadcast; ``broadcast`` hands in a check made
    before. Another one is joined by shuffle and sort, where Spark splits hot
    series at run time in batch; there is one row per series and window on that side. The aggregates are never broadcast: window expansion
    makes them far larger than the files that Spark estimates their size from.
    Aggregates are joined, not samples, so there is one row per series and window. A
    :class:`~seriesmill.sources.point_table.PointTable` is joined by its buckets: only the aggregates are
    shuffled, and not even those where they are by series in as many partitions.
    """
    if isinstance(points, PointTable):
        dealt = points.dealt(aggregates)
        return dealt.join(points.frame.hint("merge"), points.keys, "inner").drop(PART)
    if broadcast is None:
        broadcast = fits_broadcast(points)
    side = points.select(*POINT_FIELDS)
    side = F.broadcast(side) if broadcast else side.hint("merge")
    return aggregates.join(side, SERIES_KEY, "inner")


def unmatched_series(
    aggregates: DataFrame, points: DataFrame | PointTable, broadcast: bool | None = None
) -> DataFrame:
    """Aggregates that :func:`enrich` drops because no point has their series."""
    if isinstance(points, PointTable):
        points, broadcast = points.points, False
    if broadcast is None:
        broadcast = fits_broadcast(points)
    side = points.select(SERIES_KEY)
    side = F.broadcast(side) if broadcast else side.hint("merge")
    return aggregates.join(side, SERIES_KEY, "left_anti")


def to_output(enriched: DataFrame, stat: str) -> DataFrame:
    """The published record: point, window and statistics, in record order."""
    return enriched.select(
        *POINT_FIELDS,
        F.col("windowEnd").alias("timestampAggregate"),
        F.col("windowStart").alias("timestampStartOfWindow"),
        F.col("windowEnd").alias("timestampEndOfWindow"),
        *BASIC_COLUMNS,
        STAT_COLUMN[stat],
    )
