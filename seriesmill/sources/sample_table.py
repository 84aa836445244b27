"""A table of samples laid out for ranges: by day, within a day by series and time.

Batches are appended and merged as :mod:`seriesmill.sources.dated` says, so a day has a bounded number of
folders however many batches there were. In each of them files are ranges of series and time, sorted, so
the minima and maxima of their row groups tell which of them hold a series; where batches are small and a file
has all series, Bloom filters do. A series with a large share of a day is cut by time, not kept in one file.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.timeunits import epoch_seconds
from seriesmill.schemas import INGEST_TIME, SAMPLE_COLUMNS, SENSOR_SAMPLE, SERIES_KEY
from seriesmill.sources.dated import DatedTable
from seriesmill.sources.notes import path_of

RUN = "run="
#: More than any batch's number.
ALL_BATCHES = 1 << 62
#: Row groups are small, as a range is mostly a small part of a file.
LAYOUT = {
    "parquet.block.size": str(16 * 1024 * 1024),
    f"parquet.bloom.filter.enabled#{SERIES_KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


class SampleTable:
    """What one writer has added to the table at ``path``; batches are numbered within a ``run``.

    A batch that is appended again replaces itself. Another run, such as that of a new checkpoint, must have
    another name. One process writes a run; :func:`read_sample_table` reads all of them.
    """

    def __init__(self, spark: SparkSession, path: str, run: str = "load"):
        self._table = DatedTable(
            spark,
            f"{path.rstrip('/')}/{RUN}{run}",
            INGEST_TIME,
            lambda rows: rows,
            sorted_by=(SERIES_KEY, INGEST_TIME),
            options=LAYOUT,
        )

    def append(self, samples: DataFrame, batch_id: int) -> None:
        """Add checked samples; rows without a series or time belong to the rejects and are left out."""
        columns = samples.select(*SAMPLE_COLUMNS)
        known = F.col(SERIES_KEY).isNotNull() & F.col(INGEST_TIME).isNotNull()
        self._table.append(columns.where(known), batch_id)

    def compact(self, before_batch: int) -> int:
        """Merge folders of batches that can't run again; returns how many were merged."""
        return self._table.compact(before_batch)

    def remove_days(self, before: int | dt.datetime) -> int:
        return self._table.remove_days(epoch_seconds(before))

    def read(self, since: int | None = None, until: int | None = None) -> DataFrame | None:
        return self._table.read(ALL_BATCHES, since, until)


def _runs(spark: SparkSession, path: str) -> list[str]:
    root, files = path_of(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
    return sorted(n.removeprefix(RUN) for n in names if n.startswith(RUN))


def read_sample_table(
    spark: SparkSession,
    path: str,
    start: int | dt.datetime | None = None,
    end: int | dt.datetime | None = None,
    series: Sequence[str] | None = None,
) -> DataFrame:
    """Samples with ``start <= ingest second < end``, all or those of some series; no rows if there are none.

    Only folders of the days between are listed; bounds and series reach the scan, which skips the row
    groups that can't hold them.
    """
    low = None if start is None else epoch_seconds(start)
    high = None if end is None else epoch_seconds(end)
    last = None if high is None else high - 1
    parts = [SampleTable(spark, path, run).read(low, last) for run in _runs(spark, path)]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], SENSOR_SAMPLE)
    rows = reduce(DataFrame.unionByName, parts)
    seconds = F.col(INGEST_TIME)
    if low is not None:
        rows = rows.where(seconds >= low)
    if high is not None:
        rows = rows.where(seconds < high)
    return rows if series is None else rows.where(F.col(SERIES_KEY).isin(*series))
