"""Sensor points as a table in buckets of the series, for dimensions too large to broadcast.

Aggregates are shuffled by series once, into as many partitions as there are buckets, and meet the points'
files there: the points are neither shuffled nor sorted again by any of the jobs that join them. With
``parts`` above 1 each point is stored that many times, once for each part of its series, and the
rows of a series are dealt to its parts, so that one with very many rows is joined by several tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.schemas import POINT_FIELDS, SERIES_KEY
from seriesmill.sources.notes import Note

PART = "seriesPart"


@dataclass(frozen=True)
class PointTable:
    """Points in ``buckets`` buckets; ``frame`` has each of them once for each of ``parts`` parts."""

    frame: DataFrame
    buckets: int
    parts: int

    @property
    def keys(self) -> list[str]:
        return [SERIES_KEY, PART] if self.parts > 1 else [SERIES_KEY]

    @property
    def points(self) -> DataFrame:
        """Each point once."""
        frame = self.frame.where(F.col(PART) == 0) if self.parts > 1 else self.frame
        return frame.select(*POINT_FIELDS)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """The rows with the part of their series they belong to, by all their plain columns but the series."""
        if self.parts == 1:
            return rows
        plain = [f.name for f in rows.schema if f.name != SERIES_KEY and f.dataType.typeName() in ("long", "timestamp")]
        if not plain:
            raise ValueError("rows without a number or time can't be dealt to parts")
        return rows.withColumn(PART, F.pmod(F.xxhash64(*plain), F.lit(self.parts)).cast("int"))


def write_point_table(points: DataFrame, path: str, buckets: int, parts: int = 1) -> PointTable:
    """Write the points below ``path`` in a new folder and name it there in one step.

    ``buckets`` should be ``spark.sql.shuffle.partitions`` of the jobs that join, so that aggregates by
    series are not shuffled again either. Points without a series join nothing and are left out.
    """
    if buckets < 1 or parts < 1:
        raise ValueError("at least one bucket and one part")
    spark, root = points.sparkSession, path.rstrip("/")
    folder = f"points-{uuid.uuid4().hex}"
    rows = points.select(*POINT_FIELDS).where(F.col(SERIES_KEY).isNotNull())
    keys = [SERIES_KEY]
    if parts > 1:
        rows = rows.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        keys.append(PART)
    name = _name(folder)
    writer = rows.repartition(buckets, *keys).write.format("parquet").option("path", f"{root}/{folder}")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    Note(spark, f"{root}/layout").write({"folder": folder, "buckets": buckets, "parts": parts})
    return read_point_table(spark, root)


def read_point_table(spark: SparkSession, path: str) -> PointTable:
    """The points last written below ``path``; other sessions' catalogs need not know them."""
    root = path.rstrip("/")
    layout = Note(spark, f"{root}/layout").value
    if layout is None:
        raise ValueError(f"no points below {path}")
    name, buckets, parts = _name(layout["folder"]), layout["buckets"], layout["parts"]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` string" for c in POINT_FIELDS)
        keys = f"`{SERIES_KEY}`" + (f", `{PART}`" if parts > 1 else "")
        columns += f", `{PART}` int" if parts > 1 else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys})"
            f" INTO {buckets} BUCKETS LOCATION '{root}/{layout['folder']}'"
        )
    return PointTable(spark.table(name), buckets, parts)


def _name(folder: str) -> str:
    return folder.replace("-", "_")
