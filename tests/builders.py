"""Small sample and point frames."""

from __future__ import annotations

import datetime as dt

from seriesmill.schemas import POINT_FIELDS, SENSOR_POINT, SENSOR_SAMPLE

UTC = dt.timezone.utc


def sample(series, value, ingest, unix=None, metric="Raw", sample_id=None):
    unix = ingest if unix is None else unix
    return (
        sample_id or f"{series}:{metric}:{unix}",
        series,
        None if value is None else float(value),
        dt.datetime.fromtimestamp(unix, UTC),
        metric,
        "+00:00",
        unix,
        ingest,
    )


def samples_frame(spark, rows):
    return spark.createDataFrame([sample(*r) if len(r) <= 6 else r for r in rows], SENSOR_SAMPLE)


def point(name, series):
    values = dict.fromkeys(POINT_FIELDS, "x")
    values.update(pointId=name, timeseriesId=series)
    return tuple(values[f] for f in POINT_FIELDS)


def points_frame(spark, pairs):
    return spark.createDataFrame([point(*p) for p in pairs], SENSOR_POINT)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
