"""Sensor samples and points as views over a star schema.

``events`` rows become samples and ``customer`` (or ``supplier``) rows become
points, so that every operator can run on tables any SQL engine can read too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.codec import with_sample_id
from seriesmill.schemas import POINT_FIELDS, SAMPLE_COLUMNS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utc_timestamp(wall: str) -> "F.Column":
    """A zone-less UTC wall time as a timestamp; needs a UTC session."""
    return F.col(wall).cast("timestamp")


def samples_from_events(events: DataFrame) -> DataFrame:
    moment = utc_timestamp("ts")
    seconds = F.unix_seconds(moment)
    samples = events.select(
        F.col("user_id").cast("string").alias("timeseriesId"),
        "value",
        F.date_trunc("millisecond", moment).alias("timestamp"),
        F.col("event_type").alias("metric"),
        F.lit("+00:00").alias("timeOffset"),
        seconds.alias("unixTimestamp"),
        seconds.alias("ingestUnixTimestamp"),
    )
    return with_sample_id(samples).select(*SAMPLE_COLUMNS)


def samples(
    spark: SparkSession, folder: str, since: int | None = None, until: int | None = None
) -> DataFrame:
    """All samples, or those of the seconds from ``since`` to before ``until``.

    The bounds are on the raw column, so they reach the scan.
    """
    events = table(spark, folder, "events")
    kind = events.schema["ts"].dataType
    for bound, compare in ((since, "__ge__"), (until, "__lt__")):
        if bound is not None:
            wall = dt.datetime.fromtimestamp(bound, dt.timezone.utc).replace(tzinfo=None)
            events = events.where(getattr(F.col("ts"), compare)(F.lit(str(wall)).cast(kind)))
    return samples_from_events(events)


def _sites(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        F.col("n_nationkey").cast("string").alias("siteId"),
        F.col("n_name").alias("siteName"),
        F.col("r_regionkey").cast("string").alias("customerId"),
        F.col("r_name").alias("customerName"),
    )


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per customer; covers every series of ``events``."""
    chiller = F.concat(F.col("c_nationkey").cast("string"), F.lit(":"), "c_mktsegment")
    owners = table(spark, folder, "customer").select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("pointId"),
        F.col("c_mktsegment").alias("pointType"),
        F.col("c_name").alias("pointName"),
        F.col("c_custkey").cast("string").alias("timeseriesId"),
        chiller.alias("chillerId"),
        F.concat(F.lit("Chiller "), chiller).alias("chillerName"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    return owners.join(_sites(spark, folder), "n_nationkey").select(*POINT_FIELDS)


def supplier_points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per supplier; fewer than the series, so some stay unmatched."""
    chiller = F.concat(F.col("s_nationkey").cast("string"), F.lit(":supply"))
    owners = table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("pointId"),
        F.lit("supply").alias("pointType"),
        F.col("s_name").alias("pointName"),
        F.col("s_suppkey").cast("string").alias("timeseriesId"),
        chiller.alias("chillerId"),
        F.concat(F.lit("Chiller "), chiller).alias("chillerName"),
        F.col("s_nationkey").alias("n_nationkey"),
    )
    return owners.join(_sites(spark, folder), "n_nationkey").select(*POINT_FIELDS)
