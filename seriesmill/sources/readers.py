"""Scans: the sensor dimension, and samples from Kafka or files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from seriesmill.functions.codec import check_samples, decode_samples
from seriesmill.schemas import SENSOR_POINT, SENSOR_SAMPLE


@dataclass(frozen=True)
class SampleSource:
    """Where samples come from: ``kafka`` topics, or a ``json`` or ``parquet`` folder."""

    kind: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)


def kafka_source(
    brokers: str, *topics: str, starting_offsets: str = "latest", **options: str
) -> SampleSource:
    """One or several topics, read as one stream. Offsets live in the checkpoint."""
    if not topics:
        raise ValueError("at least one topic is needed")
    settings = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        **options,
    }
    return SampleSource("kafka", settings["subscribe"], settings)


def json_source(path: str, **options: str) -> SampleSource:
    """A folder of text files with one JSON sample per line."""
    return SampleSource("json", path, options)


def parquet_source(path: str, **options: str) -> SampleSource:
    """A folder of Parquet files with the sample columns."""
    return SampleSource("parquet", path, options)


def read_sensor_points(spark: SparkSession, path: str) -> DataFrame:
    """The dimension: one JSON object per line. A malformed line fails the read."""
    return spark.read.schema(SENSOR_POINT).option("mode", "FAILFAST").json(path)


def read_messages(spark: SparkSession, source: SampleSource, streaming: bool) -> DataFrame:
    """JSON messages in a ``value`` column; Kafka adds the arrival ``timestamp``."""
    reader = (spark.readStream if streaming else spark.read).options(**source.options)
    if source.kind == "kafka":
        return reader.format("kafka").load().selectExpr("cast(value as string) value", "timestamp")
    if source.kind == "json":
        return reader.format("text").load(source.location)
    raise ValueError(f"{source.kind!r} holds no messages")


def read_samples(
    spark: SparkSession,
    source: SampleSource,
    streaming: bool = False,
    arrival: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Samples and the rejected rows: messages that are no samples, rows with a null field.

    ``arrival="timestamp"`` keeps the Kafka record time as ``arrivalTime``, for
    windows by time of arrival instead of ingest time.
    """
    if source.kind == "parquet":
        reader = (spark.readStream if streaming else spark.read).options(**source.options)
        return check_samples(reader.schema(SENSOR_SAMPLE).parquet(source.location))
    return decode_samples(read_messages(spark, source, streaming), arrival)


def read_published_samples(spark: SparkSession, path: str) -> DataFrame:
    """The samples of a table that a last-known-value job has published, as a stream of its versions."""
    schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def drop_repeats(messages: DataFrame, delay: str = "1 day", time_col: str = "timestamp", key: str = "key") -> DataFrame:
    """Published messages without those that a repeated publication wrote again.

    In a stream a key is remembered for ``delay`` of the messages' own time. Equal messages of one
    publication are one; messages without a key are one another's repeats, so leave them out before.
    """
    if messages.isStreaming:
        return messages.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])
    return messages.dropDuplicates([key])
