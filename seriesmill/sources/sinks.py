"""Writers: Kafka, JSON or Parquet folders, a keyed table, and memory for tests."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesmill.functions.codec import encode_records, with_message_key
from seriesmill.functions.timeunits import interval_text
from seriesmill.sources.notes import path_of

BATCH_COLUMN = "batch"


@dataclass(frozen=True)
class Sink:
    kind: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)


def kafka_sink(brokers: str, topic: str, **options: str) -> Sink:
    """One JSON message per row; those of numbered publications have a key."""
    return Sink("kafka", topic, {"kafka.bootstrap.servers": brokers, "topic": topic, **options})


def json_sink(path: str) -> Sink:
    """A folder of text files, one JSON message per line."""
    return Sink("json", path)


def parquet_sink(path: str) -> Sink:
    """A folder of Parquet files with typed columns; append mode when streaming."""
    return Sink("parquet", path)


def table_sink(path: str) -> Sink:
    """Versions of rows, one folder per micro-batch; see :func:`read_latest`.

    A batch that is run again after a failure overwrites its own folder, so
    every batch counts once, also in update and complete mode.
    """
    return Sink("table", path)


def sample_table_sink(path: str) -> Sink:
    """A table of samples laid out for ranges, see :mod:`seriesmill.sources.sample_table`; for the ingest job."""
    return Sink("samples", path)


def memory_sink(name: str) -> Sink:
    """A table on the driver. For tests only."""
    return Sink("memory", name)


def write_batch(
    rows: DataFrame,
    sink: Sink,
    encode: Callable[[DataFrame], DataFrame] = encode_records,
    number: int | None = None,
) -> None:
    """Write the rows of a batch query. A failed write fails the caller.

    With a ``number`` files go to a folder of that number, which is replaced if it is there, so that a
    batch that runs again counts once; without one they are appended. Kafka gets them again, with the
    same keys, by which :func:`seriesmill.sources.readers.drop_repeats` tells them.
    """
    folder = sink.location if number is None else f"{sink.location}/{BATCH_COLUMN}={number}"
    mode = "append" if number is None else "overwrite"
    if sink.kind == "kafka":
        messages = encode(rows) if number is None else with_message_key(encode(rows), number)
        messages.write.format("kafka").options(**sink.options).save()
    elif sink.kind == "json":
        encode(rows).write.mode(mode).text(folder)
    elif sink.kind == "parquet":
        rows.write.mode(mode).parquet(folder)
    else:
        raise ValueError(f"no batch write to {sink.kind!r}")


def write_version(rows: DataFrame, path: str, batch_id: int) -> str:
    """Write one micro-batch as its own folder of a table and name that folder.

    Versions are told apart by number alone, and numbers begin again with a new checkpoint. So the
    first one is refused where later ones lie: those are of another run.
    """
    if batch_id == 0:
        root, files = path_of(rows.sparkSession, path)
        names = [status.getPath().getName() for status in files.listStatus(root)] if files.exists(root) else []
        if any(n.startswith(f"{BATCH_COLUMN}=") and n != f"{BATCH_COLUMN}=0" for n in names):
            raise ValueError(f"{path} has the versions of another run; name another folder")
    folder = f"{path}/{BATCH_COLUMN}={batch_id}"
    rows.write.mode("overwrite").parquet(folder)
    return folder


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(BATCH_COLUMN, F.col(BATCH_COLUMN).cast("bigint"))


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], where: Column | None = None
) -> DataFrame:
    """The newest version of each key in a table written by :func:`table_sink`.

    ``where`` restricts the versions read, such as by a range of their time; it must hold for all
    versions of a key or for none, and reaches the scan.
    """
    versions = read_versions(spark, path)
    if where is not None:
        versions = versions.where(where)
    # One sort after the shuffle: an aggregate of whole rows would be sorted on both sides of it.
    newer = F.lead(BATCH_COLUMN).over(Window.partitionBy(*keys).orderBy(BATCH_COLUMN))
    columns = [c for c in versions.columns if c != BATCH_COLUMN]
    return versions.withColumn("_newer", newer).where(F.col("_newer").isNull()).select(*columns)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The last micro-batch of a table written in complete mode."""
    versions = read_versions(spark, path)
    last = versions.agg(F.max(BATCH_COLUMN).alias(BATCH_COLUMN))
    return versions.join(F.broadcast(last), BATCH_COLUMN).drop(BATCH_COLUMN)


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """Folder of a query's checkpoint below the cluster's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or name a checkpoint")
    return f"{root.rstrip('/')}/{name}"


def start(
    rows: DataFrame,
    sink: Sink,
    name: str,
    mode: str,
    period_seconds: int,
    checkpoint: str | None = None,
    drain: bool = False,
    encode: Callable[[DataFrame], DataFrame] = encode_records,
) -> StreamingQuery:
    """Start writing a stream, one micro-batch per period.

    Published rows are counted in the query progress under ``published``. With
    ``drain`` the query takes what is there now and ends. A failed write ends
    the query; started again on its checkpoint it repeats the unfinished batch.
    """
    spark = rows.sparkSession
    rows = rows.observe("published", F.count(F.lit(1)).alias("rows"))
    if sink.kind in ("kafka", "json"):
        rows = encode(rows)
    writer = rows.writeStream.queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint or checkpoint_for(spark, name))
    if drain:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval_text(period_seconds))
    if sink.kind == "kafka":
        return writer.format("kafka").options(**sink.options).start()
    if sink.kind == "memory":
        return writer.format("memory").queryName(sink.location).start()
    if sink.kind == "table":
        return writer.foreachBatch(
            lambda batch, batch_id: write_version(batch, sink.location, batch_id)
        ).start()
    if sink.kind in ("json", "parquet") and mode != "append":
        # file sinks only append; a folder for each batch takes changed rows as well
        return writer.foreachBatch(
            lambda batch, batch_id: write_batch(batch, sink, lambda rows: rows, batch_id)
        ).start()
    formats = {"json": "text", "parquet": "parquet"}
    return writer.format(formats[sink.kind]).start(sink.location)
