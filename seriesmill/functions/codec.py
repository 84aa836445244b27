"""JSON messages to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.schemas import SAMPLE_COLUMNS, WIRE, WIRE_NAMES, WIRE_TIMESTAMP_FORMAT

READ_OPTIONS = {
    "timestampFormat": WIRE_TIMESTAMP_FORMAT,
    "timeZone": "UTC",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
}
WRITE_OPTIONS = {
    "timestampFormat": WIRE_TIMESTAMP_FORMAT,
    "timeZone": "UTC",
    "ignoreNullFields": "false",
}
_PARSED = T.StructType([*WIRE.fields, T.StructField("_malformed", T.StringType())])


def with_sample_id(samples: DataFrame) -> DataFrame:
    """Set ``id`` to ``timeseriesId:metric:unixTimestamp``; NULL if a part is NULL."""
    sample_id = F.concat(
        "timeseriesId", F.lit(":"), "metric", F.lit(":"), F.col("unixTimestamp").cast("string")
    )
    return samples.withColumn("id", sample_id)


def to_wire(samples: DataFrame) -> DataFrame:
    return samples.withColumnsRenamed(WIRE_NAMES)


def from_wire(samples: DataFrame) -> DataFrame:
    return samples.withColumnsRenamed({wire: name for name, wire in WIRE_NAMES.items()})


def parse_samples(messages: DataFrame, arrival: str | None = None) -> DataFrame:
    """Parse the JSON text in ``value`` and say why a message is unusable.

    Result: the sample columns, the message as ``raw``, ``rejectReason`` (NULL
    for a good sample) and, if ``arrival`` names a column holding the time at
    which the message arrived, that time as ``arrivalTime``.
    """
    kept = [F.col("value").alias("raw")]
    if arrival is not None:
        kept.append(F.col(arrival).alias("arrivalTime"))
    # inline() turns the struct into plain columns once. Reading struct fields
    # instead would let the optimizer copy from_json into every later predicate.
    parsed = messages.select(*kept).select(
        "*", F.inline(F.array(F.from_json("raw", _PARSED, READ_OPTIONS)))
    )
    missing = F.concat_ws(
        ",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in WIRE.fieldNames()]
    )
    blank = F.col("raw").isNull() | (F.trim("raw") == "")
    reason = F.when(F.col("_malformed").isNotNull() | blank, F.lit("malformed")).when(
        missing != "", F.concat(F.lit("missing: "), missing)
    )
    return from_wire(parsed.withColumn("rejectReason", reason).drop("_malformed"))


def decode_samples(
    messages: DataFrame, arrival: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split JSON messages into typed samples and rejects."""
    return split_parsed(parse_samples(messages, arrival), arrival)


def split_parsed(parsed: DataFrame, arrival: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Samples and rejects of what :func:`parse_samples` gave."""
    extra = ["arrivalTime"] if arrival is not None else []
    good = parsed.where(F.col("rejectReason").isNull()).select(*SAMPLE_COLUMNS, *extra)
    rejects = parsed.where(F.col("rejectReason").isNotNull()).select(
        F.col("raw").alias("value"), "rejectReason"
    )
    return good, rejects


def check_samples(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split typed rows into samples and rejects by the rule for messages: no field is null."""
    missing = F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in SAMPLE_COLUMNS])
    rejects = rows.where(missing != "").select(
        json_value(list(SAMPLE_COLUMNS)), F.concat(F.lit("missing: "), missing).alias("rejectReason")
    )
    return rows.where(missing == ""), rejects


def json_value(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), WRITE_OPTIONS).alias("value")


def encode_samples(samples: DataFrame) -> DataFrame:
    """One JSON message per sample, in the wire names."""
    return to_wire(samples.select(*SAMPLE_COLUMNS)).select(json_value(WIRE.fieldNames()))


def encode_records(records: DataFrame) -> DataFrame:
    """One JSON message per row, with the column names as they are."""
    return records.select(json_value(records.columns))


def with_message_key(messages: DataFrame, number: int) -> DataFrame:
    """Messages with a key that is the same whenever the publication of that number is written again."""
    return messages.select(F.concat(F.lit(f"{number}-"), F.sha2("value", 256)).alias("key"), "value")


def decode_records(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Read back what :func:`encode_records` wrote."""
    record = F.from_json("value", schema, READ_OPTIONS)
    return messages.select(F.inline(F.array(record)))
