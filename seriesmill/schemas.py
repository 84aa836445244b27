"""Record types shared by every operator."""

from pyspark.sql import types as T

# Field names and order of the public records.
POINT_FIELDS = (
    "pointId",
    "pointType",
    "pointName",
    "timeseriesId",
    "chillerId",
    "chillerName",
    "siteId",
    "siteName",
    "customerId",
    "customerName",
)
SAMPLE_FIELDS = (
    ("id", T.StringType()),
    ("timeseriesId", T.StringType()),
    ("value", T.DoubleType()),
    ("timestamp", T.TimestampType()),
    ("metric", T.StringType()),
    ("timeOffset", T.StringType()),
    ("unixTimestamp", T.LongType()),
    ("ingestUnixTimestamp", T.LongType()),
)
# Two sample fields have another name on the wire.
WIRE_NAMES = {"value": "val", "metric": "Metric"}
# Fixed value: timestamps on the wire are UTC with milliseconds.
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

SERIES_KEY = "timeseriesId"
INGEST_TIME = "ingestUnixTimestamp"

SENSOR_POINT = T.StructType([T.StructField(name, T.StringType()) for name in POINT_FIELDS])

SENSOR_SAMPLE = T.StructType([T.StructField(name, kind) for name, kind in SAMPLE_FIELDS])

WIRE = T.StructType(
    [T.StructField(WIRE_NAMES.get(name, name), kind) for name, kind in SAMPLE_FIELDS]
)

REJECT = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("rejectReason", T.StringType())]
)


# Names, order and types of the published records.
def _aggregate_record(last_field: str) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in POINT_FIELDS]
    fields += [
        T.StructField(name, T.TimestampType())
        for name in ("timestampAggregate", "timestampStartOfWindow", "timestampEndOfWindow")
    ]
    fields.append(T.StructField("countOfSamples", T.LongType()))
    fields += [
        T.StructField(name, T.DoubleType())
        for name in (
            "minValOfSamples",
            "maxValOfSamples",
            "avgValOfSamples",
            "sumValOfSamples",
            last_field,
        )
    ]
    return T.StructType(fields)


WINDOW_AGGREGATE = _aggregate_record("stddevValOfSamples")
INTERVAL_AGGREGATE = _aggregate_record("delta")

SAMPLE_COLUMNS = SENSOR_SAMPLE.fieldNames()
