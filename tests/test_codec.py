import datetime as dt
import json
import math

from builders import UTC, rows_of, sample, samples_frame
from seriesmill.functions.codec import (
    decode_records,
    decode_samples,
    encode_records,
    encode_samples,
    parse_samples,
    with_sample_id,
)
from seriesmill.functions.timeunits import (
    durations,
    epoch_seconds,
    floor_to,
    iso_instant,
    millis_to_seconds,
    minutes_to_seconds,
)
from seriesmill.schemas import SENSOR_SAMPLE, WINDOW_AGGREGATE
from pyspark.sql import functions as F
import pytest

GOOD = {
    "id": "a:Raw:10",
    "timeseriesId": "a",
    "val": 42.5,
    "timestamp": "2018-01-01T00:00:00.123Z",
    "Metric": "Raw",
    "timeOffset": "+00:00",
    "unixTimestamp": 10,
    "ingestUnixTimestamp": 11,
}


def messages(spark, *values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def changed(**fields):
    message = {**GOOD, **fields}
    return {k: v for k, v in message.items() if v is not ...}


def test_good_message(spark):
    good, rejects = decode_samples(messages(spark, GOOD, changed(extra=1)))
    assert good.schema == SENSOR_SAMPLE
    row = good.first()
    assert (row.value, row.metric, row.unixTimestamp, row.ingestUnixTimestamp) == (42.5, "Raw", 10, 11)
    moment = dt.datetime(2018, 1, 1, 0, 0, 0, 123000, UTC)
    assert good.select(F.unix_millis("timestamp")).first()[0] == int(moment.timestamp() * 1000)
    assert good.count() == 2 and rejects.count() == 0


@pytest.mark.parametrize(
    "message, reason",
    [
        ("no json", "malformed"),
        ("", "malformed"),
        (None, "malformed"),
        (changed(val=...), "missing: val"),
        (changed(Metric=..., metric="Raw"), "missing: Metric"),
        (changed(id=..., timeOffset=...), "missing: id,timeOffset"),
        (changed(timestamp="2018-01-01T00:00:00.123+05:30"), "malformed"),
        (changed(timestamp="2018-01-01T00:00:00Z"), "malformed"),
        (changed(unixTimestamp=1.5), "malformed"),
    ],
)
def test_rejects(spark, message, reason):
    good, rejects = decode_samples(messages(spark, message, GOOD))
    assert good.count() == 1
    raw = message if message is None or isinstance(message, str) else json.dumps(message)
    assert [tuple(r) for r in rejects.collect()] == [(raw, reason)]


def test_nan_is_a_value(spark):
    good, _ = decode_samples(messages(spark, changed(val="NaN")))
    assert math.isnan(good.first().value)
    back, rejects = decode_samples(encode_samples(good))
    assert math.isnan(back.first().value) and rejects.count() == 0


def test_zone_of_whole_hours_is_shifted(spark):
    good, _ = decode_samples(messages(spark, changed(timestamp="2018-01-01T05:00:00.000+05")))
    assert good.select(F.unix_seconds("timestamp")).first()[0] == 1514764800


def test_json_is_parsed_once(spark):
    good, _ = decode_samples(messages(spark, GOOD))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_wire_names_and_round_trip(spark):
    rows = [sample("a", 1.25, 1514764800), sample("b", -3, 1514764801)]
    frame = samples_frame(spark, rows)
    texts = [json.loads(r.value) for r in encode_samples(frame).collect()]
    assert list(texts[0]) == list(GOOD)
    assert texts[0]["timestamp"] == "2018-01-01T00:00:00.000Z"
    back, _ = decode_samples(encode_samples(frame))
    assert sorted(back.collect()) == sorted(frame.collect())


def test_encoding_does_not_depend_on_the_session_zone(spark):
    frame = samples_frame(spark, [sample("a", 1, 1514764800)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        text = json.loads(encode_samples(frame).first().value)
        assert text["timestamp"] == "2018-01-01T00:00:00.000Z"
        instant = frame.select(iso_instant(F.col("unixTimestamp"))).first()[0]
        assert instant == "2018-01-01T00:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_statistics_are_written(spark):
    row = ["p"] * 10 + [dt.datetime(2018, 1, 1, tzinfo=UTC)] * 3 + [1] + [2.0] * 4 + [None]
    frame = spark.createDataFrame([tuple(row)], WINDOW_AGGREGATE)
    text = encode_records(frame).first().value
    assert json.loads(text)["stddevValOfSamples"] is None
    assert list(json.loads(text)) == WINDOW_AGGREGATE.fieldNames()
    assert decode_records(encode_records(frame), WINDOW_AGGREGATE).collect() == frame.collect()


def test_sample_id(spark):
    frame = spark.createDataFrame(
        [("a", "Raw", 5), ("a", None, 5)], "timeseriesId string, metric string, unixTimestamp long"
    )
    assert [r.id for r in with_sample_id(frame).collect()] == ["a:Raw:5", None]


def test_arrival_time_is_kept(spark):
    frame = messages(spark, GOOD).withColumn("timestamp", F.timestamp_seconds(F.lit(77)))
    good, _ = decode_samples(frame, arrival="timestamp")
    assert good.select(F.unix_seconds("arrivalTime")).first()[0] == 77
    assert "raw" in parse_samples(frame).columns


def test_durations():
    assert minutes_to_seconds(0.5) == 30
    assert minutes_to_seconds(1.0099) == 60
    assert durations([60, 15, 60]) == [900, 3600]
    for bad in (0, -1, 0.001):
        with pytest.raises(ValueError):
            minutes_to_seconds(bad)
    with pytest.raises(ValueError):
        durations([])


def test_time_arithmetic(spark):
    frame = spark.createDataFrame([(-1, -1), (1999, 900), (900000, 901)], "ms long, s long")
    rows = rows_of(
        frame.select(
            millis_to_seconds(F.col("ms")).alias("a"), floor_to(F.col("s"), 900).alias("b")
        ),
        "a",
        "b",
    )
    assert rows == [(-1, -900), (1, 900), (900, 900)]
    assert epoch_seconds(dt.datetime(2018, 1, 1)) == 1514764800
    assert epoch_seconds(dt.datetime(1969, 12, 31, 23, 59, 59, 500000)) == -1
    assert epoch_seconds(7) == 7
