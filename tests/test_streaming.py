import json
import time

import pytest
from pyspark.sql import functions as F

from builders import points_frame, rows_of, sample, samples_frame
from seriesmill.functions.codec import encode_records, encode_samples, with_message_key
from seriesmill.operators.lastvalue import last_known_value
from seriesmill.operators.sliding import sliding_aggregates, windowed_aggregates
from seriesmill.plans.jobs import (
    interval_report,
    run_ingest_job,
    run_interval_job,
    run_last_known_value_job,
    run_lookback_job,
    run_sliding_job,
    run_sliding_updates_job,
)
from seriesmill.schemas import SAMPLE_COLUMNS
from seriesmill.sources.dated import DAY, DatedTable
from seriesmill.sources.readers import (
    drop_repeats,
    json_source,
    kafka_source,
    parquet_source,
    read_messages,
    read_samples,
)
from seriesmill.sources.sinks import (
    checkpoint_for,
    json_sink,
    kafka_sink,
    memory_sink,
    parquet_sink,
    read_latest,
    read_snapshot,
    table_sink,
    write_batch,
)
from seriesmill.streaming.windows import streaming_interval_aggregates

RECORD_KEY = ("pointId", "timestampStartOfWindow", "timestampEndOfWindow")


class Feed:
    """A folder of sample files, one per call, read one per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.rows = spark, folder / "in", []

    def add(self, *rows):
        staged = self.folder.parent / f"staged-{len(list(self.folder.parent.iterdir()))}"
        samples_frame(self.spark, list(rows)).coalesce(1).write.parquet(str(staged))
        self.folder.mkdir(exist_ok=True)
        time.sleep(0.02)  # files are read in order of their time stamps
        (part,) = staged.glob("part-*.parquet")
        (self.folder / f"{staged.name}.parquet").write_bytes(part.read_bytes())
        self.rows += rows

    def stream(self):
        source = parquet_source(str(self.folder), maxFilesPerTrigger="1")
        return read_samples(self.spark, source, streaming=True)[0]

    def table(self):
        return samples_frame(self.spark, self.rows)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def points(spark):
    return points_frame(spark, [("Pa", "a"), ("Pb", "b")])


def finish(*queries):
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None
    return queries


def windows_of(frame):
    seconds = frame.withColumn("end", F.unix_seconds("timestampEndOfWindow"))
    return rows_of(seconds, "timeseriesId", "end", "countOfSamples", "sumValOfSamples")


def test_stream_equals_batch(feed, points, tmp_path):
    feed.add(("a", 1, 10), ("b", 2, 20))
    feed.add(("a", 3, 70), ("a", 4, 130))
    feed.add(("b", 5, 15), ("a", 6, 200))
    out = str(tmp_path / "out")
    job = run_sliding_updates_job(
        feed.stream(), points, table_sink(out), [3], 1, checkpoint=str(tmp_path), drain=True
    )
    finish(*job)
    got = windows_of(read_latest(feed.spark, out, RECORD_KEY))
    batch = sliding_aggregates(feed.table(), [3], 1)
    expected = batch.withColumn("end", F.unix_seconds("windowEnd"))
    assert got == rows_of(expected, "timeseriesId", "end", "countOfSamples", "sumValOfSamples")


def test_several_windows_run_as_queries_of_their_own(feed, points, tmp_path):
    feed.add(("a", 1, 10), ("b", 2, 20))
    out = str(tmp_path / "out")
    job = run_sliding_updates_job(
        feed.stream(), points, table_sink(out), [1, 2], 1, checkpoint=str(tmp_path), drain=True
    )
    assert len({q.name for q in finish(*job)}) == 2
    assert read_latest(feed.spark, f"{out}/window_60", RECORD_KEY).count() == 2
    assert read_latest(feed.spark, f"{out}/window_120", RECORD_KEY).count() == 4


def test_published_rows_are_counted(feed, points, tmp_path):
    feed.add(("a", 1, 10))
    (query,) = finish(
        *run_sliding_updates_job(
            feed.stream(),
            points,
            table_sink(str(tmp_path / "out")),
            [2],
            1,
            checkpoint=str(tmp_path),
            drain=True,
        )
    )
    counts = [p.observedMetrics["published"].rows for p in query.recentProgress if p.observedMetrics]
    assert sum(counts) == 2


def test_late_samples_always_correct_their_interval(feed, points, tmp_path):
    feed.add(("a", 1, 70))
    feed.add(("a", 2, 4000))
    feed.add(("a", 4, 3800))
    feed.add(("a", 8, 4100))
    feed.add(("a", 16, 6))  # more than an hour late
    feed.add(("a", 32, 4200), ("a", 64, 4500))  # the last one's interval hasn't ended
    out = str(tmp_path / "out")
    job = run_interval_job(
        feed.stream(), points, table_sink(out), [5], 5, checkpoint=str(tmp_path), drain=True, clock=lambda: 4600
    )
    (query,) = finish(*job)
    got = windows_of(read_latest(feed.spark, out, RECORD_KEY))
    assert got == [("a", 300, 2, 17.0), ("a", 3900, 1, 4.0), ("a", 4200, 2, 10.0), ("a", 4500, 1, 32.0)]
    assert query.publisher.published == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_late_sample_corrects_the_delta(feed, points, tmp_path):
    feed.add(("a", 10, 100), ("a", 13, 200))
    feed.add(("a", 4, 50))
    out = str(tmp_path / "out")
    sink = table_sink(out)
    finish(
        *run_interval_job(
            feed.stream(), points, sink, [5], 5, checkpoint=str(tmp_path), drain=True
        )
    )
    assert rows_of(read_latest(feed.spark, out, RECORD_KEY), "delta", "countOfSamples") == [(9.0, 3)]
    versions = feed.spark.read.parquet(out)
    assert rows_of(versions, "batch", "delta") == [(0, 3.0), (1, 9.0)]


def test_interval_lengths_must_fit_the_period(feed):
    feed.add(("a", 1, 10))
    for frequency, period, slide in [(10, 5, 300), (5, 10, 300)]:
        rows = streaming_interval_aggregates(feed.table(), frequency, period, 60)
        expected = windowed_aggregates(feed.table(), frequency, slide / 60, "delta")
        assert rows.exceptAll(expected).count() == 0 and rows.count() == expected.count()
    with pytest.raises(ValueError):
        streaming_interval_aggregates(feed.table(), 7, 5, 60)


def test_restart_goes_on_where_it_stopped(feed, points, tmp_path):
    out = str(tmp_path / "out")

    def run():
        finish(
            *run_sliding_updates_job(
                feed.stream(), points, table_sink(out), [3], 1, checkpoint=str(tmp_path), drain=True
            )
        )
        return windows_of(read_latest(feed.spark, out, RECORD_KEY))

    feed.add(("a", 1, 10), ("b", 2, 20))
    assert ("a", 60, 1, 1.0) in run()
    feed.add(("a", 3, 50), ("a", 4, 130))
    got = run()
    batch = sliding_aggregates(feed.table(), [3], 1).withColumn("end", F.unix_seconds("windowEnd"))
    assert got == rows_of(batch, "timeseriesId", "end", "countOfSamples", "sumValOfSamples")


def last_values(frame):
    return rows_of(frame, "timeseriesId", "value", "ingestUnixTimestamp")


def test_last_known_value_stream(feed, tmp_path):
    feed.add(("a", 1, 100), ("b", 2, 100))
    feed.add(("a", 3, 200))
    feed.add(("a", 4, 150))  # the last file holds an old row
    for mode, read in [
        ("update", lambda path: read_latest(feed.spark, path, ("timeseriesId",))),
        ("complete", lambda path: read_snapshot(feed.spark, path)),
    ]:
        out = str(tmp_path / mode)
        query = run_last_known_value_job(
            feed.stream(),
            table_sink(out),
            mode=mode,
            checkpoint=str(tmp_path),
            drain=True,
            name=f"lkv_{mode}",
        )
        finish(query)
        assert last_values(read(out)) == last_values(last_known_value(feed.table()))
    changes = feed.spark.read.parquet(str(tmp_path / "update"))
    assert rows_of(changes.where("batch = 1"), "timeseriesId") == [("a",)]
    everything = feed.spark.read.parquet(str(tmp_path / "complete"))
    assert rows_of(everything.where("batch = 1"), "timeseriesId") == [("a",), ("b",)]


def test_last_known_values_outlive_their_checkpoint(feed, tmp_path):
    spark, one, two = feed.spark, str(tmp_path / "one"), str(tmp_path / "two")
    feed.add(("a", 1, 100), ("b", 2, 100))
    feed.add(("a", 3, 200))
    finish(run_last_known_value_job(feed.stream(), table_sink(one), mode="update", checkpoint=str(tmp_path / "c1"), drain=True))
    later = Feed(spark, tmp_path / "later")
    later.folder.parent.mkdir()
    later.add(("b", 5, 300), ("a", 9, 150))  # older than what is known of a
    for mode, read in [("complete", read_snapshot), ("update", lambda s, p: read_latest(s, p, ("timeseriesId",)))]:
        job = run_last_known_value_job(
            later.stream(), table_sink(two + mode), mode=mode, checkpoint=str(tmp_path / f"c2{mode}"), drain=True, restore=one
        )
        finish(job)
        assert last_values(read(spark, two + mode)) == [("a", 3.0, 200), ("b", 5.0, 300)]
    with pytest.raises(ValueError, match="must not"):
        run_last_known_value_job(later.stream(), table_sink(one), restore=one)


def run_panes(feed, points, tmp_path, sink, clock=None, folder="checkpoint", table=None):
    query = run_sliding_job(
        feed.stream(),
        points,
        sink,
        windows=[1, 5],
        period=1,
        pane_table=table,
        checkpoint=str(tmp_path / folder),
        drain=True,
        clock=clock or time.time,
    )
    finish(query)
    return query


def batch_windows(feed, windows=(1, 5), until=None):
    rows = sliding_aggregates(feed.table(), list(windows), 1).withColumn("end", F.unix_seconds("windowEnd"))
    rows = rows if until is None else rows.where(F.col("end") <= until)
    return rows_of(rows, "timeseriesId", "end", "countOfSamples", "sumValOfSamples")


def test_pane_job_equals_batch_and_survives_a_restart(feed, points, tmp_path):
    out = str(tmp_path / "out")
    feed.add(("a", 1, 10), ("b", 2, 20), ("a", 2, 15))
    feed.add(("a", 3, 130), ("a", 4, 70))
    feed.add(("b", 5, 400))
    run_panes(feed, points, tmp_path, table_sink(out))
    feed.add(("a", 6, 410), ("a", 7, 3000))  # a gap longer than any window
    feed.add(("b", 8, 3100), ("a", 9, 3200), ("a", 1, 12))  # one row is very late
    feed.add(("b", 8, 3300))
    run_panes(feed, points, tmp_path, table_sink(out))
    assert windows_of(read_latest(feed.spark, out, RECORD_KEY)) == batch_windows(feed)


def test_windows_are_due_without_new_samples(feed, points, tmp_path):
    out = str(tmp_path / "out")
    feed.add(("a", 1, 10), ("b", 2, 200))
    query = run_panes(feed, points, tmp_path, table_sink(out), clock=lambda: 130)
    assert windows_of(read_latest(feed.spark, out, RECORD_KEY)) == batch_windows(feed, until=120)
    query.publisher.publish(as_of=250)
    assert windows_of(read_latest(feed.spark, out, RECORD_KEY)) == batch_windows(feed, until=240)
    query.publisher.publish(as_of=100_000)
    query.publisher.publish(as_of=100_001)
    assert windows_of(read_latest(feed.spark, out, RECORD_KEY)) == batch_windows(feed)
    assert len(query.publisher.published) == 3


def test_a_new_checkpoint_counts_no_sample_twice(feed, points, tmp_path):
    table = str(tmp_path / "panes")
    feed.add(("a", 1, 10), ("b", 2, 20))
    feed.add(("a", 3, 130))
    run_panes(feed, points, tmp_path, table_sink(str(tmp_path / "one")), folder="c1", table=table)
    run_panes(feed, points, tmp_path, table_sink(str(tmp_path / "two")), folder="c2", table=table)
    assert windows_of(read_latest(feed.spark, str(tmp_path / "two"), RECORD_KEY)) == batch_windows(feed)
    with pytest.raises(Exception, match="another run"):
        run_panes(feed, points, tmp_path, table_sink(str(tmp_path / "two")), folder="c3", table=table)


def test_a_repeated_batch_is_published_once(feed, points, tmp_path):
    out = str(tmp_path / "out")
    feed.add(("a", 1, 10), ("b", 2, 20))
    query = run_panes(feed, points, tmp_path, json_sink(out))
    before = sorted(r.value for r in feed.spark.read.text(out).collect())
    query.publisher.on_batch(feed.table(), 0)
    assert sorted(r.value for r in feed.spark.read.text(out).collect()) == before
    fresh = run_panes(feed, points, tmp_path, json_sink(out)).publisher
    fresh.on_batch(feed.table(), 0)  # also after a restart
    assert sorted(r.value for r in feed.spark.read.text(out).collect()) == before


def test_days_before_the_horizon_are_removed(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), "s", lambda rows: rows, ["k"])
    rows = spark.createDataFrame([("a", 10), ("a", DAY + 5), ("a", 3 * DAY)], "k string, s long")
    assert table.append(rows, 0) == (10, 3 * DAY)
    assert table.remove_days(2 * DAY) == 2
    assert rows_of(table.read(0), "s") == [(3 * DAY,)]
    assert table.read(0, 0, DAY) is None
    assert table.append(rows.limit(0), 1) is None
    assert rows_of(DatedTable(spark, str(tmp_path / "t"), "s", lambda rows: rows, ["k"]).read(1), "s") == [(3 * DAY,)]


def test_ingest_writes_both_streams_and_parses_once(spark, tmp_path):
    encode_samples(samples_frame(spark, [("a", 1, 10)])).write.text(str(tmp_path / "in"))
    spark.createDataFrame([("junk",)], "value string").write.mode("append").text(str(tmp_path / "in"))
    messages = read_messages(spark, json_source(str(tmp_path / "in")), streaming=True)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    finish(run_ingest_job(messages, parquet_sink(good), json_sink(bad), checkpoint=str(tmp_path), drain=True))
    assert rows_of(spark.read.parquet(good), "timeseriesId", "value") == [("a", 1.0)]
    assert "junk" in spark.read.text(bad).first().value


def test_lookback_job_recomputes_every_interval_in_each_batch(feed, points, tmp_path):
    out, base = str(tmp_path / "out"), 200_000

    def run(now):
        query = run_lookback_job(
            feed.stream(),
            points,
            table_sink(out),
            frequencies=[7, 15],
            period=5,
            checkpoint=str(tmp_path),
            drain=True,
            clock=lambda: now + 17,  # not on a multiple of the period
        )
        finish(query)

    def report(batch):
        rows = feed.spark.read.parquet(out).where(F.col("batch") == batch).drop("batch")
        return sorted(map(tuple, rows.collect()))

    def expected(now):
        return sorted(map(tuple, interval_report(feed.table(), points, now, [7, 15]).collect()))

    base -= base % 300
    feed.add(("a", 1, base - 100), ("b", 2, base - 890), ("a", 4, base - 2000), ("a", 64, base + 1))
    run(base)
    assert report(0) == expected(base) and len(report(0)) == 4
    feed.add(("a", 8, base - 150), ("b", 16, base + 200))  # late, and on time
    run(base + 300)
    assert report(1) == expected(base + 300)
    feed.add(("a", 32, 10))  # a day no batch reads
    run(base + 90_000)
    assert feed.spark.read.parquet(out).where("batch = 2").count() == 0


def test_json_folder_stream_with_rejects(spark, tmp_path):
    encode_samples(samples_frame(spark, [("a", 1, 10)])).write.text(str(tmp_path / "in"))
    spark.createDataFrame([("junk",)], "value string").write.mode("append").text(str(tmp_path / "in"))
    source = json_source(str(tmp_path / "in"))
    good, rejects = read_samples(spark, source)
    assert (good.count(), rejects.count()) == (1, 1)
    stream, _ = read_samples(spark, source, streaming=True)
    out = str(tmp_path / "out")
    finish(run_last_known_value_job(stream, table_sink(out), checkpoint=str(tmp_path), drain=True))
    assert last_values(read_latest(spark, out, ("timeseriesId",))) == [("a", 1.0, 10)]


def test_complete_mode_to_memory(feed):
    feed.add(("a", 1, 100))
    query = run_last_known_value_job(
        feed.stream(), memory_sink("lkv_memory"), mode="complete", drain=True, name="lkv_mem"
    )
    finish(query)
    assert last_values(feed.spark.table("lkv_memory")) == [("a", 1.0, 100)]


def test_append_mode_publishes_json_messages(feed, points, tmp_path):
    feed.add(("a", 1, 10))
    feed.add(("a", 2, 1000))
    feed.add(("a", 3, 2000))
    out = str(tmp_path / "out")
    finish(
        *run_sliding_updates_job(
            feed.stream(),
            points,
            json_sink(out),
            [1],
            1,
            mode="append",
            checkpoint=str(tmp_path),
            drain=True,
        )
    )
    texts = [json.loads(r.value) for r in feed.spark.read.text(out).collect()]
    first = min(texts, key=lambda t: t["timestampAggregate"])
    assert first["timestampAggregate"] == "1970-01-01T00:01:00.000Z"
    assert first["countOfSamples"] == 1 and first["stddevValOfSamples"] is None


def test_batch_sinks(spark, tmp_path):
    frame = samples_frame(spark, [sample("a", 1, 10)])
    write_batch(frame, parquet_sink(str(tmp_path / "p")))
    assert read_samples(spark, parquet_source(str(tmp_path / "p")))[0].count() == 1
    write_batch(frame, json_sink(str(tmp_path / "j")), encode=encode_samples)
    good, _ = read_samples(spark, json_source(str(tmp_path / "j")))
    assert good.collect() == frame.select(*SAMPLE_COLUMNS).collect()
    with pytest.raises(ValueError):
        write_batch(frame, memory_sink("x"))


def test_repeated_publications_have_the_same_keys(spark):
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "pointId string, n long")
    first, again, other = (with_message_key(encode_records(rows), n) for n in (4, 4, 5))
    assert rows_of(first, "key") == rows_of(again, "key") != rows_of(other, "key")
    both = first.unionByName(again).unionByName(other)
    assert rows_of(drop_repeats(both), "value") == sorted(rows_of(first, "value") * 2)


def test_kafka_options(spark):
    source = kafka_source("h:9092", "samples", "lastKnown")
    assert source.options["subscribe"] == "samples,lastKnown"
    assert source.options["startingOffsets"] == "latest"
    assert source.options["kafka.bootstrap.servers"] == "h:9092"
    sink = kafka_sink("h:9092", "aggregates")
    assert sink.options == {"kafka.bootstrap.servers": "h:9092", "topic": "aggregates"}
    with pytest.raises(ValueError):
        kafka_source("h:9092")
    with pytest.raises(ValueError):
        read_messages(spark, parquet_source("x"), False)


def test_checkpoints_are_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_for(spark, "q") == f"{root}/q"
