"""Counts of running queries, restarts, and what hot series cost a stateful stream."""

import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from builders import points_frame, rows_of, sample, samples_frame
from seriesmill.operators.sliding import sliding_aggregates
from seriesmill.plans.jobs import run_last_known_value_job, run_sliding_job, run_sliding_updates_job
from seriesmill.sources.sinks import read_latest, read_versions, table_sink
from seriesmill.streaming.supervise import RunCounts, run_supervised
from test_streaming import RECORD_KEY, Feed, windows_of

SECOND = 1 / 60  # in minutes


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def points(spark):
    return points_frame(spark, [("Pa", "a"), ("Pb", "b")])


@pytest.fixture
def counts(spark):
    listener = RunCounts()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def until(condition, seconds=60):
    end = time.monotonic() + seconds
    while not condition():
        assert time.monotonic() < end, "waited in vain"
        time.sleep(0.1)


def test_counts_of_published_and_dropped_rows(feed, points, counts, tmp_path):
    feed.add(("a", 1, 10), ("b", 2, 100_000))
    feed.add(("a", 3, 100_010))
    feed.add(("b", 4, 20), ("a", 5, 100_020))  # the first is far beyond the watermark by then
    out = str(tmp_path / "out")
    (query,) = run_sliding_updates_job(
        feed.stream(), points, table_sink(out), [1], 1, lateness=1, checkpoint=str(tmp_path), drain=True, name="late"
    )
    query.awaitTermination()
    until(lambda: counts.of("late_60").samples == 5)
    seen = counts.of("late_60")
    assert seen.dropped == 1 and seen.starts == 1 and seen.failures == 0
    until(lambda: counts.of("late_60").published == read_versions(feed.spark, out).count())


def test_several_triggers_with_a_failing_batch(feed, points, counts, tmp_path):
    out, stop, calls, runs = str(tmp_path / "out"), threading.Event(), [], []

    def clock():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("the clock is away")
        return 100_000 + 60 * len(calls)

    feed.add(("a", 1, 10), ("b", 2, 20))

    def job():
        query = run_sliding_job(
            feed.stream(), points, table_sink(out), [0.1], SECOND, checkpoint=str(tmp_path / "c"), clock=clock, name="panes"
        )
        runs.append(query)
        return query

    ended = []
    worker = threading.Thread(target=lambda: ended.append(run_supervised(job, pause=0.1, stop=stop)))
    worker.start()
    try:
        until(lambda: counts.of("panes").samples >= 2)
        feed.add(("a", 3, 70), ("a", 4, 130))  # fails once
        until(lambda: counts.of("panes").failures == 1)
        until(lambda: counts.of("panes").samples >= 4)
        feed.add(("b", 5, 15))
        until(lambda: counts.of("panes").batches >= 3)
    finally:
        stop.set()
        worker.join(60)
    assert len(ended) == 1 and len(runs) == 2 and not ended[0].isActive
    got = windows_of(read_latest(feed.spark, out, RECORD_KEY))
    expected = sliding_aggregates(feed.table(), [0.1], SECOND).withColumn("end", F.unix_seconds("windowEnd"))
    assert got == rows_of(expected, "timeseriesId", "end", "countOfSamples", "sumValOfSamples")
    totals = ended[0].publisher.totals
    versions = read_versions(feed.spark, out)
    assert totals["rows"] == versions.count()
    first = versions.groupBy(*RECORD_KEY).count().where("count > 1").count()
    assert totals["again"] >= first > 0


def test_gives_up_after_failures_in_a_row(feed, points, tmp_path):
    feed.add(("a", 1, 10))
    runs = []

    def clock():
        raise OSError("the clock is away")

    def job():
        runs.append(1)
        out = table_sink(str(tmp_path / "out"))
        return run_sliding_job(feed.stream(), points, out, [3], 1, checkpoint=str(tmp_path / "c"), clock=clock, drain=True)

    with pytest.raises(StreamingQueryException):
        run_supervised(job, restarts=2, pause=0)
    assert len(runs) == 3

    def wrong():
        runs.append(1)
        raise ValueError("no such folder")

    with pytest.raises(ValueError):
        run_supervised(wrong, pause=0)
    assert len(runs) == 4


def test_hot_series_reach_the_state_as_one_row_a_task(spark, tmp_path):
    """Two thirds of all samples are of one series; each task hands on a row for it, and state keeps one."""
    rows = [("hot" if i % 3 else f"s{i % 7}", i, i) for i in range(3000)]
    samples_frame(spark, [sample(*r) for r in rows]).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(samples_frame(spark, []).schema).parquet(str(tmp_path / "in"))
    query = run_last_known_value_job(stream, table_sink(str(tmp_path / "out")), checkpoint=str(tmp_path / "c"), drain=True)
    query.awaitTermination()
    plan = query._jsq.streamingQuery().lastExecution().executedPlan()
    written = []

    def look(node):
        if "Exchange" in node.nodeName():
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            look(node.children().apply(i))

    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert progress[0]["numInputRows"] == 3000
    assert progress[0]["stateOperators"][0]["numRowsTotal"] == 8
    look(plan)
    assert written and 8 <= max(written) <= 4 * 8
