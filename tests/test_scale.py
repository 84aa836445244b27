"""Work that must not grow with the number of windows, sizes or tasks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from builders import points_frame, rows_of, samples_frame
from seriesmill.operators.enrich import enrich
from seriesmill.operators.sliding import expand_runs, merge_panes, pane_aggregates, pane_runs, sliding_aggregates
from seriesmill.plans.jobs import _LookbackPublisher, sliding_report
from seriesmill.sources.dated import DAY
from seriesmill.sources.sinks import read_latest
from seriesmill.streaming.panes import Publication, WindowPublisher

BASE = 1_700_000_000 // DAY * DAY
WINDOW = ("timeseriesId", "windowSeconds", "windowEnd")


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def samples(spark):
    return samples_frame(spark, [(s, float(i % 7), BASE + 1900 * i) for i in range(40) for s in "ab"])


def test_a_micro_batch_is_a_part_however_many_tasks_read_the_events(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    for third in range(3):
        rows = [
            (n, start + dt.timedelta(minutes=n), n % 50, "view", float(n), "{}")
            for n in range(700 * third, 700 * (third + 1))
        ]
        events = spark.createDataFrame(
            rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
        )
        events.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    seen = []

    def on_batch(batch, number):
        seen.append([r[0] for r in batch.select(F.col("unixTimestamp")).collect()])

    stream = entry._sample_stream(spark, str(tmp_path))
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(on_batch)
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == entry.STREAM_PARTS
    assert sorted(t for batch in seen for t in batch) == [1704067200 + 60 * n for n in range(2100)]
    for number, batch in enumerate(seen):
        parts = {(t - 1704067200) * entry.STREAM_PARTS // (2099 * 60 + 1) for t in batch}
        assert parts <= {number, max(0, number - 1)}


def test_newest_versions_by_one_sort(spark, tmp_path):
    rows = [("x", None, 1, 0), ("x", None, 2, 3), ("y", 5, 3, 1), ("y", 5, 4, 0), (None, 1, 6, 2)]
    table = spark.createDataFrame(rows, "k string, t long, v long, batch long")
    table.write.partitionBy("batch").parquet(str(tmp_path / "t"))
    got = read_latest(spark, str(tmp_path / "t"), ("k", "t"))
    assert executed(got).count("Sort [") == 1 and "SortAggregate" not in executed(got)
    assert sorted(r.v for r in got.collect()) == [2, 3, 6]
    assert got.columns == ["k", "t", "v"]


def test_statistics_are_finished_once_a_run(spark, samples):
    seen = []

    def finish(runs):
        seen.append(runs.count())
        return runs.withColumn("avgValOfSamples", F.round("avgValOfSamples", 1))

    rows = sliding_aggregates(samples, [60, DAY // 60], 15, finish=finish)
    assert 0 < seen[0] < rows.count()
    plain = sliding_aggregates(samples, [60, DAY // 60], 15).withColumn("avgValOfSamples", F.round("avgValOfSamples", 1))
    assert rows_of(rows, *WINDOW, "avgValOfSamples") == rows_of(plain, *WINDOW, "avgValOfSamples")
    report = sliding_report(samples, points_frame(spark, [("Pa", "a")]), [DAY // 60], 15, finish=finish)
    assert len(seen) == 2 and report.count() < rows.count()


@pytest.mark.parametrize("name", ["sliding_multi", "sliding_7d", "pane_table"])
def test_queries_round_before_windows_are_expanded(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert plan.index("explode(") < plan.index("round(")  # the root comes first


def test_merge_of_marked_panes(spark, samples):
    panes = pane_aggregates(samples, 15).withColumn("new", F.col("paneStart") % 7200 == 0)
    got = pane_runs(panes, [30, 120], 15, marked="new")
    whole = merge_panes(panes, [30, 120], 15)
    new = merge_panes(panes.where("new"), [30, 120], 15)
    expected = whole.join(new.select(*WINDOW), list(WINDOW), "left_semi")
    columns = ("timeseriesId", "windowSeconds", "countOfSamples", "sumValOfSamples", "stddevValOfSamples")
    assert rows_of(expand_runs(got, 15), *WINDOW, *columns) == rows_of(expected, *WINDOW, *columns)


def test_runs_are_joined_before_there_is_a_row_for_each_window(spark, samples, tmp_path):
    points, made, joined = points_frame(spark, [("Pa", "a")]), {}, []

    def write(rows, number):
        made[number] = rows.collect()

    def join(runs):
        joined.append(runs)
        return enrich(runs, points, True)

    own = WindowPublisher(
        spark, str(tmp_path / "p"), str(tmp_path / "c"), 15, DAY, write, windows=[DAY // 60],
        clock=lambda: BASE + 3 * DAY, join=join,
    )
    own.on_batch(samples, 0)
    assert joined[0].count() < len(made[0])  # runs of both series, windows of one
    assert {r.timeseriesId for r in made[0]} == {"a"}
    first = own.totals["rows"]
    assert first == 2 * len(made[0])  # counted before the join
    # a late sample: its windows come again, with all their samples
    late = samples_frame(spark, [("a", 9.0, BASE + 1000)])
    own.on_batch(late, 1)
    expected = sliding_aggregates(samples.unionByName(late), [DAY // 60], 15)
    touched = sliding_aggregates(late, [DAY // 60], 15)
    expected = expected.join(touched.select(*WINDOW), list(WINDOW), "left_semi")
    assert sorted((r.windowEnd, r.countOfSamples, r.sumValOfSamples) for r in made[1]) == rows_of(
        expected, "windowEnd", "countOfSamples", "sumValOfSamples"
    )
    assert own.totals == {"rows": first + len(made[1]), "again": len(made[1])}
    # the windows of a batch are told by one merge
    publication = own._state()["of_batch"]
    assert plan_of(own.runs_at(Publication(**publication))).count("inline(if ") == 1


def test_nodes_of_all_sizes_by_one_shuffle(spark, samples, tmp_path):
    own = _LookbackPublisher(
        spark, str(tmp_path / "p"), str(tmp_path / "c"), 5, 30 * DAY, lambda rows, number: None, "delta",
        period=5, frequencies=[30 * 24 * 60],
    )
    nodes = own._nodes(pane_aggregates(samples, 5, stat="delta"))
    assert len(own.sizes) > 3 and executed(nodes).count("Exchange hashpartitioning") == 2
    counts = {r["size"]: r["n"] for r in nodes.groupBy("size").agg(F.sum("countOfSamples").alias("n")).collect()}
    assert counts == dict.fromkeys(own.sizes, 80)
