import math
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import points_frame, rows_of, sample, samples_frame
from seriesmill.functions.codec import check_samples
from seriesmill.functions.stats import DELTA, STDDEV
from seriesmill.operators.enrich import enrich, fits_broadcast, to_output, unmatched_series
from seriesmill.operators.lastvalue import advance_last_known_value, last_known_value
from seriesmill.operators.lookback import lookback_aggregates
from seriesmill.operators.series import samples_between, series_aggregates
from seriesmill.operators.sliding import (
    merge_panes,
    pane_aggregates,
    sliding_aggregates,
    windowed_aggregates,
)
from seriesmill.schemas import INTERVAL_AGGREGATE, WINDOW_AGGREGATE
from seriesmill.sources import star_schema
from seriesmill.sources.readers import read_sensor_points

DAY_MINUTES = 24 * 60
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def stddev(values):
    if len(values) < 2:
        return None
    mean = math.fsum(values) / len(values)
    return math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1))


def brute_sliding(rows, length, slide):
    """(series, end) -> values, straight from the definition."""
    out = {}
    for series, value, ingest in rows:
        end = ingest - ingest % slide + slide
        while end - length <= ingest:
            out.setdefault((series, length, end), []).append(value)
            end += slide
    return out


def check_sliding(frame, expected):
    got = frame.withColumn("end", F.unix_seconds("windowEnd")).collect()
    assert len(got) == len(expected)
    for row in got:
        values = expected[(row.timeseriesId, row.windowSeconds, row.end)]
        assert (row.windowEnd - row.windowStart).total_seconds() == row.windowSeconds
        assert row.countOfSamples == len(values)
        assert row.minValOfSamples == min(values) and row.maxValOfSamples == max(values)
        assert close(row.sumValOfSamples, math.fsum(values))
        assert close(row.avgValOfSamples, math.fsum(values) / len(values))
        assert close(row.stddevValOfSamples, stddev(values))


SAMPLES = st.lists(
    st.tuples(
        st.sampled_from("ab"), st.integers(-50, 50).map(float), st.integers(-2000, 4000)
    ),
    min_size=1,
    max_size=25,
)


@FEW
@given(rows=SAMPLES, slide=st.sampled_from([60, 120]), multiples=st.sets(st.integers(1, 9), min_size=1))
@pytest.mark.parametrize("plan", ["panes", "direct"])
def test_sliding_equals_definition(spark, plan, rows, slide, multiples):
    frame = samples_frame(spark, [(s, v, t) for s, v, t in rows])
    lengths = [slide * m for m in multiples]
    got = sliding_aggregates(frame, [n / 60 for n in lengths], slide / 60, plan=plan)
    expected = {}
    for length in lengths:
        expected.update(brute_sliding(rows, length, slide))
    check_sliding(got, expected)


@FEW
@given(rows=SAMPLES, low=st.integers(-30, 60), span=st.integers(0, 40))
def test_merge_of_some_windows(spark, rows, low, span):
    low *= 60
    high = low + span * 60
    panes = pane_aggregates(samples_frame(spark, [(s, v, t) for s, v, t in rows]), 1)
    got = merge_panes(panes, [2, 7], 1, ends_after=low, ends_until=high, partitions=2)
    expected = {**brute_sliding(rows, 120, 60), **brute_sliding(rows, 420, 60)}
    check_sliding(got, {k: v for k, v in expected.items() if low < k[2] <= high})


def test_sliding_deviation_keeps_its_digits_far_from_zero(spark):
    rows = [("a", 1e9 + (i % 7) * 1e-3, 60 * i) for i in range(200)]
    got = sliding_aggregates(samples_frame(spark, rows), [50], 1, plan="panes").collect()
    values = brute_sliding(rows, 3000, 60)
    for row in got:
        expected = stddev(values[("a", 3000, int(row.windowEnd.timestamp()))])
        if expected is not None:
            assert math.isclose(row.stddevValOfSamples, expected, rel_tol=1e-4, abs_tol=1e-6)


@pytest.mark.parametrize("odd", [float("nan"), float("inf")])
@pytest.mark.parametrize("plan", ["panes", "direct"])
def test_sliding_odd_values_stay_in_their_windows(spark, plan, odd):
    rows = [("a", odd, 0), ("a", 1, 30), ("a", 2, 130), ("a", 4, 200)]
    got = sliding_aggregates(samples_frame(spark, rows), [2], 1, plan=plan)
    by_end = {int(r.windowEnd.timestamp()): r for r in got.collect()}
    first = by_end[60]
    assert first.minValOfSamples == 1 and repr(first.maxValOfSamples) == repr(odd)
    assert math.isnan(first.stddevValOfSamples)
    later = by_end[240]
    assert (later.sumValOfSamples, later.countOfSamples) == (6, 2)
    assert close(later.stddevValOfSamples, math.sqrt(2))


def test_window_bounds_are_half_open(spark):
    frame = samples_frame(spark, [("a", 1, 0), ("a", 2, 60)])
    got = sliding_aggregates(frame, [1], 1)
    assert rows_of(got.withColumn("end", F.unix_seconds("windowEnd")), "end", "sumValOfSamples") == [
        (60, 1.0),
        (120, 2.0),
    ]


def test_window_must_be_a_multiple_of_the_slide(spark):
    frame = samples_frame(spark, [("a", 1, 0)])
    with pytest.raises(ValueError):
        sliding_aggregates(frame, [20], 15)
    with pytest.raises(ValueError):
        windowed_aggregates(frame, 20, 15)
    with pytest.raises(ValueError):
        sliding_aggregates(frame, [60], 15, plan="other")


def test_metrics_of_a_series_are_mixed_unless_asked(spark):
    frame = samples_frame(spark, [("a", 1, 0), ("a", 3, 1, 1, "Other")])
    assert rows_of(series_aggregates(frame), "countOfSamples") == [(2,)]
    apart = sliding_aggregates(frame, [1], 1, keys=("timeseriesId", "metric"), plan="panes")
    assert rows_of(apart, "metric", "sumValOfSamples") == [("Other", 3.0), ("Raw", 1.0)]


def test_no_samples_no_rows(spark):
    empty = samples_frame(spark, [])
    assert sliding_aggregates(empty, [600], 15).count() == 0
    assert lookback_aggregates(empty, 1000, [5, 10]).count() == 0
    assert last_known_value(empty).count() == 0


def test_single_sample(spark):
    frame = samples_frame(spark, [("a", 5, 100)])
    row = series_aggregates(frame).first()
    assert row.stddevValOfSamples is None and row.countOfSamples == 1
    assert series_aggregates(frame, DELTA).first().delta == 0
    row = sliding_aggregates(frame, [10], 1, plan="panes").first()
    assert row.stddevValOfSamples is None and row.avgValOfSamples == 5


def test_range_is_half_open(spark):
    frame = samples_frame(spark, [("a", 1, 10), ("a", 2, 19), ("a", 3, 20)])
    assert rows_of(samples_between(frame, 10, 20), "value") == [(1.0,), (2.0,)]


def test_ties_are_broken_in_order(spark):
    frame = samples_frame(
        spark,
        [
            ("a", 1, 10, 5, "Raw", "x"),
            ("a", 2, 10, 6, "Raw", "x"),
            ("b", 1, 10, 5, "Raw", "y"),
            ("b", 2, 10, 5, "Raw", "x"),
            ("c", 2, 10, 5, "Raw", "x"),
            ("c", 1, 10, 5, "Raw", "x"),
        ],
    )
    deltas = series_aggregates(frame, DELTA)
    assert rows_of(deltas, "timeseriesId", "delta") == [("a", 1.0), ("b", -1.0), ("c", 1.0)]
    newest = last_known_value(frame)
    assert rows_of(newest, "timeseriesId", "value") == [("a", 2.0), ("b", 1.0), ("c", 2.0)]
    assert newest.schema == frame.schema


def brute_lookback(rows, as_of, lengths):
    """The intervals of one batch, walked back one by one."""
    horizon = max(lengths)
    out = {}
    for f in set(lengths):
        end = as_of
        while end > as_of - horizon:
            start = end - f
            for series, value, ingest in rows:
                if max(start, as_of - horizon) <= ingest < end:
                    out.setdefault((series, f, start, end), []).append((ingest, value))
            end = start
    return out


@FEW
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(-9, 9).map(float), st.integers(-100, 2100)),
        max_size=30,
        unique_by=lambda r: (r[0], r[2]),
    ),
    as_of=st.integers(0, 2000),
    lengths=st.sets(st.integers(1, 900), min_size=1, max_size=4),
)
@pytest.mark.parametrize("plan", ["panes", "direct"])
def test_lookback_equals_definition(spark, plan, rows, as_of, lengths):
    frame = samples_frame(spark, [(s, v, t) for s, v, t in rows])
    # Lengths in seconds, as minutes that convert back exactly.
    minutes = [(n + 0.5) / 60 for n in lengths]
    got = lookback_aggregates(frame, as_of, minutes, plan=plan)
    expected = brute_lookback(rows, as_of, lengths)
    found = got.collect()
    assert len(found) == len(expected)
    for row in found:
        start, end = int(row.windowStart.timestamp()), int(row.windowEnd.timestamp())
        group = sorted(expected[(row.timeseriesId, row.windowSeconds, start, end)])
        values = [v for _, v in group]
        assert row.countOfSamples == len(values) and row.sumValOfSamples == sum(values)
        assert row.minValOfSamples == min(values) and row.maxValOfSamples == max(values)
        assert close(row.avgValOfSamples, sum(values) / len(values))
        assert row.delta == values[-1] - values[0]
        assert row.isPartial == (start < as_of - max(lengths))


def test_uneven_frequency_cuts_the_oldest_interval(spark):
    frame = samples_frame(spark, [("a", v, t) for v, t in [(1, 1), (2, 150), (4, 600), (8, 901)]])
    got = lookback_aggregates(frame, 1000, [7, 15]).where("windowSeconds = 420")
    rows = got.withColumn("start", F.unix_seconds("windowStart"))
    # T - H is 100: the sample at 1 is out, the one at 150 is in the cut interval.
    assert rows_of(rows, "start", "isPartial", "sumValOfSamples") == [
        (-260, True, 2.0),
        (580, False, 12.0),
    ]


def test_lookback_ignores_the_future_and_the_distant_past(spark):
    frame = samples_frame(spark, [("a", 1, 999), ("a", 2, 1000), ("a", 4, 399), ("a", 8, 400)])
    got = lookback_aggregates(frame, 1000, [10])
    assert rows_of(got, "countOfSamples", "sumValOfSamples", "delta") == [(2, 9.0, -7.0)]


def test_lookback_range_reaches_the_parquet_scan(spark, tmp_path, capsys):
    samples_frame(spark, [("a", 1, 10)]).write.parquet(str(tmp_path / "s"))
    table = spark.read.parquet(str(tmp_path / "s"))
    lookback_aggregates(table, 1000, [1, 10]).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ingestUnixTimestamp,400)" in plan
    assert "LessThan(ingestUnixTimestamp,1000)" in plan


def test_last_known_value_advances(spark):
    known = last_known_value(samples_frame(spark, [("a", 1, 10), ("b", 1, 50)]))
    arrived = samples_frame(spark, [("a", 2, 11), ("b", 2, 49), ("c", 3, 1)])
    got = advance_last_known_value(known, arrived)
    assert rows_of(got, "timeseriesId", "value") == [("a", 2.0), ("b", 1.0), ("c", 3.0)]


def test_enrich_fans_out_and_drops_unknown_series(spark):
    stats = series_aggregates(samples_frame(spark, [("a", 1, 0), ("z", 2, 0)]))
    points = points_frame(spark, [("P1", "a"), ("P2", "a"), ("P3", "b")])
    assert rows_of(enrich(stats, points), "pointId", "sumValOfSamples") == [("P1", 1.0), ("P2", 1.0)]
    assert rows_of(unmatched_series(stats, points), "timeseriesId") == [("z",)]


def types(schema):
    return [(f.name, f.dataType) for f in schema]


def test_records_have_the_published_schema(spark):
    frame = samples_frame(spark, [("a", 1, 0)])
    points = points_frame(spark, [("P1", "a")])
    windows = to_output(enrich(sliding_aggregates(frame, [60], 15), points), STDDEV)
    assert types(windows.schema) == types(WINDOW_AGGREGATE)
    intervals = to_output(enrich(lookback_aggregates(frame, 60, [1]), points), DELTA)
    assert types(intervals.schema) == types(INTERVAL_AGGREGATE)
    panes = to_output(enrich(sliding_aggregates(frame, [600], 15), points), STDDEV)
    assert types(panes.schema) == types(WINDOW_AGGREGATE)


def test_only_a_small_dimension_is_broadcast(spark, tmp_path, capsys):
    points_frame(spark, [("P1", "a"), ("P2", "a")]).write.json(str(tmp_path / "p"))
    points = read_sensor_points(spark, str(tmp_path / "p"))
    stats = series_aggregates(samples_frame(spark, [("a", 1, 0), ("z", 1, 0)]))
    assert fits_broadcast(points) and not fits_broadcast(points, 1)
    for broadcast, plan in [(True, "BroadcastHashJoin"), (False, "SortMergeJoin")]:
        for join, names in [(enrich, ["a", "a"]), (unmatched_series, ["z"])]:
            rows = join(stats, points, broadcast)
            rows.explain()
            text = capsys.readouterr().out
            assert plan in text and "BuildLeft" not in text
            assert [r.timeseriesId for r in rows.collect()] == names


def test_hot_series(spark):
    """A third of the samples in one series: still exact."""
    hot = spark.range(30000).selectExpr(
        "concat('h', id) id",
        "if(id % 3 = 0, 'hot', cast(id % 50 as string)) timeseriesId",
        "cast(id % 11 as double) value",
        "timestamp_seconds(id * 7) timestamp",
        "'Raw' metric",
        "'+00:00' timeOffset",
        "id * 7 unixTimestamp",
        "id * 7 ingestUnixTimestamp",
    )
    panes = sliding_aggregates(hot, [600], 15, plan="panes")
    direct = sliding_aggregates(hot, [600], 15, plan="direct")
    exact = ["timeseriesId", "windowEnd", "countOfSamples", "minValOfSamples", "sumValOfSamples"]
    assert panes.count() == direct.count()
    assert panes.select(*exact).exceptAll(direct.select(*exact)).count() == 0


def test_level_change_keeps_the_deviation(spark):
    """One series whose level falls by 1e9 in the middle of a block."""
    rows = [("a", (1e9 if t < 302_400 else 0) + i % 2, t) for i, t in enumerate(range(0, 604_800, 1200))]
    frame = samples_frame(spark, rows)
    panes = sliding_aggregates(frame, [DAY_MINUTES], 15, plan="panes")
    direct = sliding_aggregates(frame, [DAY_MINUTES], 15, plan="direct")
    values = {row[2]: row[1] for row in rows}

    def ends(rows):
        seconds = F.unix_seconds("windowEnd")
        return {r.end: r.stddevValOfSamples for r in rows.select(seconds.alias("end"), "stddevValOfSamples").collect()}

    got, other = ends(panes), ends(direct)
    assert set(got) == set(other)
    for end, deviation in got.items():
        inside = [Fraction(v) for t, v in values.items() if end - DAY_MINUTES * 60 <= t < end]
        if len(inside) < 2:
            assert deviation is None and other[end] is None
            continue
        mean = sum(inside) / len(inside)
        exact = float(sum((v - mean) ** 2 for v in inside) / (len(inside) - 1)) ** 0.5
        assert deviation == pytest.approx(exact, rel=1e-9)
        # Spark's own merges means of doubles, which at this level have no more digits
        assert other[end] == pytest.approx(exact, rel=1e-7)


def test_rows_without_value_series_or_time_are_left_out_everywhere(spark):
    good = samples_frame(spark, [("a", 1, 10), ("a", 2, 70)])
    bad = samples_frame(spark, [sample("a", None, 20)])
    bad = bad.union(good.withColumn("timeseriesId", F.lit(None).cast("string")))
    bad = bad.union(good.withColumn("ingestUnixTimestamp", F.lit(None).cast("long")))
    every = good.union(bad)
    jobs = [
        lambda f: sliding_aggregates(f, [5], 1, plan="panes"),
        lambda f: sliding_aggregates(f, [5], 1, plan="direct"),
        lambda f: windowed_aggregates(f, 5, 1),
        lambda f: lookback_aggregates(f, 120, [1, 2]),
        lambda f: lookback_aggregates(f, 120, [1, 2], plan="direct"),
        lambda f: series_aggregates(f.where("ingestUnixTimestamp IS NOT NULL")),
        last_known_value,
    ]
    for job in jobs:
        assert sorted(map(str, job(every).collect())) == sorted(map(str, job(good).collect()))
    samples, rejects = check_samples(every)
    assert samples.count() == 2
    assert {r.rejectReason for r in rejects.collect()} == {
        "missing: value", "missing: timeseriesId", "missing: ingestUnixTimestamp"
    }


def test_joining_the_dimension_starts_no_job(spark, sf):
    points = points_frame(spark, [("Pa", "a")])
    plan = enrich(series_aggregates(samples_frame(spark, [("a", 1, 10)])), points)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "GlobalLimit" not in text
    assert not fits_broadcast(points, 0)


def test_time_range_reaches_the_scan(spark, sf):
    rows = star_schema.samples(spark, sf, 1704672000, 1705881600)
    text = rows._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    whole = star_schema.samples(spark, sf)
    inside = whole.where("ingestUnixTimestamp >= 1704672000 AND ingestUnixTimestamp < 1705881600")
    assert rows.exceptAll(inside).count() == 0 and rows.count() == inside.count() > 0
