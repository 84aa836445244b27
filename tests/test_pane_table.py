"""The pane table over many batches, publications that fail, look-back from nodes."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from builders import points_frame, rows_of, samples_frame
from seriesmill.operators import lookback
from seriesmill.operators.lookback import lookback_aggregates, node_days, node_sizes
from seriesmill.operators.sliding import fold_panes, pane_aggregates, sliding_aggregates
from seriesmill.plans.jobs import _LookbackPublisher, interval_report
from seriesmill.sources import dated
from seriesmill.sources.dated import DAY, DatedTable
from seriesmill.sources.notes import Note
from seriesmill.streaming.panes import WindowPublisher

BASE = 1_700_000_000 // DAY * DAY


class Sink:
    """Keeps the rows of each publication; fails where told."""

    def __init__(self):
        self.rows, self.order, self.fail = {}, [], set()

    def __call__(self, rows, number):
        collected = rows.collect()
        if number in self.fail:
            self.fail.discard(number)
            raise OSError("the sink is away")
        self.order.append(number)
        self.rows[number] = collected

    def newest(self):
        made = {}
        for number in sorted(self.rows):
            for r in self.rows[number]:
                made[r.timeseriesId, r.windowSeconds, r.windowEnd] = (r.countOfSamples, r.sumValOfSamples)
        return made


def publisher(spark, folder, sink, clock=lambda: BASE + 2 * DAY, windows=(15, 60), **options):
    return WindowPublisher(
        spark, f"{folder}/panes", f"{folder}/checkpoint", 15, 60 * max(windows), sink, windows=windows, clock=clock, **options
    )


def expected(frame, windows=(15, 60)):
    rows = sliding_aggregates(frame, list(windows), 15).collect()
    return {(r.timeseriesId, r.windowSeconds, r.windowEnd): (r.countOfSamples, r.sumValOfSamples) for r in rows}


def test_note_versions_and_writers(spark, tmp_path):
    one = Note(spark, str(tmp_path / "n"))
    assert one.value is None
    for i in range(4):
        one.write({"i": i})
    other = Note(spark, str(tmp_path / "n"))
    assert (other.version, other.value) == (4, {"i": 3})
    assert len([p for p in (tmp_path / "n").iterdir() if p.suffix == ".json"]) == 2
    other.write({"i": 9})
    with pytest.raises(RuntimeError, match="another writer"):
        one.write({"i": 10})
    assert Note(spark, str(tmp_path / "n")).value == {"i": 9}


def data_files(folder):
    return [p for p in folder.rglob("part-*.parquet")]


def test_files_of_a_day_are_bounded_and_rows_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dated, "FAN", 3)
    sink, rows = Sink(), []
    draw = random.Random(2)
    own = publisher(spark, tmp_path, sink)
    most = 0
    for batch in range(30):
        new = [(draw.choice("ab"), float(draw.randint(0, 9)), BASE + draw.randint(0, DAY // 4)) for _ in range(4)]
        new += [("c", 1.0, BASE + DAY + 60)] if batch == 20 else []
        rows += new
        own.on_batch(samples_frame(spark, new), batch)
        entries = own.panes_table.entries
        most = max(most, len([e for e in entries if e["day"] == BASE // DAY]))
        if batch == 17:  # a restart in mid-stream
            own = publisher(spark, tmp_path, sink)
    # two of each level below the third, those of the batch that may run again and one that waits
    assert most <= 2 * 4 + 2
    assert max(e["level"] for e in entries) == 3
    assert len(data_files(tmp_path)) <= 3 * len(entries) + 3 * dated.FAN
    pane = ("timeseriesId", "paneStart", "countOfSamples", "sumValOfSamples", "minValOfSamples", "varianceOfSamples")
    got = own.panes(10**6, None, BASE + 9 * DAY)
    assert rows_of(got.withColumn("varianceOfSamples", F.round("varianceOfSamples", 9)), *pane) == rows_of(
        pane_aggregates(samples_frame(spark, rows)).withColumn("varianceOfSamples", F.round("varianceOfSamples", 9)), *pane
    )
    assert sink.newest() == expected(samples_frame(spark, rows))


def test_a_crash_in_a_merge_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dated, "FAN", 2)
    table = DatedTable(spark, str(tmp_path / "t"), "s", lambda rows: rows.groupBy("k", "s").agg(F.sum("n").alias("n")), ["k"])
    frame = spark.createDataFrame([("a", 10, 1), ("b", DAY + 5, 1)], "k string, s long, n long")
    for batch in range(4):
        table.append(frame, batch)

    def fail(value):
        raise OSError

    for write in ("_save", None):
        with monkeypatch.context() as patched:
            if write:
                patched.setattr(table, write, lambda: fail(None))
                with pytest.raises(OSError):
                    table.compact(4)
                table = DatedTable(spark, str(tmp_path / "t"), "s", table.fold, ["k"])
            else:
                assert table.compact(4) == 4
        total = table.read(3).groupBy("k").agg(F.sum("n").alias("n"))
        assert rows_of(total, "k", "n") == [("a", 4), ("b", 4)]
    # a reader of the manifest before still finds its files; the merge after next deletes them
    assert table.compact(4) == 4 and table.compact(4) == 4 and table.compact(4) == 0
    assert rows_of(table.read(3), "k", "n") == [("a", 4), ("b", 4)]
    assert {e["level"] for e in table.entries} == {2}
    # a batch that runs again replaces its rows, merged ones stay
    table.append(frame, 4)
    table.append(frame, 4)
    assert rows_of(table.read(4).groupBy("k").agg(F.sum("n").alias("n")), "k", "n") == [("a", 5), ("b", 5)]
    assert rows_of(table.read(4, batch=4), "k", "n") == [("a", 1), ("b", 1)]
    assert rows_of(table.read(3, batch=None).groupBy("k").agg(F.sum("n").alias("n")), "k", "n") == [("a", 4), ("b", 4)]


def test_a_publication_that_failed_is_made_up_for(spark, tmp_path):
    """The sink fails once without new samples: every window of that day is published none the less."""
    sink, now = Sink(), [BASE + 3600]
    rows = [("a", float(i), BASE + 900 * i + 5) for i in range(40)]
    own = publisher(spark, tmp_path, sink, lambda: now[0])
    own.on_batch(samples_frame(spark, rows), 0)
    now[0], sink.fail = BASE + DAY, {1}
    with pytest.raises(OSError):
        own.publish()
    now[0] = BASE + DAY + 1800
    again = publisher(spark, tmp_path, sink, lambda: now[0])
    late = [("a", 100.0, BASE + 100), ("b", 1.0, BASE + DAY)]
    again.on_batch(samples_frame(spark, late), 1)
    assert sink.order == [0, 1, 2]  # under its number, before the next one
    again.publish(BASE + 2 * DAY)
    assert sink.newest() == expected(samples_frame(spark, rows + late))
    assert again._log.value["open"] == []


@pytest.mark.parametrize("restart", [False, True])
def test_a_batch_that_failed_runs_again_once(spark, tmp_path, restart):
    sink, rows = Sink(), [("a", 1.0, BASE + 5), ("a", 2.0, BASE + 1000)]
    own = publisher(spark, tmp_path, sink)
    sink.fail = {0}
    with pytest.raises(OSError):
        own.on_batch(samples_frame(spark, rows), 0)
    if restart:
        own = publisher(spark, tmp_path, sink)
    own.on_batch(samples_frame(spark, rows), 0)
    own.on_batch(samples_frame(spark, [("b", 1.0, BASE)]), 1)
    assert sink.order == [0, 1]
    assert sink.newest() == expected(samples_frame(spark, [*rows, ("b", 1.0, BASE)]))


def test_threads_share_no_number(spark, tmp_path):
    sink, now = Sink(), [BASE]
    own = publisher(spark, tmp_path, sink, lambda: now[0])
    rows = [("a", float(i), BASE + 900 * i) for i in range(12)]

    def batches():
        for i, row in enumerate(rows):
            own.on_batch(samples_frame(spark, [row]), i)

    def due():
        for i in range(1, 13):
            now[0] = BASE + 900 * i
            own.publish()

    threads = [threading.Thread(target=batches), threading.Thread(target=due)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(300)
    own.publish(BASE + DAY)
    # before the first batch there is nothing to write
    assert sink.order == list(range(sink.order[0], own._log.value["number"] + 1))
    assert sink.newest() == expected(samples_frame(spark, rows))


def test_folding_needs_one_shuffle_and_no_window(spark):
    frame = samples_frame(spark, [("a", 1e9 + i % 3, BASE + i) for i in range(100)] + [("a", 5.0, BASE + 7)])
    panes = pane_aggregates(frame, 60)
    parts = panes.unionByName(panes).unionByName(panes.where("false"))
    plan = fold_panes(parts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    parts.write.mode("overwrite").parquet(folder := f"{spark.conf.get('spark.checkpoint.dir')}/fold-parts")
    physical = fold_panes(spark.read.parquet(folder))._jdf.queryExecution().sparkPlan().toString()
    assert "partial_collect_list" in physical and "Window" not in physical
    twice = frame.unionByName(frame)
    got, want = (rows_of(f, "paneStart", "varianceOfSamples") for f in (fold_panes(parts), pane_aggregates(twice, 60)))
    for (p, x), (q, y) in zip(got, want, strict=True):
        assert p == q and x == pytest.approx(y, rel=1e-9)


def test_sizes_of_nodes_and_days():
    assert node_sizes(300, 30 * DAY) == [300, 2400, 19200, 153600, 1228800]
    assert node_sizes(300, 300) == [300]
    sizes = node_sizes(300, 30 * DAY)
    as_of = BASE + 12345 * 300
    for lengths in ([30 * DAY], [3600, 30 * DAY], [420 * 60, 7 * DAY, 30 * DAY]):
        covered = []
        for size, longer in zip(sizes, [*sizes[1:], None]):
            start = lookback.np.arange((as_of - lengths[-1]) // size * size, as_of, size)
            used = lookback._fits(start, size, as_of, lengths, lookback.np.floor)
            if longer:
                used &= ~lookback._fits(start - start % longer, longer, as_of, lengths, lookback.np.floor)
            covered += [(s, s + size) for s in start[used].tolist()]
            assert set(node_days(as_of, lengths, size, longer)) == {s // DAY for s in start[used].tolist()}
        covered.sort()
        assert covered[0][0] == as_of - lengths[-1] and covered[-1][1] == as_of
        assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))
        if len(lengths) == 1:
            assert len(covered) <= 2 * 7 * len(sizes)


def test_lookback_reads_few_nodes(spark, tmp_path):
    """A month every 5 minutes: a bounded number of nodes per series, and the rows of the direct plan."""
    sink, draw = Sink(), random.Random(3)
    now = [BASE + 32 * DAY]
    points = points_frame(spark, [("Pa", "a"), ("Pb", "b")])

    def make():
        return _LookbackPublisher(
            spark, f"{tmp_path}/panes", f"{tmp_path}/checkpoint", 5, 30 * DAY, sink, "delta", period=5,
            clock=lambda: now[0], frequencies=[30 * 24 * 60],
        )

    own = make()
    first = [(s, float(i), BASE + 300 * i + draw.randint(0, 299)) for i in range(32 * 288) for s in "a"]
    first += [("b", float(i), BASE + 86_000 * i) for i in range(32)]
    own.on_batch(samples_frame(spark, first), 0)
    rows, sizes = list(first), own.sizes
    for batch in range(1, 4):
        new = [("a", 7.0, now[0] + 10), ("b", -5.0, BASE + draw.randint(0, 32 * DAY))]
        now[0] += 300
        rows += new
        own.on_batch(samples_frame(spark, new), batch)
        nodes = own.nodes_at(now[0], batch)
        per_series = nodes.groupBy("timeseriesId").count().agg(F.max("count")).first()[0]
        assert per_series <= 14 * len(sizes) + 2 * batch
        got = rows_of(spark.createDataFrame(sink.rows[batch]), "timeseriesId", "windowStart", "countOfSamples", "delta")
        direct = lookback_aggregates(samples_frame(spark, rows), now[0], [30 * 24 * 60], plan="direct")
        assert got == rows_of(direct, "timeseriesId", "windowStart", "countOfSamples", "delta")
    assert interval_report(samples_frame(spark, rows), points, now[0], [30 * 24 * 60]).count() == 2
