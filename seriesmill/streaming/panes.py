"""Windows and intervals over a stream through a table of panes.

Every micro-batch is reduced to panes, one row per series and slide, and appended to a table as it is: there
is no state and no watermark, and a late sample is one more part of its pane. Parts are folded when they are
read, and merged for good once there are some of a day.

A publication at a time T, a multiple of the slide, has all windows that ended after the publication
before and up to T, and again those that ended earlier and hold a pane that the new micro-batch has added
to. A micro-batch publishes once; without new samples :meth:`Publisher.publish` does.

A publication is noted beside the checkpoint with all that its rows depend on before it is written, and
noted as done afterwards. One that was not done is written again, under its number, before any other.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesmill.functions.stats import STDDEV
from seriesmill.functions.timeunits import floor_to, interval_text, minutes_to_seconds
from seriesmill.operators.sliding import expand_runs, fold_panes, pane_aggregates, pane_runs, window_lengths
from seriesmill.schemas import INGEST_TIME, SERIES_KEY
from seriesmill.sources.dated import SIZE_COLUMN, DatedTable, run_of
from seriesmill.sources.notes import Note


@dataclass
class Publication:
    """The ``number``-th publication: of a micro-batch, or of none (-1), at a time.

    ``before`` is the time of the one before it, ``upto`` the last micro-batch it knows of, ``low`` and ``high``
    the first and last pane of its own micro-batch.
    """

    number: int
    batch: int
    as_of: int
    before: int | None
    upto: int
    low: int | None = None
    high: int | None = None


@dataclass
class Publisher:
    """A pane table and what has been published of it. Durations are in minutes.

    ``rows_at`` makes the rows of a publication; ``write`` gets them with the publication's number, and
    gets the same rows again if a micro-batch runs again or a write has failed. ``published`` has the number
    of rows of each, by number.
    """

    spark: SparkSession
    table: str
    checkpoint: str
    slide: float
    horizon: int
    write: Callable[[DataFrame, int], None]
    stat: str = STDDEV
    time_col: str = INGEST_TIME
    keys: Sequence[str] = (SERIES_KEY,)
    period: float | None = None
    clock: Callable[[], float] = time.time
    keep: bool = True
    published: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.table = f"{self.table}/run={run_of(self.spark, self.checkpoint)}"
        self.panes_table = DatedTable(
            self.spark, self.table, "paneStart", lambda rows: fold_panes(rows, self.keys, self.stat), self.keys
        )
        self._lock = threading.RLock()
        #: Number and time of the last publication, that of the last micro-batch, those not done.
        self._log = Note(self.spark, f"{self.checkpoint}/publication-log")

    #: Lengths of the nodes that panes are kept as, in seconds; the first is that of a pane.
    @property
    def sizes(self) -> list[int]:
        return [minutes_to_seconds(self.slide)]

    # --- the log ---

    def _state(self) -> dict:
        return self._log.value or {"number": -1, "as_of": None, "of_batch": None, "open": []}

    def _publish(self, batch: int, as_of: float | None, upto: int, bounds: tuple[int, int] | None) -> None:
        """Note a publication, write it, note it as done. A batch that runs again has the publication it had."""
        state = self._state()
        again = state["of_batch"]
        if batch >= 0 and again and again["batch"] == batch:
            new = Publication(**again)
        else:
            step = minutes_to_seconds(self.period or self.slide)
            now = int(self.clock() if as_of is None else as_of) // step * step
            before = state["as_of"]
            now = now if before is None else max(now, before)
            new = Publication(state["number"] + 1, batch, now, before, upto, *(bounds or (None, None)))
            state = {**state, "number": new.number, "as_of": now, "open": [*state["open"], asdict(new)]}
            if batch >= 0:
                state["of_batch"] = asdict(new)
            self._log.write(state)
        self._write(new)

    def _write(self, publication: Publication) -> None:
        count, made, again = Observation(), 0, 0
        counted = self.counted_at(publication, count)
        if counted is not None:
            self.write(counted, publication.number)
            made, again = count.get["rows"], count.get["again"]
            self.published[publication.number] = made
        state = self._state()
        left = [p for p in state["open"] if p["number"] != publication.number]
        if left != state["open"]:
            totals = {"rows": state.get("rows", 0) + made, "again": state.get("again", 0) + again}
            self._log.write({**state, **totals, "open": left})

    @property
    def totals(self) -> dict[str, int]:
        """Rows published since the checkpoint is there, and those of windows that had ended a publication before.

        They are noted with a publication's end, so each counts once, however often it was written.
        """
        state = self._state()
        return {name: state.get(name, 0) for name in ("rows", "again")}

    def _finish_open(self, but_batch: int | None = None) -> None:
        """Write what was noted and not done, but for what a micro-batch that runs again does itself."""
        for noted in self._state()["open"]:
            if but_batch is None or noted["batch"] != but_batch:
                self._write(Publication(**noted))

    # --- the table ---

    def panes(self, upto_batch: int, since: int | None, until: int) -> DataFrame | None:
        """Folded panes from ``since`` to before ``until``."""
        parts = self.panes_table.read(upto_batch, since, until, self.sizes[0])
        if parts is None:
            return None
        pane = F.col("paneStart")
        parts = parts.where((pane < until) if since is None else (pane >= since) & (pane < until))
        return fold_panes(parts, self.keys, self.stat)

    def _nodes(self, panes: DataFrame) -> DataFrame:
        """The panes, and folded ones of each longer size, by one shuffle."""
        sizes = [F.lit(size) for size in self.sizes]
        if len(sizes) == 1:
            return panes.withColumn(SIZE_COLUMN, sizes[0])
        parts = panes.withColumn(SIZE_COLUMN, F.explode(F.array(*sizes)))
        parts = parts.withColumn("paneStart", floor_to(F.col("paneStart"), F.col(SIZE_COLUMN)))
        return fold_panes(parts, [*self.keys, SIZE_COLUMN], self.stat)

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        with self._lock:
            self._finish_open(but_batch=batch_id)
            parts = pane_aggregates(batch, self.slide, self.time_col, self.keys, self.stat)
            bounds = self.panes_table.append(self._nodes(parts), batch_id, self.sizes)
            self._publish(batch_id, None, batch_id, bounds)
            # the batches before can't run again
            self.panes_table.compact(batch_id)
            if not self.keep:
                self.panes_table.remove_days(self._state()["as_of"] - self.horizon)

    def publish(self, as_of: float | None = None) -> None:
        """What is due at a time, by default now, without new samples."""
        with self._lock:
            self._finish_open()
            state, step = self._state(), minutes_to_seconds(self.period or self.slide)
            now = self.clock() if as_of is None else as_of
            if state["as_of"] is not None and int(now) // step * step <= state["as_of"]:
                return
            self._publish(-1, now, state["of_batch"]["batch"] if state["of_batch"] else -1, None)

    def rows_at(self, publication: Publication) -> DataFrame | None:
        raise NotImplementedError

    def counted_at(self, publication: Publication, count: Observation) -> DataFrame | None:
        """The rows of a publication; observed are their number and that of windows that had ended before."""
        rows, before = self.rows_at(publication), publication.before
        if rows is None:
            return None
        ended = F.lit(False) if before is None else F.unix_seconds("windowEnd") <= before
        return rows.observe(count, F.count(F.lit(1)).alias("rows"), F.count_if(ended).alias("again"))


@dataclass
class WindowPublisher(Publisher):
    """Publishes sliding windows of all the lengths in ``windows``.

    ``join`` is applied to the rows that stand for runs of equal windows, before there is one for each window.
    """

    windows: Sequence[float] = ()
    join: Callable[[DataFrame], DataFrame] | None = None

    def _merged(self, panes: DataFrame, after: int | None, until: int, marked: str | None = None) -> DataFrame:
        return pane_runs(panes, self.windows, self.slide, self.keys, after, until, stat=self.stat, marked=marked)

    def _marked_panes(self, publication: Publication, added: DataFrame, since: int, until: int) -> DataFrame:
        """Folded panes of the series that a micro-batch has added to; those it has added to are marked."""
        parts = added.withColumn("marked", F.lit(True))
        others = self.panes_table.read(publication.upto, since, until, self.sizes[0], but_batch=publication.batch)
        if others is not None:
            others = others.join(added.select(*self.keys).distinct(), list(self.keys), "left_semi")
            parts = parts.unionByName(others.withColumn("marked", F.lit(False)))
        pane = F.col("paneStart")
        return fold_panes(parts.where((pane >= since) & (pane < until)), self.keys, self.stat, "marked")

    def runs_at(self, publication: Publication) -> DataFrame | None:
        as_of, before, upto = publication.as_of, publication.before, publication.upto
        due = None
        if before is None or as_of > before:
            panes = self.panes(upto, None if before is None else before - self.horizon, as_of)
            due = None if panes is None else self._merged(panes, before, as_of)
        if before is None or publication.low is None:
            return due
        low = publication.low
        until = min(before, publication.high + self.horizon)
        added = self.panes_table.read(upto, low, publication.high, self.sizes[0], batch=publication.batch)
        if added is None or low >= until:
            return due
        # windows that hold a pane of this batch
        again = self._merged(self._marked_panes(publication, added, low - self.horizon, until), low, until, "marked")
        return again if due is None else again.unionByName(due)

    def rows_at(self, publication):
        runs = self.runs_at(publication)
        return None if runs is None else self._expanded(runs)

    def _expanded(self, runs: DataFrame) -> DataFrame:
        return expand_runs(runs if self.join is None else self.join(runs), self.slide)

    def counted_at(self, publication, count):
        runs, step = self.runs_at(publication), minutes_to_seconds(self.slide)
        if runs is None:
            return None
        windows = f"(toEnd - fromEnd) div {step} + 1"
        # a run can begin before the publication before and end after it
        again = "0L"
        if publication.before is not None:
            again = f"greatest(0L, floor((least(toEnd, {publication.before}L) - fromEnd) / {step}) + 1)"
        observed = [F.expr(f"coalesce(sum({n}), 0L)").alias(name) for name, n in (("rows", windows), ("again", again))]
        return self._expanded(runs.observe(count, *observed))


def run_publisher(
    publisher: Publisher, samples: DataFrame, name: str, period: float, drain: bool
) -> StreamingQuery:
    """Start the query that feeds a publisher, which it gets as its attribute ``publisher``.

    With ``drain`` the query takes what is there now and ends, and what is due then is published.
    """
    writer = (
        samples.writeStream.queryName(name)
        .option("checkpointLocation", publisher.checkpoint)
        .foreachBatch(publisher.on_batch)
    )
    if drain:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        publisher.publish()
    else:
        query = writer.trigger(processingTime=interval_text(minutes_to_seconds(period))).start()
    query.publisher = publisher
    return query


def longest(windows: Sequence[float], slide: float) -> int:
    """The longest window in seconds; unusable lengths are refused."""
    return window_lengths(windows, slide)[0][-1]
