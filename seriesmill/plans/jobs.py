"""The three jobs: sliding windows, look-back intervals, last known values.

Each takes a stream of samples and returns its started queries; wait for them
with ``query.awaitTermination()``. Durations are in minutes. Every query has its
own name and checkpoint, below ``spark.checkpoint.dir`` unless a folder is given.
"""

from __future__ import annotations

import datetime as dt
import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from seriesmill.functions.codec import encode_samples, parse_samples, split_parsed
from seriesmill.functions.stats import DELTA, STDDEV
from seriesmill.functions.timeunits import durations, interval_text, minutes_to_seconds
from seriesmill.operators.enrich import enrich, fits_broadcast, to_output
from seriesmill.operators.lastvalue import last_known_value
from seriesmill.operators.lookback import (
    in_cover,
    lookback_aggregates,
    lookback_from_panes,
    node_days,
    node_sizes,
)
from seriesmill.operators.sliding import (
    DEFAULT_SLIDE,
    DEFAULT_WINDOWS,
    expand_runs,
    fold_panes,
    merge_tasks,
    pane_aggregates,
    pane_runs,
)
from seriesmill.schemas import INGEST_TIME, SAMPLE_COLUMNS
from seriesmill.sources.dated import run_of
from seriesmill.sources.point_table import PointTable
from seriesmill.sources.readers import read_published_samples
from seriesmill.sources.sample_table import SampleTable
from seriesmill.sources.sinks import Sink, checkpoint_for, start, write_batch, write_version
from seriesmill.streaming.panes import Publisher, WindowPublisher, longest, run_publisher
from seriesmill.streaming.windows import streaming_sliding_aggregates

# Settings a session for these jobs should have. The state store keeps one row
# per series or open window off the JVM heap.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def sliding_report(
    samples: DataFrame,
    points: DataFrame | PointTable,
    windows: Sequence[float] = DEFAULT_WINDOWS,
    slide: float = DEFAULT_SLIDE,
    time_col: str = INGEST_TIME,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Published records of the sliding job over a table of samples.

    Equal windows that follow each other are joined with their point once, and so is what ``finish``
    does to the statistics.
    """
    panes = pane_aggregates(samples, slide, time_col)
    runs = pane_runs(panes, windows, slide, partitions=merge_tasks(panes))
    joined = enrich(runs if finish is None else finish(runs), points)
    return to_output(expand_runs(joined, slide), STDDEV)


def interval_report(
    samples: DataFrame,
    points: DataFrame | PointTable,
    as_of: int | dt.datetime,
    frequencies: Sequence[float],
    time_col: str = INGEST_TIME,
) -> DataFrame:
    """Published records of one batch of the look-back job over a table of samples."""
    intervals = lookback_aggregates(samples, as_of, frequencies, time_col)
    return to_output(enrich(intervals, points), DELTA)


def _folder(root: str | None, name: str) -> str | None:
    return None if root is None else f"{root.rstrip('/')}/{name}"


def _into(sink: Sink) -> Callable[[DataFrame, int], None]:
    """Writes a publication to a sink; files go to a folder of its own, which a repetition replaces."""

    def write(record: DataFrame, number: int) -> None:
        if sink.kind == "table":
            write_version(record, sink.location, number)
        else:
            write_batch(record, sink, number=number)

    return write


def run_sliding_job(
    samples: DataFrame,
    points: DataFrame | PointTable,
    sink: Sink,
    windows: Sequence[float] = DEFAULT_WINDOWS,
    period: float = DEFAULT_SLIDE,
    pane_table: str | None = None,
    time_col: str = INGEST_TIME,
    checkpoint: str | None = None,
    drain: bool = False,
    clock: Callable[[], float] = time.time,
    name: str = "sliding",
) -> StreamingQuery:
    """All window lengths in one query, from a table of panes; see :mod:`seriesmill.streaming.panes`.

    A window is published once it has ended, and again whenever a late sample changes it. Panes go to
    ``pane_table``, by default a folder beside the checkpoint. ``query.publisher.publish(as_of)``
    publishes what is due when no samples arrive.
    """
    small = fits_broadcast(points)
    checkpoint = _folder(checkpoint, name) or checkpoint_for(samples.sparkSession, name)
    write = _into(sink)
    publisher = WindowPublisher(
        samples.sparkSession,
        pane_table or f"{checkpoint}-panes",
        checkpoint,
        period,
        longest(windows, period),
        lambda rows, number: write(to_output(rows, STDDEV), number),
        time_col=time_col,
        clock=clock,
        windows=windows,
        join=lambda runs: enrich(runs, points, small),
    )
    return run_publisher(publisher, samples, name, period, drain)


def run_sliding_updates_job(
    samples: DataFrame,
    points: DataFrame | PointTable,
    sink: Sink,
    windows: Sequence[float],
    period: float = DEFAULT_SLIDE,
    lateness: float | None = None,
    mode: str = "update",
    time_col: str = INGEST_TIME,
    checkpoint: str | None = None,
    drain: bool = False,
    name: str = "sliding_updates",
) -> list[StreamingQuery]:
    """Windows kept in the state store, one query per length.

    A window is published whenever it changes, before it closes. State holds
    window / period rows per series: for short windows, see :func:`run_sliding_job`.
    """
    queries = []
    small = fits_broadcast(points)
    for window in windows:
        length = minutes_to_seconds(window)
        rows = streaming_sliding_aggregates(samples, window, period, lateness, time_col)
        record = to_output(enrich(rows, points, small), STDDEV)
        target = sink
        if sink.kind in ("table", "json", "parquet") and len(windows) > 1:
            target = Sink(sink.kind, f"{sink.location}/window_{length}", sink.options)
        query = f"{name}_{length}"
        queries.append(
            start(
                record,
                target,
                query,
                mode,
                minutes_to_seconds(period),
                _folder(checkpoint, query),
                drain,
            )
        )
    return queries


def run_interval_job(
    samples: DataFrame,
    points: DataFrame | PointTable,
    sink: Sink,
    frequencies: Sequence[float],
    period: float = 5,
    time_col: str = INGEST_TIME,
    checkpoint: str | None = None,
    drain: bool = False,
    clock: Callable[[], float] = time.time,
    name: str = "intervals",
) -> list[StreamingQuery]:
    """One query per frequency; publishes ended intervals, and again those that a late sample changes.

    With publications at multiples of the period, the intervals of all of them are the windows of
    length f that start at each multiple of the shorter of f and the period, provided one divides the
    other. They are merged from panes of that length. For other ratios use :func:`run_lookback_job`.
    """
    durations(frequencies)
    small = fits_broadcast(points)
    queries = []
    for frequency in sorted(set(frequencies)):
        length, step = minutes_to_seconds(frequency), minutes_to_seconds(period)
        if length % step and step % length:
            raise ValueError(f"neither of {length} s and {step} s divides the other")
        several = sink.kind in ("table", "json", "parquet") and len(set(frequencies)) > 1
        target = Sink(sink.kind, f"{sink.location}/frequency_{length}", sink.options) if several else sink
        query = f"{name}_{length}"
        folder = _folder(checkpoint, query) or checkpoint_for(samples.sparkSession, query)
        write = _into(target)
        publisher = WindowPublisher(
            samples.sparkSession,
            f"{folder}-panes",
            folder,
            min(frequency, period),
            length,
            lambda rows, number, write=write: write(to_output(rows, DELTA), number),
            DELTA,
            time_col,
            period=period,
            clock=clock,
            windows=[frequency],
            join=lambda runs: enrich(runs, points, small),
        )
        queries.append(run_publisher(publisher, samples, query, period, drain))
    return queries


@dataclass
class _LookbackPublisher(Publisher):
    """Publishes every interval that the look-back at the time of publication has."""

    frequencies: Sequence[float] = ()

    @property
    def sizes(self) -> list[int]:
        return node_sizes(minutes_to_seconds(self.slide), self.horizon)

    def nodes_at(self, as_of: int, upto: int) -> DataFrame | None:
        """The fewest nodes, as parts, that together are all intervals at a time."""
        lengths, found = durations(self.frequencies), []
        for size, longer in zip(self.sizes, [*self.sizes[1:], None], strict=True):
            days = node_days(as_of, lengths, size, longer)
            parts = self.panes_table.read(upto, size=size, days=days)
            if parts is not None:
                found.append(parts.where(in_cover(as_of, lengths, size, longer)))
        return reduce(DataFrame.unionByName, found) if found else None

    def rows_at(self, publication):
        nodes = self.nodes_at(publication.as_of, publication.upto)
        if nodes is None:
            return None
        panes, step = fold_panes(nodes, self.keys, self.stat), self.sizes[0]
        return lookback_from_panes(panes, publication.as_of, self.frequencies, self.keys, step)


def run_lookback_job(
    samples: DataFrame,
    points: DataFrame | PointTable,
    sink: Sink,
    frequencies: Sequence[float],
    period: float = 5,
    pane_table: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    clock: Callable[[], float] = time.time,
    keep: bool = True,
    name: str = "lookback",
) -> StreamingQuery:
    """Every interval of every frequency, published anew for each batch.

    Frequencies of any length fit, and late samples correct all intervals within the longest one. The
    batch time is the last multiple of the period on the clock; samples at or after it wait for the
    next. Samples are kept as panes as long as the greatest common divisor of the period and the
    frequencies, and as nodes of 8, 64, ... panes, in ``pane_table``, by default a folder beside the
    checkpoint. A batch reads the fewest nodes that make up its intervals: some hundred a series for one
    interval of any length. Without ``keep``, older days are removed.
    """
    lengths, step = durations(frequencies), minutes_to_seconds(period)
    small = fits_broadcast(points)
    checkpoint = _folder(checkpoint, name) or checkpoint_for(samples.sparkSession, name)
    write = _into(sink)
    publisher = _LookbackPublisher(
        samples.sparkSession,
        pane_table or f"{checkpoint}-panes",
        checkpoint,
        math.gcd(step, *lengths) / 60,
        lengths[-1],
        lambda rows, number: write(to_output(enrich(rows, points, small), DELTA), number),
        DELTA,
        period=period,
        clock=clock,
        keep=keep,
        frequencies=frequencies,
    )
    return run_publisher(publisher, samples, name, period, drain)


def run_last_known_value_job(
    samples: DataFrame,
    sink: Sink,
    period: float = 15,
    mode: str = "update",
    checkpoint: str | None = None,
    drain: bool = False,
    name: str = "last_known_value",
    restore: str | None = None,
) -> StreamingQuery:
    """Newest sample per series: ``update`` publishes changes, ``complete`` everything.

    ``restore`` names the folder of a table that an earlier run has published, for a run whose checkpoint
    is new: what is known from there is the state that samples are merged into, so that series
    without new samples are still published. It must be another folder than the sink's, whose rows would come back.
    """
    if restore is not None:
        if sink.location.rstrip("/") == restore.rstrip("/"):
            raise ValueError("the table to restore from must not be the one to write to")
        known = read_published_samples(samples.sparkSession, restore)
        samples = samples.select(*SAMPLE_COLUMNS).unionByName(known.select(*SAMPLE_COLUMNS))
    return start(
        last_known_value(samples),
        sink,
        name,
        mode,
        minutes_to_seconds(period),
        _folder(checkpoint, name),
        drain,
        encode=encode_samples,
    )


def run_ingest_job(
    messages: DataFrame,
    samples_sink: Sink,
    rejects_sink: Sink,
    period: float = 15,
    checkpoint: str | None = None,
    drain: bool = False,
    name: str = "ingest",
) -> StreamingQuery:
    """Parse each message once; samples go to one sink, all others with their reason to another.

    ``messages`` is what :func:`seriesmill.sources.readers.read_messages` gives. A sample table as a sink
    gets the batches as a run of its own, and folders of earlier batches are merged.
    """
    checkpoint = _folder(checkpoint, name) or checkpoint_for(messages.sparkSession, name)
    table = None
    if samples_sink.kind == "samples":
        run = run_of(messages.sparkSession, checkpoint)
        table = SampleTable(messages.sparkSession, samples_sink.location, run)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_samples(batch).persist()
        try:
            good, rejects = split_parsed(parsed)
            if table is None:
                write_batch(good, samples_sink, encode_samples, batch_id)
            else:
                table.append(good, batch_id)
                table.compact(batch_id)
            write_batch(rejects, rejects_sink, number=batch_id)
        finally:
            parsed.unpersist()

    writer = (
        messages.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval_text(minutes_to_seconds(period))).start()


def run_rejects_job(
    rejects: DataFrame,
    sink: Sink,
    period: float = 15,
    checkpoint: str | None = None,
    drain: bool = False,
    name: str = "rejects",
) -> StreamingQuery:
    """Keep the messages that are no samples, with the reason."""
    return start(
        rejects, sink, name, "append", minutes_to_seconds(period), _folder(checkpoint, name), drain
    )
