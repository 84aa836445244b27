"""Sliding-window statistics.

A window of length w that moves by p covers w/p slides, so handing every sample
to all of its windows costs w/p rows a sample: 672 for seven days by 15 minutes.
The pane plan avoids that:

1. Samples are reduced to panes, one row per series and slide (map-side combine,
   so a series that owns a third of the samples is no hot spot).
2. Time is cut into blocks as long as the window. Any window is then the tail of
   one block followed by the head of the next. Running aggregates from each end
   of a block give every tail and head, so a pane is handed on twice instead of
   w/p times, and partial results are only ever added, never subtracted. Squares
   around the mean are merged pairwise, see :func:`pane_runs`.
3. Between two neighbouring changes a result stays the same. Statistics are
   computed once for such a run of windows and repeated for each window in it.

Step 2 groups by series and block, so a group has at most 2w/p rows however
skewed the samples are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.stats import (
    DELTA,
    STDDEV,
    basic_exprs,
    first_key,
    last_key,
    stat_exprs,
    usable,
)
from seriesmill.functions.timeunits import (
    durations,
    floor_to,
    interval_text,
    minutes_to_seconds,
)
from seriesmill.schemas import INGEST_TIME, SERIES_KEY

DEFAULT_WINDOWS = (60, 60 * 24, 60 * 24 * 7)  # minutes
DEFAULT_SLIDE = 15  # minutes


def window_lengths(windows: Sequence[float], slide: float) -> tuple[list[int], int]:
    """Window lengths and slide in seconds; each length is a multiple of the slide."""
    step = minutes_to_seconds(slide)
    lengths = durations(windows)
    uneven = [n for n in lengths if n % step]
    if uneven:
        raise ValueError(f"windows of {uneven} s are no multiple of the {step} s slide")
    return lengths, step


def seconds_of(samples: DataFrame, time_col: str) -> Column:
    """The time column as epoch seconds, rounded down if it is a timestamp."""
    kind = samples.schema[time_col].dataType.typeName()
    return F.unix_seconds(time_col) if kind == "timestamp" else F.col(time_col)


def with_event_time(samples: DataFrame, time_col: str = INGEST_TIME) -> DataFrame:
    """Add ``eventTime``, the timestamp that windows and watermarks use."""
    return samples.withColumn("eventTime", F.timestamp_seconds(seconds_of(samples, time_col)))


def windowed_aggregates(
    samples: DataFrame,
    window: float,
    slide: float,
    stat: str = STDDEV,
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
    order: str = "total",
    watermark: str | None = None,
) -> DataFrame:
    """One window length through Spark's own time windows, batch or streaming."""
    (length,), step = window_lengths([window], slide)
    return _windowed(samples, length, step, stat, time_col, keys, order, watermark)


def _windowed(samples, length, step, stat, time_col, keys, order="total", watermark=None):
    timed = with_event_time(usable(samples, *keys, time_col), time_col)
    if watermark is not None:
        timed = timed.withWatermark("eventTime", watermark)
    span = F.window("eventTime", interval_text(length), interval_text(step))
    grouped = timed.groupBy(*keys, span).agg(*stat_exprs(stat, order))
    return grouped.select(
        *keys,
        F.lit(length).cast("bigint").alias("windowSeconds"),
        F.col("window.start").alias("windowStart"),
        F.col("window.end").alias("windowEnd"),
        *[c for c in grouped.columns if c not in (*keys, "window")],
    )


def pane_aggregates(
    samples: DataFrame,
    slide: float = DEFAULT_SLIDE,
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
    stat: str = STDDEV,
) -> DataFrame:
    """Mergeable statistics per series and slide.

    ``paneStart`` is in epoch seconds. The result may be written to a table and
    merged later, see :func:`merge_panes`. ``stat`` says what it can be merged
    to: the standard deviation, or the change with the oldest and newest sample.
    """
    step = minutes_to_seconds(slide)
    pane = floor_to(seconds_of(samples, time_col), step)
    extra = {
        STDDEV: [F.var_pop("value").alias("varianceOfSamples")],
        DELTA: [first_key().alias("oldest"), last_key().alias("newest")],
    }
    return (
        usable(samples, *keys, time_col)
        .withColumn("paneStart", pane)
        .groupBy(*keys, "paneStart")
        .agg(*basic_exprs(), *extra[stat])
    )


def fold_panes(
    parts: DataFrame,
    keys: Sequence[str] = (SERIES_KEY,),
    stat: str = STDDEV,
    marked: str | None = None,
) -> DataFrame:
    """One pane per series and slide from several parts of it, such as those of micro-batches.

    Parts are brought together by one aggregation, those of a task before the shuffle; a pane of a table
    has a bounded number of them, see :mod:`seriesmill.sources.dated`. ``marked`` names a boolean column:
    a pane has it if one of its parts does.
    """
    pane = [*keys, "paneStart"]
    folds = [
        F.sum("countOfSamples").alias("countOfSamples"),
        F.min("minValOfSamples").alias("minValOfSamples"),
        F.max("maxValOfSamples").alias("maxValOfSamples"),
        (F.sum("sumValOfSamples") / F.sum("countOfSamples")).alias("avgValOfSamples"),
        F.sum("sumValOfSamples").alias("sumValOfSamples"),
    ]
    if marked is not None:
        folds.append(F.max(marked).alias(marked))
    if stat == DELTA:
        return parts.groupBy(*pane).agg(
            *folds, F.min("oldest").alias("oldest"), F.max("newest").alias("newest")
        )
    # Each part as its number, total and squares around its mean, merged pairwise in a fixed order.
    part = F.struct(
        F.col("countOfSamples").cast("double").alias("n"),
        F.col("sumValOfSamples").alias("total"),
        (F.col("countOfSamples") * F.col("varianceOfSamples")).alias("squares"),
    )
    apart = _apart("a.n", "a.total", "b.n", "b.total")
    merged = (
        "aggregate(array_sort(parts), named_struct('n', 0D, 'total', 0D, 'squares', 0D), (a, b) -> named_struct("
        "'n', a.n + b.n, 'total', a.total + b.total,"
        f" 'squares', a.squares + b.squares + if(a.n > 0, {apart}, 0D)), a -> a.squares / a.n)"
    )
    grouped = parts.groupBy(*pane).agg(*folds, F.collect_list(part).alias("parts"))
    return grouped.withColumn("varianceOfSamples", F.expr(merged)).drop("parts")


def _apart(count: str, total: str, other_count: str, other_total: str) -> str:
    """What the distance of two means adds to the squares around them."""
    # Divided last, as totals often are exact where means can't be.
    distance = f"({total} * {other_count} - {other_total} * {count})"
    return (
        f"({distance} / {count}) * ({distance} / {other_count}) / ({count} + {other_count})"
    )


def merge_tasks(panes: DataFrame) -> int:
    """Tasks for a merge whose windows are far more than its panes.

    Left alone, Spark makes few tasks of small panes, just more than there are cores, and the windows of
    the last one come when all others are done.
    """
    return int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pane_runs(
    panes: DataFrame,
    windows: Sequence[float] = DEFAULT_WINDOWS,
    slide: float = DEFAULT_SLIDE,
    keys: Sequence[str] = (SERIES_KEY,),
    ends_after: int | None = None,
    ends_until: int | None = None,
    partitions: int | None = None,
    stat: str = STDDEV,
    marked: str | None = None,
) -> DataFrame:
    """Sliding-window statistics from panes, one row per run of equal windows.

    A run stands for the windows that end at ``fromEnd``, one slide later, and so
    on up to ``toEnd``. There are at most two runs per pane and window length,
    however many windows they stand for, so whatever can be done per run should
    be, before :func:`expand_runs`. All window lengths are merged together.

    ``ends_after`` (exclusive) and ``ends_until`` (inclusive) restrict the result
    to windows that end in that range, in epoch seconds; only the panes such
    windows can hold are read. ``partitions`` fixes the number of tasks for the
    merge, for sparse series where a small input makes a large result. ``marked``
    names a boolean column of the panes: only windows with such a pane are kept.
    """
    lengths, step = window_lengths(windows, slide)
    pane = F.col("paneStart")
    if ends_after is not None:
        panes = panes.where(pane > ends_after - lengths[-1])
    if ends_until is not None:
        panes = panes.where(pane < ends_until)

    # Window ends are grouped by block. A pane enters at `change` in the head of
    # its own block, and leaves at `change` from the tail the next block sees.
    roles = []
    for length in lengths:
        block = f"(paneStart - pmod(paneStart, {length}))"
        size = f"'windowSeconds', {length}L"
        roles.append(
            f"named_struct({size}, 'block', {block}, 'change', paneStart + {step}, 'inHead', true)"
        )
        if length > step:
            roles.append(
                f"named_struct({size}, 'block', {block} + {length},"
                f" 'change', paneStart + {length + step}, 'inHead', false)"
            )
    moves = panes.selectExpr("*", f"inline(array({', '.join(roles)}))")
    # The first pane of a block is never part of a tail.
    moves = moves.where(f"inHead or change > block + {step}")

    group = [*keys, "windowSeconds", "block"]
    if partitions is not None:
        moves = moves.repartition(partitions, *group)
    group_text = ", ".join(f"`{name}`" for name in group)
    in_order = f"partition by {group_text} order by change"
    up_to_here = f"over ({in_order})"
    whole = f"over ({in_order} rows between unbounded preceding and unbounded following)"
    after_here = f"over ({in_order} desc range between unbounded preceding and 1 preceding)"

    if stat == STDDEV:
        # Squares around the mean are merged pane by pane: what a pane adds to those of the panes
        # between it and the near end of its block. Only terms that are not negative are added, and
        # only panes of one window meet, so that no other level of the values spoils a result.
        before = f"over ({in_order} rows between unbounded preceding and 1 preceding)"
        beyond = f"over ({in_order} desc rows between unbounded preceding and 1 preceding)"
        moves = moves.selectExpr(
            "*",
            *[
                f"if(inHead, sum(if(inHead, {value}, null)) {before},"
                f" sum(if(inHead, null, {value})) {beyond}) as {name}"
                for name, value in (("nearCount", "countOfSamples"), ("nearSum", "sumValOfSamples"))
            ],
        )
        apart = _apart("nearCount", "nearSum", "countOfSamples", "sumValOfSamples")
        moves = moves.selectExpr(
            "*", f"countOfSamples * varianceOfSamples + if(nearCount > 0, {apart}, 0D) as addedSquares"
        )
    parts = {
        "n": ("sum", "countOfSamples"),
        "total": ("sum", "sumValOfSamples"),
        "least": ("min", "minValOfSamples"),
        "greatest": ("max", "maxValOfSamples"),
    }
    if stat == STDDEV:
        parts["squares"] = ("sum", "addedSquares")
    else:
        parts |= {"oldest": ("min", "oldest"), "newest": ("max", "newest")}
    if marked is not None:
        parts["marked"] = ("max", f"`{marked}`")
    frames = []
    for name, (fold, value) in parts.items():
        frames += [
            f"{fold}(if(inHead, {value}, null)) {up_to_here} as head_{name}",
            f"{fold}(if(inHead, null, {value})) {after_here} as tail_{name}",
            f"{fold}(if(inHead, null, {value})) {whole} as all_{name}",
        ]
    folded = moves.selectExpr(
        *[f"`{name}`" for name in group],
        "change",
        f"lag(change) {up_to_here} as previous",
        f"min(change) {after_here} as next",
        *frames,
    )
    # Two panes that change at the same window end give the same results.
    folded = folded.where("not change <=> previous")

    def both(name: str) -> str:
        if name in ("least", "greatest", "oldest", "newest", "marked"):
            pick = "least" if name in ("least", "oldest") else "greatest"
            return f"{pick}(tail_{name}, head_{name})"
        if name == "squares":
            apart = _apart("tail_n", "tail_total", "head_n", "head_total")
            return (
                "coalesce(tail_squares + head_squares"
                f" + if(tail_n > 0 and head_n > 0, {apart}, 0D), tail_squares, head_squares)"
            )
        return f"coalesce(tail_{name} + head_{name}, tail_{name}, head_{name})"

    first_end, last_end = f"block + {step}", "block + windowSeconds"
    lowest, highest = [], []
    if ends_after is not None:
        lowest = [f"{ends_after - ends_after % step + step}L"]
    if ends_until is not None:
        highest = [f"{ends_until}L"]

    def run(start: str, end: str, values: dict[str, str]) -> str:
        start = f"greatest({start}, {lowest[0]})" if lowest else start
        end = f"least({end}, {highest[0]})" if highest else end
        fields = {"fromEnd": start, "toEnd": end, **values}
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    # A run is a row of window ends with the same result. Until the first change
    # in a block its windows hold the whole tail.
    opening = run(first_end, f"change - {step}", {name: f"all_{name}" for name in parts})
    here = run("change", f"coalesce(next - {step}, {last_end})", {n: both(n) for n in parts})
    opens = f"previous is null and change > {first_end}"
    key_columns = [f"`{name}`" for name in keys]
    runs = folded.selectExpr(
        *key_columns,
        "windowSeconds",
        f"inline(if({opens}, array({opening}, {here}), array({here})))",
    ).where("n > 0 and fromEnd <= toEnd" + (" and marked" if marked is not None else ""))
    return runs.selectExpr(
        *key_columns,
        "windowSeconds",
        "fromEnd",
        "toEnd",
        "n as countOfSamples",
        "least as minValOfSamples",
        "greatest as maxValOfSamples",
        "total / n as avgValOfSamples",
        "total as sumValOfSamples",
        "if(n > 1, sqrt(squares / (n - 1)), null) as stddevValOfSamples"
        if stat == STDDEV
        else "newest.value - oldest.value as delta",
    )


def expand_runs(runs: DataFrame, slide: float = DEFAULT_SLIDE) -> DataFrame:
    """One row per window from rows that stand for a run of windows."""
    step = minutes_to_seconds(slide)
    others = [f"`{c}`" for c in runs.columns if c not in ("fromEnd", "toEnd")]
    ends = runs.selectExpr(*others, f"explode(sequence(fromEnd, toEnd, {step}L)) as end")
    after = others.index("`windowSeconds`") + 1
    return ends.selectExpr(
        *others[:after],
        "timestamp_seconds(end - windowSeconds) as windowStart",
        "timestamp_seconds(end) as windowEnd",
        *others[after:],
    )


def merge_panes(
    panes: DataFrame,
    windows: Sequence[float] = DEFAULT_WINDOWS,
    slide: float = DEFAULT_SLIDE,
    keys: Sequence[str] = (SERIES_KEY,),
    ends_after: int | None = None,
    ends_until: int | None = None,
    partitions: int | None = None,
    stat: str = STDDEV,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Sliding-window statistics from panes, one row per window; see :func:`pane_runs`.

    ``finish`` is applied to the rows that stand for runs of equal windows: what it does to the
    statistics is done once a run.
    """
    runs = pane_runs(panes, windows, slide, keys, ends_after, ends_until, partitions, stat)
    return expand_runs(runs if finish is None else finish(runs), slide)


def sliding_aggregates(
    samples: DataFrame,
    windows: Sequence[float] = DEFAULT_WINDOWS,
    slide: float = DEFAULT_SLIDE,
    time_col: str = INGEST_TIME,
    keys: Sequence[str] = (SERIES_KEY,),
    plan: str = "panes",
    partitions: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Statistics per series for every sliding window, several lengths at once.

    A window is labelled ``[end - length, end)``; a series without a sample in a
    window has no row for it. Batch only: see :mod:`seriesmill.streaming`.

    ``plan="panes"`` works as described above, whatever the lengths. ``plan="direct"`` gives each sample
    to each of its windows through Spark's time windows, whose deviations have two digits fewer at a
    level of 1e9. ``finish`` is applied as in :func:`merge_panes`, or to the windows of the direct plan.
    """
    lengths, step = window_lengths(windows, slide)
    if plan == "panes":
        panes = pane_aggregates(samples, slide, time_col, keys)
        partitions = partitions or merge_tasks(panes)
        return merge_panes(panes, windows, slide, keys, partitions=partitions, finish=finish)
    if plan == "direct":
        parts = [_windowed(samples, n, step, STDDEV, time_col, keys) for n in lengths]
        rows = reduce(DataFrame.unionByName, parts)
        return rows if finish is None else finish(rows)
    raise ValueError(f"unknown plan {plan!r}")
