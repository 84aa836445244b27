"""How far the sources of a language differ from each other and from the whole language, term by term.

A term is a run of letters and of characters beyond ASCII, only A-Z in lower case. A language keeps the V
terms that at least ``LEAST_DOCS`` of its documents hold. In a group with N occurrences of kept terms, a term
with ``count`` of them has p = 1 + floor(10^9 (count + 5) / (N + 5 V)), and two groups differ at a term by the
distance of their p.

The kept terms of a language are put in the order of their counts in all sources, those sources first whose
counts take the fewest values, so that equal counts stand together. Each source's column of this order is
run-length encoded; for a pair of sources the boundaries of both columns' runs are laid over each other, and
each piece adds the distance of its two p times its length. The order is cut into ranges that tasks
work on alone: a run that is cut adds its parts.

All arithmetic is on whole numbers. Defined cases: null text, language and source are empty strings; empty
texts have no terms, but their group appears; repeated rows count each; a table without rows gives none.
Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import arrow_batches, documents_only, small, stored

LEAST_DOCS = 30
#: Terms that are reported for each group.
TOP = 50
#: Entries (group, term) that a task counts before it hands them on.
COUNTED = 300_000
#: Cells (term, source) of a stretch of the order that is run-length encoded at once.
CELLS = 2_000_000

_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in their order."""
    return text.translate(_TERM).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the texts of a task, and a row without term for each group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            group = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(group[1])
            found = terms(text)
            group[0].update(found)
            group[1].update(set(found))
            size += len(group[1]) - before
            if size >= COUNTED:
                yield from map(_partial, held, held.values())
                held, size = {}, 0
    yield from map(_partial, held, held.values())


def _partial(group: tuple[str, str], counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    times, docs = counts
    n = len(times) + 1
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([name], pa.string()).take(pa.array(np.zeros(n, np.int32))) for name in group),
            pa.array([None, *times], pa.binary()).cast(pa.string()),
            pa.array([0, *times.values()], pa.int64()),
            pa.array([0, *map(docs.__getitem__, times)], pa.int64()),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values of a column start, and their values."""
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else np.empty(0, np.int64)
    return starts, column[starts]


def distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """The sum of the distances of two run-length encoded columns of a length."""
    pieces = np.union1d(a[0], b[0])
    at = [side[1][np.searchsorted(side[0], pieces, "right") - 1] for side in (a, b)]
    return int((np.abs(at[0] - at[1]) * np.diff(np.r_[pieces, length])).sum())


class _Language:
    """Sums of the pairs of columns and the greatest terms of each, for one language of a task."""

    def __init__(self, zeros: list[int]):
        self.zeros = np.array(zeros, np.int64)
        self.sums = np.zeros((len(zeros), len(zeros)), np.int64)
        self.top: list[list[tuple[int, str]]] = [[] for _ in zeros]

    def add(self, rows: pa.Table) -> None:
        n, width = rows.num_rows, len(self.zeros)
        entries = rows.column("entries").combine_chunks()
        offsets = entries.offsets.to_numpy() - entries.offsets[0].as_py()
        flat = entries.flatten()
        cols, ps = (flat.field(i).to_numpy() for i in (0, 2))
        at = np.repeat(np.arange(n), np.diff(offsets))
        values = np.tile(self.zeros, (n, 1))
        values[at, cols] = ps
        encoded = [runs(values[:, c]) for c in range(width)]
        for a in range(width):
            for b in range(a + 1, width):
                self.sums[a, b] += distance(encoded[a], encoded[b], n)
        above = ps - rows.column("whole").to_numpy()[at]
        names = rows.column("term")
        for c in range(width):
            mine = np.flatnonzero((cols == c) & (above > 0))
            if len(mine) > TOP:
                least = np.partition(above[mine], -TOP)[-TOP]
                mine = mine[above[mine] >= least]
            found = zip((-above[mine]).tolist(), names.take(pa.array(at[mine])).to_pylist(), strict=True)
            self.top[c] = heapq.nsmallest(TOP, [*self.top[c], *found])

    def result(self, lang: str) -> pa.RecordBatch:
        a, b = np.triu_indices(len(self.zeros), 1)
        made = [(int(x), int(y), None, int(self.sums[x, y])) for x, y in zip(a, b, strict=True)]
        made += [(c, None, term, -value) for c, top in enumerate(self.top) for value, term in top]
        columns = list(zip(*made, strict=True)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64())
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(made), pa.string()), *arrays], names=["lang", "a", "b", "term", "value"]
        )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and greatest terms of the task's range of the order."""
    lang, state, held, size = None, None, [], 0
    for batch in batches:
        starts, names = runs(batch.column("lang").to_numpy(zero_copy_only=False))
        for start, end, name in zip(starts, [*starts[1:], batch.num_rows], names, strict=True):
            part = batch.slice(start, end - start)
            if name != lang or size >= CELLS:
                if held:
                    state.add(pa.Table.from_batches(held))
                held, size = [], 0
            if name != lang:
                if state is not None:
                    yield state.result(lang)
                lang, state = name, _Language(part.column("zeros")[0].as_py())
            held.append(part)
            size += part.num_rows * len(state.zeros)
    if held:
        state.add(pa.Table.from_batches(held))
    if state is not None:
        yield state.result(lang)


def _p(count: str) -> str:
    """Exact, also where the product does not fit a long."""
    return (
        f"1 + cast(({count} + 5) as decimal(20, 0)) * 1000000000BD"
        " div (cast(total as decimal(20, 0)) + 5 * cast(kept as decimal(18, 0)))"
    )


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank) of each group.

    Part ``pair`` has the other sources of the language with the sum of the distances at all kept terms;
    part ``term`` the ``TOP`` terms that the group uses most beyond the language's share. Ranks go from 1
    by value descending, then by item.
    """
    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = documents_only(docs, lang, source, text).toDF("lang", "source", "text").select(*columns)
    partial = arrow_batches(rows).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # Dealt once: all sources of a term are in one task, whatever the size of its language.
    counted = stored(
        partial.repartition("lang", "term")
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries"))
        .where(F.col("term").isNull() | (F.col("docs") >= LEAST_DOCS)),
        "terms",
    )
    kept = counted.where(F.col("term").isNotNull()).selectExpr("lang", "term", "inline(entries)")
    groups = counted.where(F.col("term").isNull()).selectExpr("lang", "inline(entries)").select("lang", "source")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.approx_count_distinct("n").alias("kinds"))
    sizes = counted.where(F.col("term").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    by_kinds = Window.partitionBy("lang").orderBy("kinds", "source")
    info = stored(
        groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kinds", "kept")))
        .withColumn("col", F.row_number().over(by_kinds) - 1)
        .withColumn("zero", F.expr(f"if(kept > 0, {_p('0')}, 0)")),
        "groups",
    )
    languages = info.groupBy("lang").agg(
        F.expr("transform(array_sort(collect_list(struct(col, zero))), x -> x.zero)").alias("zeros"),
        F.sum("total").alias("total"), F.first("kept").alias("kept"),
    )
    languages = stored(languages, "languages")
    named = kept.join(small(info.select("lang", "source", "col", "total", "kept")), ["lang", "source"])
    vectors = (
        named.select("lang", "term", "n", F.struct("col", "n", F.expr(_p("n")).alias("p")).alias("entry"))
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("entry")).alias("entries"))
        .join(small(languages), "lang")
        .select("lang", "term", "entries", F.expr(_p("n")).alias("whole"), "zeros")
    )
    # dealt by the head of the order, as the bounds of the ranges are drawn from a sample at the driver
    dealt = stored(vectors, "vectors").repartitionByRange("lang", F.slice("entries.n", 1, 2), "term")
    ordered = dealt.sortWithinPartitions("lang", "entries", "term")
    found = stored(
        arrow_batches(ordered).mapInArrow(_stretches, "lang string, a int, b int, term string, value long"), "sums"
    )
    pairs = found.where("term IS NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # languages that keep no term have the same pairs, all of distance 0
    none = info.where("kept = 0").select("lang", F.col("col").alias("a"))
    nothing = none.join(none.withColumnRenamed("a", "b"), "lang").where("a < b").withColumn("value", F.lit(0).cast("long"))
    both = pairs.unionByName(nothing).selectExpr(
        "lang", "value", "inline(array(struct(a as col, b as other), struct(b as col, a as other)))"
    )
    names = small(info.select("lang", "col", "source"))
    others = names.select("lang", F.col("col").alias("other"), F.col("source").alias("item"))
    listed = both.join(others, ["lang", "other"]).select("lang", "col", F.lit("pair").alias("part"), "item", "value")
    most = found.where("term IS NOT NULL").select(
        "lang", F.col("a").alias("col"), F.lit("term").alias("part"), F.col("term").alias("item"), "value"
    )
    rank = F.row_number().over(Window.partitionBy("lang", "col").orderBy(F.desc("value"), "item")).cast("int")
    ranked = listed.withColumn("rank", rank).unionByName(most.withColumn("rank", rank).where(F.col("rank") <= TOP))
    return ranked.join(names, ["lang", "col"]).select("lang", "source", "part", "item", "value", "rank")
