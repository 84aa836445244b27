"""Connected components of a table of edges, by alternating large-star and small-star steps; of pointers, by doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from seriesmill.llm.common import stored

ROUNDS = 60
#: Edges of a file of a round, if there are fewer files than tasks for that.
FILE_EDGES = 10_000


def _nearest(neighbours: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours v. Pre-aggregated, so that hubs are no burden."""
    return neighbours.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def _counted(rows: DataFrame, before: dict | None = None) -> tuple[DataFrame, dict]:
    """The edges, written, with their number and sum: equal for equal edges.

    There are no more files than those of the round before ask for: no task opens and writes one for a few edges.
    """
    if before is not None:
        rows = rows.coalesce(-(-before["n"] // FILE_EDGES) or 1)
    seen = Observation()
    state = (F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("sum"))
    return stored(rows.observe(seen, *state), "edges"), seen.get


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of the edges (a, b); label is the least node of the component.

    Every round writes its edges to the shared folder. It ends when each node points at the least node
    it can reach, which takes a number of rounds in the order of the logarithm of the longest path; one
    round for edges that are such stars already. Labels found before can stand for the edges they come from.
    """
    rows, before = _counted(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(ROUNDS):
        # large star: larger neighbours are handed to the least neighbour
        both = rows.union(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the node and its smaller neighbours are handed to the least of them; one shuffle by the node
        # serves the distinct rows and their least
        near = large.repartition("u").distinct().withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = (
            near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        rows, state = _counted(small, before)
        if state == before:
            return rows.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label").union(
                rows.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = state
    raise RuntimeError(f"no end after {ROUNDS} rounds")


def roots(pointers: DataFrame) -> DataFrame:
    """(node, label) for each node of the pointers (a, b), one of each node; label is a node of the component.

    Every b must have a pointer too, and every path must end in two nodes that point at each other; the lesser
    one is the label. A round doubles the pointers of the nodes that haven't reached it yet, so the
    number of rounds is the logarithm of the longest path.
    """
    seen = Observation()
    of = lambda rows: rows.select(F.col("a").alias("b"), F.col("b").alias("c"), *rows.columns[2:])
    ends = F.col("c") == F.col("a")
    rows = pointers.join(of(pointers), "b").select(
        "a", F.when(ends, F.least("a", "b")).otherwise(F.col("c")).alias("b"), ends.alias("done")
    )
    left = F.sum((~F.col("done")).cast("long")).alias("left")
    rows = stored(rows.observe(seen, left), "pointers")
    done, most = rows.where("done"), seen.get["left"] or 0
    for _ in range(ROUNDS):
        if not most:
            return done.select(F.col("a").alias("node"), F.col("b").alias("label"))
        on_the_way, seen = rows.where("NOT done"), Observation()
        further = on_the_way.select("a", "b").join(of(done.union(on_the_way)), "b").select("a", F.col("c").alias("b"), "done")
        rows = stored(further.coalesce(-(-most // FILE_EDGES)).observe(seen, left), "pointers")
        done, most = done.union(rows.where("done")), seen.get["left"] or 0
    raise RuntimeError(f"no end after {ROUNDS} rounds")
