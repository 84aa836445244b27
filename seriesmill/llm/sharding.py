"""Proportional stratified interleaving of documents into shards.

Within each source, rows are ranked by a seeded hash. Rank plus a fixed share of one that the source's
hash gives, by the source's number of rows, is the row's place in the whole; rows sorted by it and cut into
equal parts give shards of which each has every source in proportion, give or take a row or two. Counts
of shards differ by one at most (law ``rows``).

Both rankings are exact and distributed: rows are sorted by range, numbered within partitions, and the
partitions' counts, a few rows each, give the numbers before them. So a source with a third of all rows
is in many partitions. Texts are reduced to size and checksum before any shuffle.

Defined cases: a null text has no bytes; a null source is a source of its own; null or repeated ids are
rows like others, and rows that are equal in all that is read take neighbouring places. Other columns are
not read, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import documents_only, position, small, stored

SHARDS = 40
SEED = 20240131
#: Bytes counted for a document beside its text.
OVERHEAD = 16


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows sorted by ``order``, with the numbers pid and idx of their partition and within it, stored."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(sorted_rows.select("*", *position()), name)


def _unit(value: Column) -> Column:
    """A number from 0 to below 1 that the value's hash gives."""
    return F.pmod(F.xxhash64(F.lit(SEED), value), F.lit(1 << 20)) / F.lit(float(1 << 20))


def interleave(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot): one row for each document."""
    rows = documents_only(docs, id_column, text, source).toDF("id", "text", "source")
    rows = rows.select(
        "id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("crc"),
    ).withColumn("hash", F.xxhash64(F.lit(SEED), "id", "size", "crc"))
    ranked = _numbered(rows, ["source", "hash", "id", "size", "crc"], "ranked")
    earlier = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = ranked.groupBy("source", "pid").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"))
    spans = stored(
        spans.select(
            F.col("source").alias("s"), F.col("pid").alias("p"), "first",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy("source")).alias("total"),
        ),
        "spans",
    )
    rank = F.col("before") + F.col("idx") - F.col("first")
    placed = ranked.join(small(spans), (F.col("pid") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "source", "size", "crc", "hash", ((rank + _unit(F.col("source"))) / F.col("total")).alias("place")
    )
    ordered = _numbered(placed, ["place", "source", "hash", "id", "size", "crc"], "ordered")
    # one row for each partition
    running = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy(F.col("pid").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(
        "p", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"),
        F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    number = F.col("before") + F.col("idx")
    shard = F.expr(f"(number * {shards}) div total")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        ordered.join(F.broadcast(counts), F.col("pid") == F.col("p"))
        .withColumn("number", number)
        .withColumn("shard", shard)
        .select(
            F.col("id").alias(id_column), F.col("source").alias(source), "size", F.col("crc").alias("text_crc32"),
            F.col("shard").cast("int").alias("shard"), (F.col("number") - start).alias("slot"),
        )
    )
