"""Token ids of documents in files of Simple-8b segments, in ascending order of doc_id.

A table of files has a row for each segment: whole documents until there are SEGMENT ids, or fewer where
a batch of rows ends. Parts are ranges of doc_id. The files are Parquet with the coded segment as a binary
column, so that they can lie in any store that Spark writes to.

Defined cases: a null or empty text is the end id alone. Null ids come first. Rows with the same doc_id
are in the order of a hash of their texts; equal rows follow each other. Other columns are not read, and
an empty table gives files without segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm import simple8b
from seriesmill.llm.common import BATCH_ROWS, documents_only, stored
from seriesmill.llm.tokens import encoder, grouped

END = 2
SEGMENT = 1 << 15
#: Segments that are coded together, and that are decoded before their rows are handed on.
SEGMENTS_AT_ONCE = 32


def write_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The table of files (part, segment, before, n_ids, ids, lengths, coded), as written.

    ``before`` counts the ids of the part's earlier segments; ``ids`` are doc_ids, ``lengths`` their
    numbers of token ids.
    """
    rows = documents_only(docs, id_column, text).toDF("id", "text").withColumn("hash", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "id", "hash").sortWithinPartitions("id", "hash")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, own = TaskContext.get().partitionId(), 0, 0, encoder(tokenizer)
        end = np.array([END], "<u4").tobytes()
        for batch in grouped(batches):
            segments: list[tuple[list, list[int], list[bytes]]] = []
            flat, at = own.encode_batch(batch.column(1))
            for doc_id, low, high in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                ids = flat[low:high].tobytes() + end
                if not segments or sum(segments[-1][1]) >= SEGMENT:
                    segments.append(([], [], []))
                for column, x in zip(segments[-1], (doc_id, len(ids) // 4, ids), strict=True):
                    column.append(x)
            coded: list[bytes] = []
            for first in range(0, len(segments), SEGMENTS_AT_ONCE):
                part_of = segments[first : first + SEGMENTS_AT_ONCE]
                coded += simple8b.encode([np.frombuffer(b"".join(s[2]), "<u4") for s in part_of])
            sizes = [sum(s[1]) for s in segments]
            starts = [before + sum(sizes[:i]) for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(segments), pa.int32()),
                    pa.array(range(number, number + len(segments)), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([s[0] for s in segments], pa.list_(batch.schema.field(0).type)),
                    pa.array([s[1] for s in segments], pa.list_(pa.int64())),
                    pa.array(coded, pa.binary()),
                ],
                names=["part", "segment", "before", "n_ids", "ids", "lengths", "coded"],
            )
            number, before = number + len(segments), before + sum(sizes)

    schema = f"part int, segment int, before long, n_ids long, ids array<{kind}>, lengths array<long>, coded binary"
    return stored(ordered.mapInArrow(write, schema), "token-files")


def read_tokens(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ids are little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before. The sizes of the parts are summed up in one task:
    one row for each part.
    """
    kind = files.schema["ids"].dataType.elementType.simpleString()
    sizes = files.groupBy(F.col("part").alias("p")).agg(F.sum("n_ids").alias("n"))
    running = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("p", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("part_start"))
    rows = files.join(F.broadcast(starts), F.col("part") == F.col("p")).select(
        (F.col("part_start") + F.col("before")).alias("start"), "ids", "lengths", "coded"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SEGMENTS_AT_ONCE):
                yield _decoded(batch.slice(at, SEGMENTS_AT_ONCE))

    schema = f"id {kind}, start long, n_tokens long, ids binary"
    return rows.mapInArrow(read, schema).withColumnRenamed("id", id_column)


def _decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
    names, starts, lengths, parts = [], [], [], []
    for start, ids, sizes, coded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        values = simple8b.decode(coded).astype("<u4")
        ends = np.cumsum(sizes)
        names += ids
        lengths += sizes
        starts += (start + ends - sizes).tolist()
        parts += [values[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    kind = batch.schema.field("ids").type.value_type
    return pa.RecordBatch.from_arrays(
        [pa.array(names, kind), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())],
        names=["id", "start", "n_tokens", "ids"],
    )
