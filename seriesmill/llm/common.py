"""Shared helpers: scratch tables, Arrow batches, names, exact running offsets."""

from __future__ import annotations

import contextlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a batch that a Python worker holds at a time.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder of its own; a session on a
    cluster is refused, since its executors share no local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="seriesmill-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    if _recorded is not None:
        _recorded.append(folder)
    return folder


#: Where :func:`recording` notes the folders that operators make.
_recorded: list[str] | None = None


@contextlib.contextmanager
def recording(folders: list[str]) -> Iterator[None]:
    """Note the scratch folders made meanwhile, for :func:`remove`."""
    global _recorded
    before, _recorded = _recorded, folders
    try:
        yield
    finally:
        _recorded = before


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete scratch folders whose operators' results have been written elsewhere."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while folders:
        path = java(folders.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, lineage cut."""
    folder = scratch(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def arrow_batches(rows: DataFrame) -> DataFrame:
    """The rows; Python workers get them in small batches."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return rows


def arrow_rows(
    rows: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` with small batches, one result batch for each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return arrow_batches(rows).mapInArrow(each, schema)


def extended(
    rows: DataFrame, function: Callable[[list], dict[str, pa.Array]], column: str, added: T.StructType, name: str
) -> DataFrame:
    """The rows and one struct column ``name`` computed from the values of ``column``."""

    kinds = pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in added.fields])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = function(batch.column(column).to_pylist())
        struct = pa.StructArray.from_arrays(
            [pa.array(made[f.name], type=kinds.field(i).type) for i, f in enumerate(kinds)],
            fields=list(kinds),
        )
        return pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    schema = T.StructType([*rows.schema.fields, T.StructField(name, added)])
    return arrow_rows(rows, each, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents_only(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns alone, so that clashing names of other columns can't matter."""
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def position(pid: str = "pid", idx: str = "idx") -> list[Column]:
    """Number of the partition, and of the row within it. Only of use if written at once."""
    row = F.monotonically_increasing_id()
    return [F.shiftright(row, 33).alias(pid), row.bitwiseAND((1 << 33) - 1).alias(idx)]


#: Rows of a side that may be broadcast; a longer one is shuffled.
BROADCAST_ROWS = 500_000


def small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of a stored table, marked for a broadcast if they are ``most`` at most.

    The count comes from the Parquet files' footers.
    """
    return F.broadcast(rows) if rows.count() <= most else rows


def ascii_lower(word: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` would change other letters too."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, capitals, capitals.lower())
    )


def fixed_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few fixed rows, as a constant of the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))
