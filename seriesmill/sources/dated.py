"""A growing Parquet table of timed rows that stays readable: batches, merged generations, a manifest.

Each micro-batch writes a folder of its own, with a folder for each day in it. A manifest lists what the
table consists of; it is replaced in one step, and readers follow it alone. Eight entries of a day that are
of one level are folded into one of the next level by a Spark job, so a day has at most seven entries a
level and eight to the power of the level batches in each. What a crash leaves behind between a write
and the manifest is in no manifest: the next attempt writes it again under the same name.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesmill.sources.notes import Note, delete

DAY = 24 * 60 * 60
DAY_COLUMN, SIZE_COLUMN = "day", "size"
#: Rows of a file, about; the number of files of a batch follows from it.
ROWS_PER_FILE = 500_000
#: Entries of a level that are merged into one of the next.
FAN = 8


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run a checkpoint belongs to; a new checkpoint gives a new name.

    Batch numbers start again with a new checkpoint, so rows of a table are only comparable
    within one run.
    """
    note = Note(spark, f"{checkpoint}/run-name")
    if note.value is None:
        note.write(uuid.uuid4().hex)
    return note.value


class DatedTable:
    """Rows by the day of ``time_col`` (epoch seconds), with a size for tables of several resolutions.

    ``fold`` makes one row of rows that belong together, such as the parts of a pane; it is given rows of
    several batches and must keep all columns. Rows are spread over files by the hash of ``spread_by``; with
    ``sorted_by`` each file has a range of these columns instead, in order, and ``options`` go to the writer.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        time_col: str,
        fold: Callable[[DataFrame], DataFrame],
        spread_by: Sequence[str] = (),
        sorted_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ):
        self.spark, self.path, self.time_col, self.fold, self.spread_by = spark, path, time_col, fold, spread_by
        self.sorted_by, self.options = sorted_by, options or {}
        self._note = Note(spark, f"{path}/manifest")
        value = self._note.value or {"schema": None, "entries": [], "replaced": []}
        self._schema = value["schema"]
        #: Entries are dicts of root, size, day, level, low and high batch, rows.
        self.entries: list[dict] = value["entries"]
        self._replaced: list[str] = value["replaced"]

    def _save(self) -> None:
        self._note.write({"schema": self._schema, "entries": self.entries, "replaced": self._replaced})

    def _folder(self, entry: dict) -> str:
        return f"{self.path}/{entry['root']}/{SIZE_COLUMN}={entry['size']}/{DAY_COLUMN}={entry['day']}"

    def _load(self, entries: Iterable[dict]) -> DataFrame:
        schema = StructType.fromJson(self._schema)
        return self.spark.read.schema(schema).parquet(*(self._folder(e) for e in entries))

    def _write(self, rows: DataFrame, root: str, count: int, groups: int) -> None:
        """The rows, with size and day, as files of about ROWS_PER_FILE."""
        files = max(1, -(-count // ROWS_PER_FILE))
        if self.sorted_by:
            # ranges of days, and of a day's rows where it has more than a file: none grows with a hot key
            order = [SIZE_COLUMN, DAY_COLUMN, *self.sorted_by]
            dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
            self._save_as(dealt, root)
            return
        slot = F.pmod(F.xxhash64(*self.spread_by), F.lit(files)) if self.spread_by else F.lit(0)
        dealt = rows.repartition(max(1, min(files * groups, count)), SIZE_COLUMN, DAY_COLUMN, slot)
        self._save_as(dealt, root)

    def _save_as(self, dealt: DataFrame, root: str) -> None:
        writer = dealt.write.mode("overwrite").options(**self.options).partitionBy(SIZE_COLUMN, DAY_COLUMN)
        writer.parquet(f"{self.path}/{root}")

    def append(self, rows: DataFrame, batch_id: int, sizes: Sequence[int] = (0,)) -> tuple[int, int] | None:
        """Add the rows of a micro-batch; returns the first and last second of those of the first size.

        Rows of a table of several sizes have a column ``size``. A batch that runs again has the same rows
        and replaces its own folder, so every row counts once.
        """
        second = F.col(self.time_col)
        day = ((second - F.pmod(second, F.lit(DAY))) / DAY).cast("int")
        dated = (rows if SIZE_COLUMN in rows.columns else rows.withColumn(SIZE_COLUMN, F.lit(sizes[0])))
        dated = dated.withColumn(DAY_COLUMN, day).persist()
        try:
            found = dated.groupBy(SIZE_COLUMN, DAY_COLUMN).agg(
                F.count(F.lit(1)).alias("rows"), F.min(second).alias("low"), F.max(second).alias("high")
            ).collect()
            kept = [e for e in self.entries if not (e["low"] == e["high"] == batch_id)]
            if not found:
                if len(kept) != len(self.entries):
                    self.entries = kept
                    self._save()
                return None
            root = f"b={batch_id}"
            self._write(dated, root, sum(r["rows"] for r in found), len(found))
            plain = [f for f in dated.schema.fields if f.name not in (SIZE_COLUMN, DAY_COLUMN)]
            self._schema = StructType(plain).jsonValue()
        finally:
            dated.unpersist()
        self.entries = kept + [
            {"root": root, "size": r[SIZE_COLUMN], "day": r[DAY_COLUMN], "level": 0, "low": batch_id,
             "high": batch_id, "rows": r["rows"]}
            for r in found
        ]
        self._save()
        first = [r for r in found if r[SIZE_COLUMN] == sizes[0]]
        return min(r["low"] for r in first), max(r["high"] for r in first)

    def read(
        self,
        upto_batch: int,
        since: int | None = None,
        until: int | None = None,
        size: int = 0,
        batch: int | None = None,
        days: Iterable[int] | None = None,
        but_batch: int | None = None,
    ) -> DataFrame | None:
        """Rows of the batches up to ``upto_batch``, or None if the days asked for hold none.

        Only the folders of the days from ``since`` to ``until``, in seconds, are read, or those of ``days``;
        of all batches, of one, or of all others.
        """
        wanted = None if days is None else set(days)
        entries = [
            e
            for e in self.entries
            if e["size"] == size
            and e["high"] <= upto_batch
            and (batch is None or e["low"] == e["high"] == batch)
            and (but_batch is None or not e["low"] == e["high"] == but_batch)
            and (since is None or since // DAY <= e["day"])
            and (until is None or e["day"] <= until // DAY)
            and (wanted is None or e["day"] in wanted)
        ]
        return self._load(entries) if entries else None

    def compact(self, before_batch: int) -> int:
        """Merge what there are FAN entries of, of batches before this one; returns how many are merged.

        Called when those batches can't run again. The folders that a merge replaces are deleted with the
        merge after it, as a reader may hold the manifest before.
        """
        groups = defaultdict(list)
        for entry in self.entries:
            if entry["high"] < before_batch:
                groups[entry["size"], entry["day"], entry["level"]].append(entry)
        full = sorted(k for k, v in groups.items() if len(v) >= FAN)
        # one level of a day at a time, the lowest: a merge has a folder for each day
        lowest = {k[:2]: k for k in reversed(full)}
        due = {k: sorted(groups[k], key=lambda e: e["low"])[:FAN] for k in lowest.values()}
        if not due:
            return 0
        for folder in self._replaced:
            delete(self.spark, f"{self.path}/{folder}")
        root = f"m={before_batch}-{uuid.uuid5(uuid.NAMESPACE_URL, repr(sorted(due))).hex[:8]}"
        parts = [
            self.fold(self._load(entries)).withColumn(SIZE_COLUMN, F.lit(size)).withColumn(DAY_COLUMN, F.lit(day))
            for (size, day, _), entries in due.items()
        ]
        merged = {id(e) for entries in due.values() for e in entries}
        self._write(reduce(DataFrame.unionByName, parts), root, sum(e["rows"] for v in due.values() for e in v), len(due))
        new = []
        for (size, day, level), entries in due.items():
            entry = {"root": root, "size": size, "day": day, "level": level + 1, "low": entries[0]["low"],
                     "high": max(e["high"] for e in entries), "rows": 0}
            entry["rows"] = self._load([entry]).count()
            new.append(entry)
        gone = [e for e in self.entries if id(e) in merged]
        self.entries = [e for e in self.entries if id(e) not in merged] + new
        self._replaced = self._without(gone)
        self._save()
        return len(merged)

    def _without(self, gone: list[dict]) -> list[str]:
        """The folders that hold what is gone: whole roots where nothing else of them is left."""
        used = {e["root"] for e in self.entries}
        return sorted(
            {e["root"] if e["root"] not in used else self._folder(e).removeprefix(f"{self.path}/") for e in gone}
        )

    def remove_days(self, before: int) -> int:
        """Drop the days that end before a second; returns how many.

        For a table that is only read back to a horizon. Samples later than that start a day anew.
        """
        gone = [e for e in self.entries if (e["day"] + 1) * DAY <= before]
        if not gone:
            return 0
        self.entries = [e for e in self.entries if (e["day"] + 1) * DAY > before]
        folders = self._without(gone)
        self._save()
        for folder in folders:
            delete(self.spark, f"{self.path}/{folder}")
        return len({e["day"] for e in gone})
