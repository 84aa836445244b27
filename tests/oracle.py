"""Compare a query with its SQL, value for value."""

from __future__ import annotations

from pathlib import Path

import duckdb


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def sql_rows(folder: str, sql: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()


def spark_rows(frame):
    return frame.columns, [tuple(row) for row in frame.collect()]


def differences(frame, folder: str, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs first."""
    ours, theirs = spark_rows(frame), sql_rows(folder, sql)
    if sorted(ours[0]) != sorted(theirs[0]):
        return f"columns {sorted(ours[0])} != {sorted(theirs[0])}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])} rows"
    left, right = normal_rows(*ours), normal_rows(*theirs)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
