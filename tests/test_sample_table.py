"""The sample table: rows as appended, and how few of its row groups a range reads."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from builders import rows_of, samples_frame
from seriesmill.schemas import SAMPLE_COLUMNS
from seriesmill.sources import dated
from seriesmill.sources.dated import DAY
from seriesmill.sources.sample_table import SampleTable, read_sample_table

BASE = 1_700_000_000 // DAY * DAY


def many(spark, count, series, start=BASE, span=DAY):
    """``count`` samples over a span; a third of them are of series s0."""
    frame = spark.range(count).select(
        F.concat(F.lit("i"), F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, "s0").otherwise(F.concat(F.lit("s"), F.col("id") % series)).alias("timeseriesId"),
        (F.col("id") * 0.5).alias("value"),
        F.timestamp_seconds(F.lit(start) + F.col("id") * 7919 % span).alias("timestamp"),
        F.lit("Raw").alias("metric"),
        F.lit("+00:00").alias("timeOffset"),
        (F.lit(start) + F.col("id") * 7919 % span).alias("unixTimestamp"),
        (F.lit(start) + F.col("id") * 7919 % span).alias("ingestUnixTimestamp"),
    )
    return frame.select(*SAMPLE_COLUMNS)


def row_groups(folder):
    """(first series, last series, first second, last second, rows) of each row group, by file."""
    made = {}
    for file in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        series, second = names.index("timeseriesId"), names.index("ingestUnixTimestamp")
        made[file] = [
            (
                g.column(series).statistics.min,
                g.column(series).statistics.max,
                g.column(second).statistics.min,
                g.column(second).statistics.max,
                g.num_rows,
            )
            for g in (meta.row_group(i) for i in range(meta.num_row_groups))
        ]
    return made


def test_rows_ranges_and_repeated_batches(spark, tmp_path):
    folder = str(tmp_path / "t")
    table = SampleTable(spark, folder)
    one = many(spark, 300, 20, span=3 * DAY)
    two = many(spark, 200, 30, start=BASE + DAY, span=2 * DAY)
    table.append(one, 0)
    table.append(two, 1)
    table.append(two, 1)
    every = one.unionByName(two)
    assert rows_of(read_sample_table(spark, folder), *SAMPLE_COLUMNS) == rows_of(every, *SAMPLE_COLUMNS)
    second = F.col("ingestUnixTimestamp")
    for start, end in ((BASE + DAY, BASE + 2 * DAY), (BASE + 5000, BASE + DAY + 1), (None, BASE + DAY), (BASE + DAY, None)):
        kept = every
        if start is not None:
            kept = kept.where(second >= start)
        if end is not None:
            kept = kept.where(second < end)
        got = read_sample_table(spark, folder, start, end)
        assert rows_of(got, *SAMPLE_COLUMNS) == rows_of(kept, *SAMPLE_COLUMNS)
        got = read_sample_table(spark, folder, start, end, ["s0", "s7", "none"])
        assert rows_of(got, *SAMPLE_COLUMNS) == rows_of(kept.where("timeseriesId in ('s0', 's7')"), *SAMPLE_COLUMNS)


def test_empty_tables_null_keys_and_runs(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert read_sample_table(spark, folder).count() == 0
    table = SampleTable(spark, folder, "one")
    table.append(samples_frame(spark, []), 0)
    assert read_sample_table(spark, folder).count() == 0
    nulls = samples_frame(spark, [("a", 1, BASE)])
    nulls = nulls.unionByName(nulls.withColumn("timeseriesId", F.lit(None).cast("string")))
    table.append(nulls.withColumn("day", F.lit("x")), 1)
    SampleTable(spark, folder, "two").append(samples_frame(spark, [("b", 2, BASE)]), 1)
    assert rows_of(read_sample_table(spark, folder), "timeseriesId", "value") == [("a", 1.0), ("b", 2.0)]
    assert SampleTable(spark, folder, "two").remove_days(BASE + DAY) == 1
    assert rows_of(read_sample_table(spark, folder), "timeseriesId") == [("a",)]


def test_batches_are_merged_and_stay_few(spark, tmp_path):
    folder = str(tmp_path / "t")
    table, frames = SampleTable(spark, folder), []
    for number in range(20):
        frames.append(many(spark, 30, 5, start=BASE + 40 * number, span=30))
        table.append(frames[-1], number)
        table.compact(number)
    entries = table._table.entries
    assert len(entries) <= 2 + 7 and max(e["level"] for e in entries) == 1
    got = read_sample_table(spark, folder)
    expected = frames[0]
    for frame in frames[1:]:
        expected = expected.unionByName(frame)
    assert rows_of(got, *SAMPLE_COLUMNS) == rows_of(expected, *SAMPLE_COLUMNS)


def test_a_range_reads_few_files_and_a_hot_series_is_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dated, "ROWS_PER_FILE", 1000)
    folder = str(tmp_path / "t")
    SampleTable(spark, folder).append(many(spark, 12000, 400, span=2 * DAY), 0)
    groups = row_groups(folder)
    assert 12 <= len(groups) <= 14
    # no file grows with the series that has a third of all rows
    assert max(sum(g[4] for g in file) for file in groups.values()) < 2500
    assert sum(any(g[0] == g[1] == "s0" for g in file) for file in groups.values()) >= 2
    # one series and one hour: a file or two may hold it
    low, high = BASE + 3600, BASE + 7200
    for series, most in (("s77", 2), ("s0", 2)):
        hit = [f for f, file in groups.items() if any(a <= series <= b and c < high and d >= low for a, b, c, d, _ in file)]
        assert 1 <= len(hit) <= most
    rows = read_sample_table(spark, folder, low, high, ["s77"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.partition("PushedFilters: [")[2]
    assert "EqualTo(timeseriesId,s77)" in pushed
    assert f"GreaterThanOrEqual(ingestUnixTimestamp,{low})" in pushed
    assert all(f"day={BASE // DAY}" in name for name in rows.inputFiles())


@pytest.mark.parametrize("series", ["s1", "absent"])
def test_files_have_bloom_filters(spark, tmp_path, series):
    folder = str(tmp_path / "t")
    SampleTable(spark, folder).append(many(spark, 500, 7), 0)
    (file,) = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    opened = reader.open(spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
    try:
        block = opened.getFooter().getBlocks().get(0)
        columns = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in block.getColumns()}
    finally:
        opened.close()
    # a column that is dictionary-encoded throughout needs none
    assert columns["ingestUnixTimestamp"] == -1
    assert read_sample_table(spark, folder, series=[series]).count() == (0 if series == "absent" else 48)
