"""Shards: counts, slots and mixture against the definition."""

import zlib
from collections import Counter

from seriesmill.llm import queries, sharding
from seriesmill.llm.common import table


def check(rows, shards=40):
    counts = Counter(r.shard for r in rows)
    if len(rows) >= shards:
        assert set(counts) == set(range(shards))
        assert max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    sizes = Counter(r.source for r in rows)
    by = Counter((r.source, r.shard) for r in rows)
    for source, n in sizes.items():
        for shard in counts:
            assert abs(by[source, shard] - n * counts[shard] / len(rows)) <= 3


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = queries.op3_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    check(rows)


def test_hot_source_nulls_and_repeated_rows(spark):
    rows = [(i, "é" * (i % 5), "hot" if i % 3 else f"s{i % 12}") for i in range(900)]
    rows += [(7, "same", None)] * 120 + [(None, None, "s1")] * 60
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS pid", "2 AS id")
    made = sharding.interleave(frame).collect()
    assert len(made) == len(rows)
    check(made)
    again = sharding.interleave(frame.repartition(3)).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))


def test_fewer_rows_than_shards_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, text string, source string")
    rows = sharding.interleave(frame).collect()
    assert [r.slot for r in rows] == [0, 0]
    assert len({r.shard for r in rows}) == 2
    assert sharding.interleave(frame.limit(0)).count() == 0
