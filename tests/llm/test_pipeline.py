"""The pipeline: each stage against a brute-force version on the rows of the stage before."""

import re

import __spark_entry__
import corpus_pipeline
import pytest
from seriesmill.llm import quality_rules, queries
from seriesmill.llm.common import table
from test_decontaminate import brute as contaminated
from test_jaccard_join import brute as groups
from test_line_dedup import brute as deduplicated
from test_line_dedup import hashed
from test_packing import check as check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows of each stage, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    made = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        made.append(docs)
    return made


def pairs(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(frame.columns == COLUMNS for frame in stages[:-1])


def test_quality_rules(spark, stages):
    kept = {r.doc_id for r in quality_rules.verdicts(stages[0]).collect() if r.kept}
    texts = dict(pairs(stages[0]))
    assert sorted(pairs(stages[1])) == sorted((i, texts[i]) for i in kept)
    for i in kept:
        n, _, _, _, repeated, *_ = quality_rules.measure(texts[i])
        assert n >= 50 and 100 * repeated <= 50 * n


def test_line_dedup(spark, stages):
    before = set(pairs(stages[1]))
    cut = deduplicated(hashed(spark, pairs(stages[1])))
    # what is left of a copy has too few words
    want = [r for r in cut if r in before or len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) >= 50]
    assert sorted(pairs(stages[2]), key=str) == want
    assert len(want) < len(cut) and all(text.split() for _, text in want)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_document_of_each_group_stays(stages):
    rows = pairs(stages[2])
    want = {component for _, component in groups(rows).values()}
    assert sorted(pairs(stages[3])) == sorted(r for r in rows if r[0] in want)


def test_contaminated_documents_go(spark, stages):
    rows = pairs(stages[3])
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "benchmark").select("item_id", "text").collect()]
    clean = {doc for doc, _, _, found in contaminated(rows, items) if not found}
    assert sorted(pairs(stages[4])) == sorted(r for r in rows if r[0] in clean)
    assert len(clean) < len(rows)


def test_packing(stages):
    check_packing(stages[5].collect(), dict(pairs(stages[4])))


def test_run_and_registration(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == stages[5].columns
    assert rows.agg({"length": "sum"}).first()[0] == stages[5].agg({"length": "sum"}).first()[0]
    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in registered) == 1
    assert set(queries.SQL) <= set(queries.QUERIES)
