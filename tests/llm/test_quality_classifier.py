"""Quality classifier: accuracy on held-out rows, features, special cases."""

import zlib

import duckdb
import numpy as np

from seriesmill.llm import quality_classifier as qc
from seriesmill.llm import queries
from seriesmill.llm.common import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op8_quality_classifier(spark, folder).collect()}
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    test = [(rows[d], q) for d, q in labels if rows[d].held_out]
    good = [r.score for r, q in test if q == 1]
    bad = [r.score for r, q in test if q == 0]
    assert np.mean([r.predicted == q for r, q in test]) >= 0.97
    # area under the curve
    assert np.mean(np.array(good)[:, None] > np.array(bad)) >= 0.98


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = "some words, an École and 漢字 again again\tno no\n" * 50 + "a b  a b " + "longer" * 40
    whole = np.sort(qc.features(text))
    for size in (1, 7, 100, len(text)):
        monkeypatch.setattr(qc, "CHUNK", size)
        assert np.array_equal(np.sort(qc.features(text)), whole)
    for spaces in ("", " ", " \n ", "word", "word "):
        monkeypatch.setattr(qc, "CHUNK", 1)
        parts = np.sort(qc.features(spaces))
        monkeypatch.setattr(qc, "CHUNK", 1 << 20)
        assert np.array_equal(parts, np.sort(qc.features(spaces)))
    # a word beyond the longest one is cut
    monkeypatch.setattr(qc, "CHUNK", 100)
    monkeypatch.setattr(qc, "LONGEST_WORD", 100)
    assert len(qc.features("x" * 1000)) > 0


def test_no_labels_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 3), (2, None, 4), (None, "", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 1), (77, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        rows = qc.scores(docs, qc.fit(docs, known)).collect()
        assert [(r.score, r.predicted) for r in rows] == [(0.5, 1)] * 3
    assert qc.scores(docs.limit(0), qc.fit(docs.limit(0), labels)).count() == 0


def test_learning_is_repeatable_and_uses_labels_only_as_asked():
    rows = [np.unique(qc.features(t), return_counts=True) for t in ["good words here"] * 20 + ["### $$$ %%%"] * 20]
    labels = np.array([1] * 20 + [0] * 20)
    a, b = qc.train(rows, labels), qc.train(rows, labels)
    assert np.array_equal(a.weights, b.weights)
    assert a.score("good words here") > 0.5 > a.score("### $$$ %%%")
