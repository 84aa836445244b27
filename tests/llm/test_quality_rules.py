"""Quality rules: exact counts against plain loops, verdicts against labels."""

import math
import re

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from seriesmill.llm import quality_rules, queries
from seriesmill.llm.common import table
from seriesmill.llm.weak import VoteModel, estimate

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1}
    hit = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(hit),
    )


@given(st.text(alphabet="ab \n\t\x0b\x1c\x85 é漢#|<.", max_size=80))
def test_counts_equal_plain_loops(text):
    assert quality_rules.measure(text)[:5] == plain(text)


def test_counts_of_special_texts():
    for text in (None, "", " \n\n", "a", "a b", "a a a a", "x " * 5000):
        assert quality_rules.measure(text)[:5] == plain(text)


def test_query_counts_and_base_rules(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = queries.op10_quality_rules(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        n, chars, symbols, lines, repeated = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = {r.doc_id: r.kept for r in queries.op10_quality_rules(spark, folder).collect() if not r.base_failed}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    pairs = [(kept[d], q == 1) for d, q in labels if d in kept]
    assert sum(a == b for a, b in pairs) >= 0.98 * len(pairs)


def test_estimate_needs_no_rows_and_is_stable():
    k = len(quality_rules.RULES)
    assert estimate([], k).prior == 0.0
    patterns = [("2" * k, 90), ("0" * k, 10), ("1" * k, 5)]
    assert estimate(patterns, k) == estimate(patterns[::-1], k)


def test_nulls_ties_clashing_columns_and_empty_table(spark):
    good = " ".join(f"word{i}" for i in range(100)) + "."
    rows = [(1, good, 5), (1, good, None), (None, good, 1), (2, None, 2), (3, "", 3), (4, "x " * 200, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, measures long")
    got = quality_rules.keep_good(frame)
    assert got.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == ["1", "1", "None"]
    assert quality_rules.keep_good(frame.limit(0)).count() == 0
    verdicts = quality_rules.verdicts(frame)
    assert verdicts.count() == 6


@pytest.mark.parametrize("function", [quality_rules.keep_good, quality_rules.verdicts])
def test_spark_compiles_the_code_of_the_verdict(spark, capsys, function):
    frame = spark.createDataFrame([(1, "a b c " * 30), (2, "word. " * 60)], "doc_id long, text string")
    function(frame).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?[0-9]+)", capsys.readouterr().out)]
    # -1: a method of more than 64 KB
    assert sizes and 0 < min(sizes) and max(sizes) < 16_000


def test_probability_of_votes_and_of_a_pattern(spark):
    model = VoteModel(0.25, ((-1.5, 0.0, 0.75), (-2.0, -0.125, 1.0)))
    rows = spark.createDataFrame([(a, b, f"{a}{b}") for a in range(3) for b in range(3)], "a int, b int, p string")
    made = rows.select("*", model.probability([rows.a, rows.b]).alias("v"), model.of_pattern(rows.p).alias("w")).collect()
    for r in made:
        want = 1 / (1 + math.exp(-(0.25 + model.weights[0][r.a] + model.weights[1][r.b])))
        assert r.v == r.w == pytest.approx(want)
