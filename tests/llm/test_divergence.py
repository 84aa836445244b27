"""Distances of sources: SQL on the table, plain loops on made-up rows."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle import differences
from seriesmill.llm import divergence, queries

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=divergence.LEAST_DOCS, top=divergence.TOP):
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(FOLD))) for l, s, t in rows]
    made = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        frequency = Counter(term for d in own for term in set(d[2]))
        kept = {t for t, n in frequency.items() if n >= least}
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def p(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in counts if o != s]
            most = [(shares[s][t] - q[t], t) for t in kept if counts[s][t] and shares[s][t] > q[t]]
            for part, values in (("pair", pairs), ("term", most)):
                ordered = sorted(values, key=lambda x: (-x[0], x[1].encode()))
                made += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(ordered, 1) if part == "pair" or r <= top]
    return sorted(made)


def test_query_equals_sql(spark, sf):
    assert differences(queries.op11_source_divergence(spark, sf), sf, queries.OP11_SQL) is None


def frame(spark, rows):
    made = spark.createDataFrame(rows, "lang string, source string, text string")
    return made.selectExpr("*", "1 AS n", "2 AS term", "'x' AS col", "3 AS total")


def test_made_up_rows(spark):
    draw = np.random.default_rng(3)
    words = ["Éa", "éa", "a", "B", "b1c", "漢字", "it's", "x_y", "ZZ"]
    rows = [
        (str(draw.choice(["en", "de", "fr"])), f"s{min(int(draw.exponential(2)), 6)}", " ".join(draw.choice(words, draw.integers(0, 30))))
        for _ in range(900)
    ]
    # nulls, a language without kept terms, a group without terms, repeated rows
    rows += [(None, None, None), (None, "a", "once"), ("", "b", "once"), ("en", "none", ""), ("en", "digits", "1 2")]
    rows += [("en", "copies", "same same text")] * 60
    got = sorted(map(tuple, divergence.source_divergence(frame(spark, rows)).collect()))
    assert got == plain(rows)


def test_counts_beyond_a_long_and_stretches(spark, monkeypatch):
    total = 10**15
    row = spark.sql(f"SELECT {total - 7}L AS n, {total}L AS total, 3L AS kept").selectExpr(f"{divergence._p('n')} AS p")
    assert row.first().p == 1 + 10**9 * (total - 2) // (total + 15)
    rows = [("en", f"s{i % 3}", f"a b{i % 4} c{i % 5} " * (1 + i % 7)) for i in range(300)]
    monkeypatch.setattr(divergence, "CELLS", 7)
    monkeypatch.setattr(divergence, "COUNTED", 5)
    assert sorted(map(tuple, divergence.source_divergence(frame(spark, rows)).collect())) == plain(rows)


def test_empty_table(spark):
    assert divergence.source_divergence(frame(spark, []).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=60))
def test_runs_give_the_distance(pairs):
    a, b = (np.array(c, np.int64) for c in zip(*pairs))
    assert divergence.distance(divergence.runs(a), divergence.runs(b), len(a)) == int(np.abs(a - b).sum())
