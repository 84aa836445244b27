"""Spelling variants against plain loops; pivots against all pairs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import queries, spelling
from seriesmill.llm.common import table

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    times = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            times[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in times.items() if len(w) >= 7 and n >= 2}
    near, holes = {w: set() for w in words}, defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(found, key=lambda x: (-words[x], x)) for w, found in near.items() if found}
    form = {w: f for w, f in best.items() if words[f] >= 10 * words[w]}
    made = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        made.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(made, key=lambda r: r[0])


def found(rows):
    return sorted(map(tuple, rows.collect()), key=lambda r: r[0])


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert found(queries.op12_spelling_variants(spark, sf)) == plain(rows)


def frame(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string")
    return made.selectExpr("*", "1 AS word", "2 AS n", "3 AS key", "4 AS root")


def test_chains_ties_nulls_and_long_words(spark):
    # a chain of three forms, a tie, repeated letters, words beyond ASCII, capitals, words of many letters
    counts = {"kontrast": 5000, "kontrasd": 300, "kontasd": 20, "ontasde": 2, "kontrash": 300, "aaaaaaaa": 3,
              "aaaaaaaaa": 40, "éèêëàâä": 2, "éèêëàâ×": 25, "ÉÈÊËÀÂÄ": 3, "zz" * 3000: 2, "zz" * 2999 + "z": 30}
    draw, rows = np.random.default_rng(5), []
    for word, n in counts.items():
        rows += [(int(d), word.upper() if word.isascii() and d % 3 == 0 else word) for d in draw.integers(0, 10**6, n)]
    rows += [(None, None), (1, ""), (2, "kontrast" + "、" + "kontrast 7"), (None, "kontrast kontrasd")] * 2
    draw.shuffle(rows)
    rows = [(None if d is None else int(d), t) for d, t in rows]
    got = found(spelling.spelling_variants(frame(spark, rows)))
    assert got == plain(rows)
    assert any(r[1] != r[2] for r in got if r[1])
    assert found(spelling.spelling_variants(frame(spark, rows).limit(0))) == []


words = st.lists(st.text("abcé", min_size=7, max_size=11), min_size=1, max_size=40, unique=True)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@settings(max_examples=150, deadline=None)
@given(words)
def test_pivots_find_all_near_words(vocabulary):
    import pyarrow as pa

    # variants of each word, so that there are near ones
    vocabulary = sorted({v for w in vocabulary for v in (w, w[:3] + "b" + w[3:], w[:2] + "a" + w[3:], w + "c", "b" + w)})
    times = np.zeros(1 << 16, np.int64)
    for w in vocabulary:
        raw = w.encode("latin-1")
        for i in range(len(raw) - 1):
            times[(raw[i] << 8) | raw[i + 1]] += 1
    rows = spelling._entries(times)(pa.RecordBatch.from_arrays([pa.array(vocabulary)], names=["word"])).to_pylist()
    index = defaultdict(set)
    for r in rows:
        if not r["probe"]:
            index[r["key"]].add((r["word"], r["last"]))
    pairs = {
        frozenset((r["word"], s)) for r in rows if r["probe"] for s, last in index[r["key"]]
        if r["last"] <= last and near(r["word"], s)
    }
    assert pairs == {frozenset((a, b)) for a in vocabulary for b in vocabulary if near(a, b)}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 9)), min_size=3, max_size=8, unique_by=lambda x: x[0]))
def test_pivots_are_the_lightest_pair(chosen):
    chosen.sort()
    places, weights = [p for p, _ in chosen], [w for _, w in chosen]
    a, b = spelling.pivots(places, weights)
    own = dict(chosen)
    assert b - a >= 2
    assert own[a] + own[b] == min(own[x] + own[y] for x in places for y in places if y - x >= 2)
