"""Near-duplicate join against all pairs."""

import random

import numpy as np
import pytest

from seriesmill.llm import jaccard_join as jj
from seriesmill.llm import queries
from seriesmill.llm.common import table
from seriesmill.llm.components import components


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Component of each row with an id, by all pairs."""
    sets = [(i, sets_of(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            if min(len(a), len(b)) * 4 < max(len(a), len(b)) * 3:
                continue
            both = len(a & b)
            if 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets if i is not None}


def check(spark, rows):
    got = jj.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == expected
    assert all(r.component_id is None for r in got if r.doc_id is None)


def variants(draw, count, changes):
    base = [f"w{draw.randint(0, 400)}" for _ in range(80)]
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randint(0, changes)):
            words[draw.randrange(len(words))] = f"x{draw.randint(0, 9)}"
        yield " ".join(words)


def test_random_groups_equal_all_pairs(spark):
    draw = random.Random(3)
    texts = [t for _ in range(12) for t in variants(draw, 12, 4)]
    passage = " ".join(f"shared{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"o{draw.randint(0, 9999)}" for _ in range(60)) for _ in range(80)]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  two"), (None, texts[0])]
    check(spark, rows)


def test_tree_and_blocks_find_what_stars_leave(spark, monkeypatch):
    monkeypatch.setattr(jj, "STARS", 0)
    monkeypatch.setattr(jj, "BLOCK", 7)
    draw = random.Random(4)
    check(spark, list(enumerate(t for _ in range(4) for t in variants(draw, 30, 8))))


def test_frequent_shingles_go_last(spark, monkeypatch):
    monkeypatch.setattr(jj, "OFTEN", 3)
    draw = random.Random(5)
    check(spark, list(enumerate(t for _ in range(6) for t in variants(draw, 25, 6))))


def test_query_equals_all_pairs(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = queries.op4_ngram_jaccard(spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_tree_pairs_keep_every_possible_pair():
    draw = np.random.default_rng(1)
    sizes = draw.integers(1, 60, 300).astype(np.int32)
    points = np.stack([np.bincount(draw.integers(0, jj.GROUPS, n), minlength=jj.GROUPS) for n in sizes]).astype(np.int32)
    found = jj.tree_pairs((points, sizes), (points, sizes))
    got = {(int(i), int(j)) for x, y in found for i, j in zip(x, y, strict=True)}
    for i in range(300):
        most = np.minimum(points[i], points).sum(axis=1)
        near = (4 * sizes >= 3 * sizes[i]) & (4 * sizes[i] >= 3 * sizes)
        for j in np.flatnonzero((7 * most >= 3 * (sizes[i] + sizes)) & near):
            assert (i, int(j)) in got


def test_repeated_ids_and_empty_table(spark):
    rows = [(5, "a b c d e f g"), (5, "h i j k l m n"), (3, "h i j k l m n"), (3, "h i j k l m n"), (9, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS digest")
    got = jj.similar_texts(frame)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(3, 3), (3, 3), (5, 3), (5, 3), (9, 9)]
    assert jj.similar_texts(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_words_that_polynomials_confuse_are_told_apart(spark):
    letters = "a"
    for _ in range(10):
        letters += letters.translate(str.maketrans("ab", "ba"))
    one, other = letters, letters.translate(str.maketrans("ab", "ba"))
    assert len(jj.shingles(one)) == 1 and jj.shingles(one)[0] != jj.shingles(other)[0]
    check(spark, [(1, one), (2, other), (3, one)])


def test_word_hashes_of_all_lengths():
    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(1, 40))) for _ in range(20000)})
    text = jj.Text(" ".join(words).encode())
    made = text.word_hashes()
    assert len(set(made.tolist())) == len(words)
    # the same wherever they stand
    turned = jj.Text(("\t".join(reversed(words)) + "\n").encode()).word_hashes()
    assert turned.tolist() == made.tolist()[::-1]
    assert len(jj.Text(b"").word_hashes()) == len(jj.Text(b" \n").word_hashes()) == 0


@pytest.mark.parametrize("n", [1, 3, 40, 300, 5000])
def test_parities_rule_out_no_similar_sets(n):
    draw = np.random.default_rng(n)
    for _ in range(60):
        a = np.unique(draw.integers(0, 2**64, n, np.uint64))
        kept = a[draw.random(len(a)) < draw.uniform(0.6, 1)]
        b = np.unique(np.concatenate([kept, draw.integers(0, 2**64, int(n * draw.uniform(0, 0.3)), np.uint64)]))
        if len(b):
            allowed = jj.parity_allows([jj.parities(a).tobytes()], [jj.parities(b).tobytes()], np.array([len(a) + len(b)]))
            assert allowed[0] or not jj.linked(a, b)
    far = [np.unique(draw.integers(0, 2**64, n + 20, np.uint64)) for _ in range(2)]
    bits = [[jj.parities(v).tobytes()] for v in far]
    assert not jj.parity_allows(*bits, np.array([sum(map(len, far))]))[0]


def test_other_ids_are_refused(spark):
    with pytest.raises(ValueError):
        jj.similar_texts(spark.createDataFrame([("x", "a b")], "doc_id string, text string"))
