"""Rounds and shuffles of the connected components."""

import itertools
import random

from seriesmill.llm import components as module
from seriesmill.llm.components import components


def recorded(monkeypatch):
    written, store = [], module.stored

    def keep(rows, name):
        written.append(rows._jdf.queryExecution().executedPlan().toString())
        return store(rows, name)

    monkeypatch.setattr(module, "stored", keep)
    return written


def test_stars_end_after_one_round_of_four_shuffles(spark, monkeypatch):
    written = recorded(monkeypatch)
    edges = spark.createDataFrame([(n, n % 3) for n in range(3, 60)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {n: n % 3 for n in range(60)}
    assert len(written) == 2
    assert written[1].count("Exchange hashpartitioning") <= 4


def test_labels_stand_for_the_edges_they_come_from(spark):
    draw = random.Random(7)
    edges = [(draw.randint(0, 200), draw.randint(0, 200)) for _ in range(150)]
    make = lambda rows: spark.createDataFrame(rows, "a long, b long")
    whole = {(r.node, r.label) for r in components(make(edges)).collect()}
    half = components(make(edges[:75])).where("node != label").toDF("a", "b")
    assert {(r.node, r.label) for r in components(half.union(make(edges[75:]))).collect()} == whole


def test_a_round_of_few_edges_writes_one_file(spark, monkeypatch):
    files, store = [], module.stored

    def keep(rows, name):
        made = store(rows, name)
        files.append(len(made.inputFiles()))
        return made

    monkeypatch.setattr(module, "stored", keep)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        edges = spark.createDataFrame([(n, n // 2) for n in range(1, 200)], "a long, b long")
        got = {r.node: r.label for r in components(edges).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == dict.fromkeys(range(200), 0)
    assert len(files) > 2
    assert max(files[1:]) == 1


def test_roots_of_pointers_in_few_rounds(spark, monkeypatch):
    draw = random.Random(5)
    nodes = draw.sample(range(10_000), 700)
    # a path of 500 nodes, a star, pairs, and trees; each ends in two nodes that point at each other
    pointers = dict(itertools.pairwise(nodes[:500])) | {n: nodes[501] for n in nodes[500:560]}
    pointers |= {nodes[499]: nodes[498], nodes[501]: nodes[502], nodes[502]: nodes[501]}
    pointers |= {n: nodes[i ^ 1] for i, n in enumerate(nodes) if 560 <= i < 600}
    pointers |= {nodes[600]: nodes[601], nodes[601]: nodes[600]}
    pointers |= {nodes[i]: nodes[draw.randrange(600, i)] for i in range(602, 700)}
    written = recorded(monkeypatch)
    got = module.roots(spark.createDataFrame(list(pointers.items()), "a long, b long")).collect()
    labels = {r.node: r.label for r in got}
    assert len(got) == len(pointers) == len(labels)

    def root(node):
        while pointers[pointers[node]] != node:
            node = pointers[node]
        return min(node, pointers[node])

    assert labels == {node: root(node) for node in pointers}
    assert len(written) <= 10
    assert module.roots(spark.createDataFrame([], "a long, b long")).count() == 0
