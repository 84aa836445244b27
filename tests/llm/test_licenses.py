"""Licence statements: unseen wordings, documents, special cases."""

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import licenses, queries
from seriesmill.llm.common import table

UNSEEN = [
    ("This dataset is licensed under the Apache License, Version 2.0 by its authors.", "apache"),
    ("Our code is released under the MIT License, see below.", "mit"),
    ("Text and images: Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("The tool is free, under the terms of the GNU Lesser General Public License, version 2.1", "lgpl"),
    ("Distributed under the GNU General Public License, version 3", "gpl"),
    ("Eclipse Public License 2.0", "epl"),
    ("Licensed under CC BY-NC 4.0 since May.", "cc-by-nc"),
    ("We went under the bridge at version 3.", "unknown"),
    ("Licensed under the Purple Monkey License 9.", "unknown"),
    ("His licence to sell hot dogs was revoked.", "unknown"),
]


@pytest.fixture(scope="module")
def model():
    return licenses.train([f"plain line number {i} of the text is here in words" for i in range(60)])


def test_unseen_wordings(model):
    for text, family in UNSEEN:
        shares = model.probabilities(text)
        assert max(shares, key=shares.get) == family, text


def test_paragraphs_of_licences_in_other_wordings(model):
    """Paragraphs that lack each fifth word, and prose on licences: recall and precision."""
    bodies = [(b, f) for f, made in licenses.BODIES.items() for b in made if len(b.split()) > 12]
    found = named = 0
    for body, family in bodies:
        for start in range(5):
            words = body.split()
            shares = model.probabilities(" ".join(w for i, w in enumerate(words) if i % 5 != start))
            best = max(shares, key=shares.get)
            if best != licenses.UNKNOWN and shares[best] >= licenses.SURE:
                named += 1
                found += best == family
    assert found >= 0.9 * 5 * len(bodies) and found >= 0.95 * named
    for text in (
        "Every license we looked at was long.", "The use of this software is subject to conditions of the seller.",
        "A fitness course for any person", "Without any warranty the shop sold the car.", "He may obtain a copy at the door.",
        "Notice: the library is closed, see above.", "The author wrote the following list of names in a file.",
    ):
        shares = model.probabilities(text)
        assert max(share for family, share in shares.items() if family != licenses.UNKNOWN) < licenses.SURE, text


def test_every_statement_has_a_cover_word(model):
    for family, text in licenses.statements():
        if family != licenses.UNKNOWN:
            assert set(model.cover) & set(re.findall(licenses._WORD, text.lower())), text


def test_columns_compute_the_model(spark, model):
    lines = spark.createDataFrame([(t,) for t, _ in UNSEEN] + [("",), ("mit",)], "line string")
    for r in licenses.classify(lines, model).collect():
        shares = model.probabilities(r.line)
        best = max(shares, key=shares.get)
        assert abs(shares[best] - r.probability) < 1e-6
        assert r.family == (best if shares[best] >= licenses.SURE else licenses.UNKNOWN)


def test_query_finds_the_statements_of_the_documents(spark, sf):
    known = {
        "cc-by-nc": "Licensed under CC BY-NC 4.0.", "mit": "Released under the MIT License.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "apache": "Licensed under the Apache License, Version 2.0.", "proprietary": "All rights reserved.",
    }
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = queries.op7_license_scan(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        lines = [x for x in texts[r.doc_id].split("\n") if x in known.values()]
        assert r.families == ",".join(sorted(f for f, x in known.items() if x in lines))
        assert r.n_paragraphs == r.n_confirmed == len(lines)


def test_query_runs_no_python(spark, sf):
    plan = queries.op7_license_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_nulls_repeated_rows_clashing_names_and_empty_table(spark):
    mit = "Some text here.\nReleased under the MIT License.\nReleased under the MIT License."
    rows = [(1, mit), (1, mit), (None, mit), (2, None), (3, ""), (4, "under " * 20000), (5, "a\nb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line", "2 AS hash")
    got = sorted(((r.doc_id, r.families, r.n_paragraphs) for r in licenses.license_scan(frame).collect()), key=str)
    assert got == sorted(
        [(1, ["mit"], 2), (1, ["mit"], 2), (None, ["mit"], 2), (2, [], 0), (3, [], 0), (4, [], 0), (5, [], 0)], key=str
    )
    assert licenses.license_scan(frame.limit(0)).count() == 0


def test_paragraphs_without_a_cover_word_have_no_family(model):
    """Every n-gram of other words together, the best case of a family, leaves it behind."""
    unknown = model.classes.index(licenses.UNKNOWN)
    lead = [b - model.bias[unknown] for b in model.bias]
    for gram, weights in model.weights.items():
        if not set(gram.split(" ")) & set(model.cover):
            lead = [o + max(w - weights[unknown], 0) for o, w in zip(lead, weights, strict=True)]
    assert max(o for i, o in enumerate(lead) if i != unknown) < 0


def test_scan_finds_wrapped_notices_and_other_wordings(spark):
    prose = "\n".join(f"plain line number {i} of the text is here in words." for i in range(40))
    notices = [(body, family) for family, bodies in licenses.BODIES.items() for body in bodies if len(body) > 100]
    texts = [
        ("\n".join(f"{mark}{line}" for line in textwrap.wrap(body, width)), family)
        for body, family in notices for width in (40, 70, 78) for mark in ("", "# ", " * ")
    ]
    texts += [
        ("You may copy and change the whole text of it under the terms of the GNU Lesser\nGeneral Public License, version 2.1", "lgpl"),
        ("The pictures are here under the Creative Commons Attribution-\nNonCommercial 4.0 International License", "cc-by-nc"),
        # without a word of the former cover
        ("obtaining a copy of this and associated documentation", "mit"),
        ("provided that the following conditions are met", "bsd"),
        ("GNU General Public, version 3", "gpl"), ("Apache 2.0", "apache"),
    ]
    frame = spark.createDataFrame([(i, f"{prose}\n\n{t}\n\n{prose}") for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    model = licenses.fit(frame)
    got = {r.doc_id: r for r in licenses.license_scan(frame).collect()}
    for i, (text, family) in enumerate(texts):
        shares = model.probabilities(" ".join(re.sub(r"(?m)^ ?[#*] ", "", text).replace("-\n", "-").split()))
        want = [family] if shares[family] >= licenses.SURE else []
        assert got[i].families == want, text
        assert want or "\n" not in text


def test_background_of_a_small_table_is_all_its_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(licenses, "train", seen.append)
    frame = spark.createDataFrame([(f"line {i}\nline {i + 1}\nlicensed as {i}",) for i in range(0, 30, 2)], "text string")
    licenses.fit(frame)
    assert seen == [sorted(f"line {i}" for i in range(30))]
    monkeypatch.setattr(licenses, "BACKGROUND", 7)
    licenses.fit(frame)
    hashed = frame.select(F.explode(F.split("text", "\n")).alias("line")).where("line LIKE 'line%'").distinct()
    assert seen[1] == sorted(r.line for r in hashed.orderBy(F.xxhash64("line")).limit(7).collect())
