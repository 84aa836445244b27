"""Personal data: base spans against the plain patterns, added spans by example."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import pii, queries
from seriesmill.llm.common import table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    spans = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if good(kind, m[0])
    ]
    return ",".join(s[2] for s in sorted(spans))


def check(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS hash", "'a' AS kind")
    rows = {r.doc_id: r for r in pii.personal_data(frame).select("*", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()}
    for i, text in enumerate(texts):
        assert rows[i].b == base(text), text
        assert set(rows[i].b.split(",")) - {""} <= set(rows[i].s.split(","))
        for kind in PLAIN:
            assert rows[i][f"n_{kind}"] == sum(x.startswith(kind) for x in rows[i].b.split(","))
    return rows


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123459 .-+()@ab_é😀\n", max_size=60), min_size=40, max_size=60))
def test_random_texts_equal_plain_patterns(spark, texts):
    check(spark, texts)


def test_special_texts(spark):
    check(spark, [
        None, "", "a@b.c_d@e.f", "a@b.c._d@e.f.", "1.1.1.1.1.1.1.1", "256.1.1.1 0255.000.1.1", "4111 1111 1111 1111",
        "4111111111111112", "+1 (017) 555-7713 ", "+1", "+12", "+1 2", "😀 x.y@mail7.example.com é 10.0.0.1",
        "1 " * 20000, "9" * 30000, "a." * 20000 + "@b.c", "x@" + "a." * 20000 + "com", "+1 " * 5000, "+1" + " " * 30000,
    ])


def test_query_equals_plain_patterns(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = queries.op1_pii(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) <= set(r.spans.split(","))


def test_query_runs_no_python(spark, sf):
    plan = queries.op1_pii(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_classifier_adds_what_context_supports(spark):
    texts = [f"mail me: user{i}@mail{i}.example.com or call +1 (01{i}) 555-77{i}3" for i in range(10)] * 4
    texts += [f"phone: (21{i}) 555-01{i}2 today" for i in range(10)]
    texts += ["write to jane [at] example [dot] com please", "clean text", "in the year 1999 we had 1234 rows"]
    rows = check(spark, texts)
    assert rows[len(texts) - 2].s == rows[len(texts) - 1].s == ""


def test_repeated_rows_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a@b.com"), (1, "a@b.com"), (1, None), (None, "x a@b.com")], "doc_id long, text string")
    rows = pii.personal_data(frame).collect()
    assert sorted(r.n_email for r in rows) == [0, 1, 1, 1]
    assert pii.personal_data(frame.limit(0)).count() == 0
