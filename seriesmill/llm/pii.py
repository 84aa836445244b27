"""Personal data in whole texts by weak supervision: e-mail, IP addresses, payment cards, phone numbers.

Patterns propose spans. Labelers vote for or against each: its form, a check of its digits, a gazetteer,
and the words around it. Expectation-maximisation over the counts of vote patterns estimates the
labelers' reliabilities for each kind, and a logistic span classifier is trained on the posteriors with
the votes, the source pattern and the neighbouring characters as features. Spans of the four base patterns
that pass their base checks always stay; the classifier adds others that it is sure of.

All steps on texts are DataFrame operations. To the driver come counts of vote and feature patterns, whose
number the labelers bound.

Offsets are code points, ends exclusive. Defined cases: a null text is empty and has no spans. Rows that
repeat both doc_id and text get the same result each; null ids are like others. Other columns are not read,
and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import documents_only, stored
from seriesmill.llm.weak import VoteModel, estimate, vote

KINDS = ("email", "ip", "card", "phone")

# The base patterns, without ways to backtrack: a run that can't be part of a match isn't tried from each
# of its characters, and repetitions give nothing back. The matches are those of the plain patterns.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spans that only the classifier can bring in: spelt-out e-mail addresses, numbers without a country code.
WIDE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "phone": "+"}

# Gazetteers. Fixed values.
TOP_DOMAINS = "com org net edu gov info io co de fr es it nl uk us ca eu ch at be se no pl pt br mx jp cn in au".split()
CONTEXT = {
    "email": r"e-?mail|mail|contact|write to|address|kontakt|courriel|correo",
    "ip": r"\bip\b|address|host|server|login|client|adresse",
    "card": r"card|visa|master|amex|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel\b|call|mobile|fax|cell|telefon|t[eé]l[eé]phone|tel[eé]fono",
}
#: Against: what numbers are that only look alike.
COUNTER = r"version|release|isbn|order|invoice|serial|section|id\b|nr\b|no\.|token"
#: Card issuers by leading digits.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30[0-5]|36|38)"

AROUND = 32
SURE = 0.95
LABELERS = 4


def _found(text: Column, pattern: str) -> Column:
    """Matches with the length of the gap before each and what stands on either side."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    count = F.size(hits)
    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), count).alias("gap"), hits.alias("match"), F.slice(gaps, F.lit(2), count).alias("next")
    )
    return F.transform(
        zipped,
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            x["match"].alias("match"),
            F.right(x["gap"], F.lit(AROUND)).alias("before"),
            F.left(x["next"], F.lit(AROUND)).alias("after"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether the check digit is right, of a string of digits."""
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2))

    return F.aggregate(at, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _octets(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def candidates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, hash, kind, wide, match, before, after, start, end, base) for each span proposed, stored."""
    rows = documents_only(docs, id_column, text).toDF("id", "text").where("text IS NOT NULL")
    rows = rows.where(F.col("text").rlike("[0-9]") | F.col("text").contains("@") | F.col("text").rlike(r"[\[(]at[\])]"))
    parts = []
    for wide, patterns in ((False, PATTERNS), (True, WIDE)):
        for kind, pattern in patterns.items():
            needs = None if wide else _NEEDS.get(kind)
            found = _found(F.col("text"), pattern)
            if needs:
                found = F.when(F.col("text").contains(needs), found).otherwise(F.array().cast(_FOUND))
            parts.append(F.struct(F.lit(kind).alias("kind"), F.lit(wide).alias("wide"), found.alias("found")))
    each = rows.select("id", F.xxhash64("text").alias("hash"), F.explode(F.array(*parts)).alias("p"))
    each = each.select("id", "hash", "p.kind", "p.wide", F.posexplode("p.found").alias("i", "x"))
    each = each.select("id", "hash", "kind", "wide", "i", "x.*").dropDuplicates(["id", "hash", "kind", "wide", "i"])
    # the spans of one text and pattern, in their order
    earlier = Window.partitionBy("id", "hash", "kind", "wide").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(earlier)
    digits = F.regexp_replace("match", "[^0-9]", "")
    number = F.length(digits)
    base = (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", _octets(F.col("match")))
        .when(F.col("kind") == "card", F.when(number.between(12, 19), luhn(digits)).otherwise(False))
        .otherwise(number.between(9, 15))
    )
    made = each.select(
        "id", "hash", "kind", "wide", "match", "before", "after",
        (end - F.length("match")).cast("long").alias("start"), end.cast("long").alias("end"),
        (~F.col("wide") & base).alias("base"), base.alias("checked"), digits.alias("digits"),
    )
    # numbers that are no cards by their length aren't proposed
    return stored(made.where((F.col("kind") != "card") | number.between(12, 19)), "spans")


_FOUND = "array<struct<gap:int,match:string,before:string,after:string>>"


def votes() -> Column:
    """The votes on a candidate: form, check, gazetteer, context."""
    kind, match = F.col("kind"), F.col("match")
    around = F.lower(F.concat_ws(" ", "before", "after"))
    of = lambda **each: F.coalesce(*(F.when(kind == k, v) for k, v in each.items()), F.lit("1"))
    last = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
    number = F.length("digits")
    form = of(
        email=vote(match.rlike(r"\.[A-Za-z]{2,}$"), match.rlike(r"(?:^\.|\.\.|\.@|-$)")),
        ip=vote(match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), match.rlike("(?:^|[.])0[0-9]|[0-9]{4}")),
        card=vote(match.rlike(r"^(?:[0-9]{13,16}|(?:[0-9]{4}[ -]){3}[0-9]{4})$"), match.rlike("[ -]") & (number < 15)),
        phone=vote(match.rlike(r"^\+?[0-9(][0-9 ().-]{8,}$"), F.col("after").rlike("^[0-9]")),
    )
    check = of(
        email=vote(F.length(match) <= 254, F.length(match) > 254),
        ip=vote(F.col("checked"), ~F.col("checked")),
        card=vote(F.col("checked"), ~F.col("checked")),
        phone=vote(F.col("checked"), ~F.col("checked")),
    )
    listed = of(
        email=vote(last.isin(TOP_DOMAINS), last.rlike("[0-9]")),
        ip=vote(match.rlike(r"^(?:10|127|192\.168)\."), match.rlike(r"^0+\.|^255\.")),
        card=vote(F.col("digits").rlike(ISSUERS), F.col("digits").rlike("^[01789]")),
        phone=vote(match.rlike(r"^\+(?:1|3[0-9]|4[0-9]|[26-9])"), match.rlike(r"^\+0")),
    )
    context = of(
        **{k: vote(around.rlike(p), F.lower("before").rlike(rf"(?:{COUNTER})\W*$")) for k, p in CONTEXT.items()}
    )
    return F.concat(form, check, listed, context)


def _edge(side: Column) -> Column:
    """What the neighbouring character is: 0 none or white space, 1 a letter or digit, 2 other."""
    return F.when(side.rlike(r"^\s?$"), "0").when(side.rlike("^[A-Za-z0-9]$"), "1").otherwise("2")


def _pattern() -> Column:
    """The features of a candidate as digits: its votes, wide, the characters before and after."""
    return F.concat(
        F.col("votes"), F.when(F.col("wide"), "2").otherwise("0"),
        _edge(F.right("before", F.lit(1))), _edge(F.left("after", F.lit(1))),
    )


@dataclass(frozen=True)
class SpanModel:
    """A classifier for each kind; its weights are log odds of a feature's digit."""

    by_kind: dict[str, VoteModel]

    def probability(self) -> Column:
        made = F.lit(0.0)
        for kind, model in self.by_kind.items():
            made = F.when(F.col("kind") == kind, model.of_pattern(F.col("pattern"))).otherwise(made)
        return made


def _logistic(patterns: list[tuple[str, int, float]], steps: int = 300) -> VoteModel:
    """Logistic regression with soft labels over (feature digits, count, label), by Newton's method."""
    digits = np.array([[int(c) for c in p] for p, _, _ in patterns])
    count = np.array([n for _, n, _ in patterns], float)
    label = np.array([y for _, _, y in patterns])
    width = digits.shape[1]
    x = np.concatenate(
        [np.ones((len(digits), 1)), np.stack([digits == v for v in range(3)], axis=2).reshape(len(digits), -1)], axis=1
    )
    weights = np.zeros(x.shape[1])
    ridge = np.full(len(weights), 0.5)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (count * (label - p)) - ridge * weights
        step = np.linalg.solve((x * (count * p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    by_digit = weights[1:].reshape(width, 3)
    return VoteModel(float(weights[0]), tuple(tuple(map(float, w)) for w in by_digit))


def fit(spans: DataFrame) -> SpanModel:
    """The span classifier of a table with kind, votes and pattern, from all its rows.

    To the driver come at most 4 kinds by 3 to the fourth votes by 18 other features.
    """
    counts = spans.groupBy("kind", "votes", "pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    made = {}
    for kind in KINDS:
        rows = sorted((r["votes"], r["pattern"], r["n"]) for r in counts if r["kind"] == kind)
        if not rows:
            continue
        by_votes: dict[str, int] = {}
        for v, _, n in rows:
            by_votes[v] = by_votes.get(v, 0) + n
        model = estimate(list(by_votes.items()), LABELERS)
        odds = {v: model.prior + sum(w[int(c)] for w, c in zip(model.weights, v, strict=True)) for v in by_votes}
        made[kind] = _logistic([(p, n, float(1 / (1 + np.exp(-np.clip(odds[v], -30, 30))))) for v, p, n in rows])
    return SpanModel(made)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: n_email, n_ip, n_card, n_phone, base and spans.

    The numbers and ``base`` are of the base spans; ``base`` and ``spans`` are arrays of structs (start, rank
    of the kind, kind, end, probability) in order.
    """
    found = candidates(docs, id_column, text).withColumn("votes", votes())
    found = found.withColumn("pattern", _pattern())
    found = found.withColumn("probability", fit(found).probability())
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "end", "probability")
    kept = found.where(F.col("base") | ((F.col("probability") >= SURE) & _informed()))
    # an added span that begins within a base span of its kind is that span once more
    per = kept.groupBy("id", "hash").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(~F.col("base"), span))).alias("added"),
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
    )
    alone = F.filter(
        "added",
        lambda a: ~F.exists(
            "base", lambda b: (a["kind"] == b["kind"]) & (a["start"] < b["end"]) & (b["start"] < a["end"])
        ),
    )
    per = stored(per.withColumn("spans", F.array_sort(F.concat("base", alone))).drop("added"), "per-document")
    rows = documents_only(docs, id_column, text).toDF("id", "text").select("id", F.xxhash64("text").alias("hash"))
    joined = rows.join(per, rows["id"].eqNullSafe(per["id"]) & (rows["hash"] == per["hash"]), "left")
    none = F.array().cast(per.schema["spans"].dataType)
    return joined.select(
        rows["id"].alias(id_column),
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.coalesce("base", none).alias("base"),
        F.coalesce("spans", none).alias("spans"),
    )


def _informed() -> Column:
    """An added span needs a vote for it of its check, and one of gazetteer or context."""
    return (F.substring("votes", 2, 1) == "2") & F.substring("votes", 3, 2).contains("2") & ~F.substring("votes", 3, 2).contains("0")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
