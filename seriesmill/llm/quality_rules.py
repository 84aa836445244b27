"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of vote
patterns estimates how often each rule gives each vote for good and for bad documents. A document
is kept when its posterior probability of being good is at least one half, unless it fails one of two
base rules.

Defined cases: a null text is an empty one, which has no words and so fails the base rules. Rows are
judged one by one, whatever their doc_id; repeated rows get the same verdict. Other columns are not
read, and an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm.common import documents_only, extended, free_name, stored
from seriesmill.llm.weak import VoteModel, estimate

#: Measures of a text. The first five are exact counts, the others serve the rules.
LEAST_WORDS = 50
MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_ended", "n_upper", "n_letters", "n_bangs", "n_top")]
)

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
#: ASCII letters and every byte of a longer UTF-8 sequence.
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))


def _without(text: bytes, drop: bytes) -> int:
    return len(text.translate(None, drop))


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that occur twice or more; count of the commonest word."""
    n = len(words)
    if not n:
        return 0, 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, itertools.count()), np.int64, n)
    top = int(np.bincount(ids).max())
    if n < 4:
        return 0, top
    pairs = ids[:-1] * n + ids[1:]
    if n >= 2_000_000:  # the cube would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * n + ids[2:]
    order = np.sort(windows)
    twice = order[1:] == order[:-1]
    if not twice.any():
        return 0, top
    hit = np.isin(windows, order[1:][twice])
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= hit
    return int(covered.sum()), top


def measure(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES for one text; words are runs of anything but ASCII white space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated, top = _repeated(words)
    spaces = len(raw) - _without(raw, _SPACE)
    return (
        len(words),
        len(text or "") - spaces,
        len(raw) - _without(raw, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        sum(line.rstrip()[-1:] in b".?!:;\"'" for line in lines),
        len(raw) - _without(raw, _UPPER),
        len(raw) - _without(raw, _LETTERS),
        raw.count(b"!"),
        top,
    )


def _measures(texts: list[str | None]) -> dict[str, list[int]]:
    rows = [measure(t) for t in texts]
    columns = zip(*rows, strict=True) if rows else ([] for _ in MEASURES)
    return {f.name: list(c) for f, c in zip(MEASURES, columns, strict=True)}


def with_measures(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """The documents and a struct ``name`` of the measures of their whole texts."""
    return extended(docs, _measures, text, MEASURES, name)


def _vote(value: Column, good: tuple[float, float], bad_below: float, bad_above: float) -> Column:
    """1 within the bounds of ``good``, -1 beyond the bad bounds, else 0."""
    return (
        F.when((value < bad_below) | (value > bad_above), -1)
        .when((value >= good[0]) & (value <= good[1]), 1)
        .otherwise(0)
    )


def rules(m: str) -> dict[str, Column]:
    """Votes from the struct ``m`` of measures: the share that a rule looks at, and its bounds."""
    of = lambda name: F.col(f"`{m}`.{name}")
    share = lambda part, whole: F.coalesce(F.try_divide(of(part), of(whole)), F.lit(0.0))
    far = math.inf
    return {
        "length": _vote(of("n_words"), (55, far), 50, far),
        "word_length": _vote(share("word_chars", "n_words"), (2.5, 9), 1.5, 14),
        "symbols": _vote(share("n_symbols", "n_words"), (-1, 0.1), -1, 0.3),
        "repeats": _vote(share("n_repeat_words", "n_words"), (-1, 0.15), -1, 0.4),
        "dup_lines": _vote(share("n_dup_lines", "n_lines"), (-1, 0.1), -1, 0.4),
        "line_ends": _vote(share("n_ended", "n_lines"), (0.5, far), 0.05, far),
        "capitals": _vote(share("n_upper", "n_letters"), (-1, 0.2), -1, 0.5),
        "bangs": _vote(share("n_bangs", "n_words"), (-1, 0.05), -1, 0.3),
        "letters": _vote(share("n_letters", "word_chars"), (0.75, far), 0.5, far),
        "top_word": _vote(share("n_top", "n_words"), (-1, 0.2), -1, 0.35),
    }


RULES = (
    "length", "word_length", "symbols", "repeats", "dup_lines", "line_ends", "capitals", "bangs", "letters", "top_word",
)


def votes(m: str) -> list[Column]:
    """The votes in the order of RULES: 0 (bad), 1 (abstains), 2 (good)."""
    return [vote + 1 for vote in map(rules(m).__getitem__, RULES)]


def fit(measured: DataFrame, m: str) -> VoteModel:
    """The model of a table with a struct ``m`` of measures, from all its rows.

    To the driver come counts of vote patterns: 3 to the number of rules (59,049) rows at most,
    whatever the size of the table; in practice a few hundred.
    """
    counts = measured.groupBy(F.concat(*(v.cast("string") for v in votes(m))).alias("pattern")).agg(F.count(F.lit(1)).alias("n")).collect()
    return estimate([(r["pattern"], r["n"]) for r in counts], len(RULES))


def base_failed(m: str) -> Column:
    words = F.col(f"`{m}`.n_words")
    return (words < LEAST_WORDS) | (F.col(f"`{m}`.n_repeat_words") * 100 > words * 50)


def verdicts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: measures, base_failed, probability of being good, kept."""
    rows = documents_only(docs, id_column, text)
    rows = with_measures(rows, "measures", text).drop(text)
    rows = stored(rows, "measures")
    model = fit(rows, "measures")
    probability = model.probability(votes("measures"))
    failed = base_failed("measures")
    return rows.select(
        F.col(id_column),
        "measures.*",
        failed.alias("base_failed"),
        probability.alias("probability"),
        (~failed & (probability >= 0.5)).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with the columns they have.

    Texts are measured twice, once for the model and once for the verdict: that costs less than a
    join that would shuffle every text.
    """
    measured = with_measures(documents_only(docs, text), "measures", text).drop(text)
    model = fit(measured, "measures")
    m = free_name(docs, "measures")
    rows = with_measures(docs, m, text)
    return rows.where(~base_failed(m) & (model.probability(votes(m)) >= 0.5)).drop(m)
