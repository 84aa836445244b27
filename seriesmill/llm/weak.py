"""Weak supervision: votes of labelers, their reliabilities by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def vote(for_it: Column, against: Column) -> Column:
    """2 for, 0 against, 1 neither; nulls abstain."""
    return F.when(for_it, "2").when(against, "0").otherwise("1")


@dataclass(frozen=True)
class VoteModel:
    """Log odds of the positive class: ``prior``, and ``weights[labeler][vote]`` with votes as 0, 1, 2."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def log_odds(self, votes: Sequence[Column]) -> Column:
        """Of a column for each labeler, 0, 1 or 2.

        Each vote stands once in the expression: Spark writes its code again wherever it stands.
        """
        total = F.lit(self.prior)
        for vote, weights in zip(votes, self.weights, strict=True):
            total = total + F.get(F.array(*map(F.lit, weights)), vote)
        return total

    def probability(self, votes: Sequence[Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(votes)))

    def of_pattern(self, pattern: Column) -> Column:
        """The probability of a column of patterns, a digit for each labeler."""
        return self.probability([F.substring(pattern, i + 1, 1).cast("int") for i in range(len(self.weights))])


def estimate(patterns: list[tuple[str, int]], labelers: int, rounds: int = 60) -> VoteModel:
    """Expectation-maximisation over counts of vote patterns.

    Starts from the share of positive among the votes given, which also fixes which of the two classes is
    the positive one. Counts are smoothed by one, so that no vote is ever certain.
    """
    if not patterns:
        return VoteModel(0.0, ((0.0, 0.0, 0.0),) * labelers)
    digits = np.array([[int(c) for c in p] for p, _ in sorted(patterns)])
    counts = np.array([n for _, n in sorted(patterns)], float)
    onehot = np.stack([digits == v for v in range(3)], axis=2).astype(float)
    against, for_it = (digits == 0).sum(1), (digits == 2).sum(1)
    posterior = (for_it + 1) / (for_it + 3 * against + 2)
    for _ in range(rounds):
        total = np.array([(counts * (1 - posterior)).sum(), (counts * posterior).sum()])
        prior = (total + 1) / (total.sum() + 2)
        given = [
            (np.einsum("p,pkv->kv", counts * share, onehot) + 1) / (t + 3)
            for share, t in ((1 - posterior, total[0]), (posterior, total[1]))
        ]
        weights = np.log(given[1]) - np.log(given[0])
        odds = np.log(prior[1] / prior[0]) + np.einsum("kv,pkv->p", weights, onehot)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    return VoteModel(float(np.log(prior[1] / prior[0])), tuple(tuple(map(float, w)) for w in weights))
