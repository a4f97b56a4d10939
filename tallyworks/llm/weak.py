"""Weak supervision over votes: how far each rule can be trusted, estimated without labels.

Votes are 1, -1 or 0 (abstains). Rows with the same votes behave alike, so estimation runs over the counts of vote
patterns, a table of at most 3^rules rows whatever the input; each round is one aggregate over it that
returns two numbers a rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 12
#: Weight of the prior accuracies as a share of all rows, so that it means the same at every size.
PRIOR_SHARE = 0.01
LEAST, MOST = 1e-4, 1 - 1e-4


@dataclass(frozen=True)
class Votes:
    """Share of the positive class, and per rule how often a given vote is right in each class."""

    share: float
    right_pos: dict[str, float]
    right_neg: dict[str, float]

    def posterior(self) -> Column:
        """Probability of the positive class given the vote columns."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for rule, pos in self.right_pos.items():
            neg = self.right_neg[rule]
            odds = odds + F.when(F.col(rule) > 0, math.log(pos / (1 - neg))).when(F.col(rule) < 0, math.log((1 - pos) / neg)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def clamp(x: float) -> float:
    return min(MOST, max(LEAST, x))


def estimate(patterns: DataFrame, rules: list[str], share: float, right_pos: float, right_neg: float, rounds: int = ROUNDS) -> Votes:
    """Expectation-maximisation from the given start; ``patterns`` has the vote columns and ``n``, rows per pattern."""
    model = Votes(share, dict.fromkeys(rules, right_pos), dict.fromkeys(rules, right_neg))
    for _ in range(rounds):
        p = F.col("_p") * F.col("n")
        q = (1 - F.col("_p")) * F.col("n")
        sums = [F.sum("n").alias("n"), F.sum(p).alias("p")]
        for k, rule in enumerate(rules):
            given = F.col(rule) != 0
            sums += [
                F.sum(F.when(given, p).otherwise(0.0)).alias(f"p{k}"), F.sum(F.when(F.col(rule) > 0, p).otherwise(0.0)).alias(f"pp{k}"),
                F.sum(F.when(given, q).otherwise(0.0)).alias(f"q{k}"), F.sum(F.when(F.col(rule) < 0, q).otherwise(0.0)).alias(f"qq{k}"),
            ]
        found = patterns.withColumn("_p", model.posterior()).agg(*sums).first()
        if not found["n"]:
            return model
        w = PRIOR_SHARE * found["n"]
        model = Votes(
            clamp((found["p"] + w * share) / (found["n"] + w)),
            {r: clamp((found[f"pp{k}"] + w * right_pos) / (found[f"p{k}"] + w)) for k, r in enumerate(rules)},
            {r: clamp((found[f"qq{k}"] + w * right_neg) / (found[f"q{k}"] + w)) for k, r in enumerate(rules)},
        )
    return model
