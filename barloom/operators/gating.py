"""Predictions held back or raised by the probabilities of barriers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Above the threshold (the operator's own, if None), a barrier's probability multiplies the prediction by the factor; 0 blocks it."""

    barrier: str
    factor: float
    threshold: float | None = None


def blocked(barrier: str, threshold: float = 0.8) -> Rule:
    return Rule(barrier, 0.0, threshold)


def gated(prediction: str, rules: Sequence[Rule], threshold: float) -> Column:
    """The prediction after all rules, in any order alike; a null probability is no reason to hold anything back."""
    out = F.col(prediction)
    for r in rules:
        out = F.when(F.col(r.barrier) > F.lit(threshold if r.threshold is None else r.threshold), out * r.factor).otherwise(out)
    return out + F.lit(0.0)  # no negative zeros


def gating_summary(df: DataFrame, predictions: Sequence[str], barriers: Sequence[str], high: float = 0.7) -> DataFrame:
    """A row a column: name, kind (prediction or barrier), n, mean, sd (population), and n_marked: barriers above `high`, predictions that are exactly 0. One
    aggregate over all columns; without rows the moments are null and the counts 0."""
    def fact(c: str, kind: str, marked: Column) -> Column:
        return F.struct(F.lit(c).alias("name"), F.lit(kind).alias("kind"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd"), F.count_if(marked).alias("n_marked"))

    facts = [*(fact(c, "prediction", F.col(c) == 0) for c in predictions), *(fact(c, "barrier", F.col(c) > high) for c in barriers)]
    return df.agg(F.array(*facts).alias("f")).select(F.inline("f"))
