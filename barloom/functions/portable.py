"""Window expressions of bar panels as SQL text, and chains of select lists over them.

A step is a dict of column name to expression; a chain applies its steps one after another, each over what the last one made. Spark runs a
chain with selectExpr, so all expressions of a step share one window sort; the same text is what a test database runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Mapping[str, str]
KEY = "PARTITION BY symbol ORDER BY ts"


def over(before: int | None = None, after: int = 0, key: str = KEY) -> str:
    """OVER clause of the rows from `before` back to `after` ahead; negative numbers turn round; no number: all rows up to here."""
    side = lambda n, ahead: "CURRENT ROW" if n == 0 else f"{abs(n)} {'FOLLOWING' if (n > 0) == ahead else 'PRECEDING'}"
    start = "UNBOUNDED PRECEDING" if before is None else side(before, False)
    return f"OVER ({key} ROWS BETWEEN {start} AND {side(after, True)})"


def roll(agg: str, x: str, n: int) -> str:
    """An aggregate over the last n rows, null until n of them hold a value."""
    return f"CASE WHEN count({x}) {over(n - 1)} = {n} THEN {agg}({x}) {over(n - 1)} END"


def ahead(agg: str, x: str, n: int) -> str:
    """An aggregate over the next n rows, null where there are fewer."""
    return f"CASE WHEN count({x}) {over(-1, n)} = {n} THEN {agg}({x}) {over(-1, n)} END"


def lag(x: str, k: int = 1) -> str:
    return f"lag({x}, {k}) OVER ({KEY})" if k >= 0 else f"lead({x}, {-k}) OVER ({KEY})"


def ratio(a: str, b: str) -> str:
    """a / b, null where b is zero."""
    return f"({a}) / nullif({b}, 0)"


def change(x: str, k: int = 1) -> str:
    return f"{x} / nullif({lag(x, k)}, 0) - 1"


def log(x: str) -> str:
    """Natural logarithm, null where there is none."""
    return f"ln(CASE WHEN {x} > 0 THEN {x} END)"


def apply_steps(df: DataFrame, *steps: Step) -> DataFrame:
    for step in steps:
        df = df.selectExpr(*(f"`{c}`" for c in df.columns if c not in step), *(f"{e} AS `{c}`" for c, e in step.items()))
    return df


def steps_sql(relation: str, columns: Sequence[str], *steps: Step) -> str:
    """The chain as one nested SELECT over a relation that has these columns."""
    held = list(columns)
    for step in steps:
        kept = [c for c in held if c not in step]
        relation = f"(SELECT {', '.join([*kept, *(f'{e} AS {c}' for c, e in step.items())])} FROM {relation})"
        held = [*kept, *step]
    return relation


def correlation(x: str, y: str) -> Column:
    """Pearson's correlation over rows where both are there; null without spread in either, where the built-in one divides by zero."""
    a, b = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
