"""Feature importances of several families of models, over symbols, put together into one ranking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def consensus(importances: DataFrame, weights: Mapping[str, float], gate: DataFrame | None = None, within: str = "mean", across: str = "mean", confirmed: float = 1.0, bonus: float = 0.2, penalty: float = -0.3, least_families: int = 1) -> DataFrame:
    """importances(family, symbol, feature, importance) to a row a feature: base and final score, gate_effect, agree, agree_pct, spread, place, scores.

    A family's score of a feature is the mean or median (within) over all symbols that the family ran for, where a symbol that lacks the feature
    counts as 0, times the family's weight (1 if not given, and a weight of 0 leaves the family out); scores maps families to it, 0 where a family lacks the feature. base is the
    mean, median or geometric mean (across, of scores above a millionth) over families. gate(feature, score): a feature of score `confirmed` or more
    gets the bonus, one of score 0 or less the penalty, any other one and one it lacks nothing. agree: families with a score above 0; spread: their
    standard deviation. Features with fewer than least_families of these go; the rest are ranked by final score to twelve places, then by name.
    Repeated rows of a family, symbol and feature are averaged; null importances are 0. Pre-aggregated by family and feature before anything meets.
    """
    held = importances.filter(F.col("feature").isNotNull() & F.col("family").isNotNull())
    weigh = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)), F.col("family")), F.lit(1.0)) if weights else F.lit(1.0)
    held = held.withColumn("weight", weigh.cast("double")).filter(F.col("weight") != 0)
    each = held.groupBy("family", "weight", "feature", "symbol").agg(F.avg(F.coalesce("importance", F.lit(0.0))).alias("importance"))
    ran = held.groupBy("family").agg(F.count_distinct(F.coalesce("symbol", F.lit(""))).alias("symbols"))
    if within == "median":
        listed = each.groupBy("family", "weight", "feature").agg(F.collect_list("importance").alias("v")).join(ran, "family")  # a number a symbol
        scored = listed.withColumn("score", _median(F.concat("v", F.array_repeat(F.lit(0.0), F.col("symbols").cast("int") - F.size("v")))))
    else:
        scored = each.groupBy("family", "weight", "feature").agg(F.sum("importance").alias("v")).join(ran, "family").withColumn("score", F.col("v") / F.col("symbols"))
    families = ran.agg(F.array_sort(F.collect_list("family")).alias("families"))  # a name a family
    found = scored.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("family", F.col("score") * F.col("weight")))).alias("given")).crossJoin(F.broadcast(families))
    row = found.withColumn("scores", F.map_from_arrays("families", F.transform("families", lambda f: F.coalesce(F.try_element_at("given", f), F.lit(0.0))))).withColumn("v", F.map_values("scores"))
    n = F.size("v")
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / n
    base = {"mean": mean, "median": _median(F.col("v")), "geometric": F.exp(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.log(F.greatest(x, F.lit(1e-6)))) / n)}[across]
    spread = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / F.when(n > 1, n - 1))
    row = row.withColumn("base", base).withColumn("mean", mean).withColumn("spread", spread).withColumn("agree", F.size(F.filter("v", lambda x: x > 0))).withColumn("agree_pct", 100.0 * F.col("agree") / n)
    if gate is None:
        row = row.withColumn("gate_effect", F.lit(0.0))
    else:
        passed = gate.groupBy("feature").agg(F.max("score").alias("gate_score"))
        row = row.join(passed, "feature", "left").withColumn("gate_effect", F.when(F.col("gate_score") >= confirmed, bonus).when(F.col("gate_score") <= 0, penalty).otherwise(0.0))
    final = row.withColumn("final", F.col("base") + F.col("gate_effect")).filter(F.col("agree") >= least_families)
    order = Window.orderBy(F.desc(F.round("final", 12)), "feature")  # a row a feature
    return final.select("feature", "base", "gate_effect", "final", "agree", "agree_pct", "spread", F.row_number().over(order).alias("place"), "scores")
