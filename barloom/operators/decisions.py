"""Decisions about series of runs, each rule a condition on a series' last runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rule, level, action, reason.
RULES = (("feature_instability", 2, "freeze_features", "jaccard_collapse"), ("route_instability", 2, "tighten_routing", "route_instability"), ("feature_explosion_decline", 2, "cap_features", "feature_explosion_decline"), ("class_balance_drift", 1, "retune_class_weights", "pos_rate_drift"))


@dataclass(frozen=True)
class Limits:
    least_runs: int = 3
    least_known: int = 2
    jaccard: float = 0.5
    collapse: float = 0.8
    entropy: float = 1.5
    changes: int = 3
    change_runs: int = 5
    decline: float = -0.01
    more_features: float = 10
    balance: float = 0.1


def _lasts(runs: DataFrame, series: list[str], most: int) -> DataFrame:
    """A row a series: its number of runs, and an array of its last runs from old to new; no more rows of a series than that meet."""
    w = Window.partitionBy(*series).orderBy(F.desc_nulls_last("ts"), F.desc_nulls_last("run_id"))
    counts = runs.groupBy(*series).agg(F.count("*").alias("n_runs"))
    near = runs.withColumn("_back", F.row_number().over(w)).filter(F.col("_back") <= most)
    fields = [F.col(c) for c in ("run_id", "jaccard", "entropy", "changed", "auc", "n_features", "pos_rate") if c in runs.columns]
    listed = near.groupBy(*series).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), *fields))), lambda r: r.dropFields("at")).alias("runs"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"c.{c}")) for c in series]
    joined = listed.alias("l").join(counts.alias("c"), on=_all(same))
    return joined.select(*(F.col(f"l.{c}").alias(c) for c in series), "n_runs", "runs")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _known(runs: Column, column: str, last: int) -> Column:
    """The known values of the last runs, from old to new."""
    return F.filter(F.transform(F.slice(runs, F.greatest(F.size(runs) - last + 1, F.lit(1)), last), lambda r: r[column]), lambda v: v.isNotNull())


def decisions(runs: DataFrame, series: list[str], limits: Limits = Limits()) -> DataFrame:
    """runs(*series, run_id, ts, and of jaccard, entropy, changed, auc, n_features, pos_rate those there are) to a row a series and rule: n_runs, rule,
    triggered, level, action, reason, and run_id of its last run; level is 0 and action and reason null where a rule doesn't trigger.

    feature_instability: the last two known overlaps of selected features among least_runs runs fall below `jaccard` and by more than the collapse ratio.
    route_instability: the last known entropy of routes is above its limit, or, where least_runs runs tell none, routes changed `changes` times in
    change_runs runs. feature_explosion_decline: score down and features up from the run before. class_balance_drift: the share of positives moved from the
    first to the last known one of least_runs runs. Series of fewer than least_runs runs and missing columns trigger nothing; a null key is a series."""
    k, r = limits.least_runs, F.col("runs")
    held = _lasts(runs, series, max(k, limits.change_runs, 2))
    no, have = F.lit(False), set(runs.columns)
    last = lambda a, back=1: F.try_element_at(a, F.lit(-back))
    checks = dict.fromkeys((n for n, *_ in RULES), no)
    if "jaccard" in have:
        j = _known(r, "jaccard", k)
        checks["feature_instability"] = (F.size(j) >= max(limits.least_known, 2)) & (last(j) < limits.jaccard) & (last(j) < last(j, 2) * limits.collapse)
    moved = F.aggregate(_known(r, "changed", limits.change_runs), F.lit(0), lambda a, x: a + x.cast("int")) >= limits.changes if "changed" in have else no
    if "entropy" in have:
        e = _known(r, "entropy", k)
        checks["route_instability"] = F.when(F.size(e) > 0, last(e) > limits.entropy).otherwise(moved)
    else:
        checks["route_instability"] = moved
    if {"auc", "n_features"} <= have:
        now, before = last(r), last(r, 2)
        checks["feature_explosion_decline"] = (now["auc"] - before["auc"] < limits.decline) & (now["n_features"] - before["n_features"] > limits.more_features)
    if "pos_rate" in have:
        p = _known(r, "pos_rate", k)
        checks["class_balance_drift"] = (F.size(p) >= limits.least_known) & (F.abs(last(p) - F.get(p, F.lit(0))) > limits.balance)
    told = F.array(*(F.struct(F.lit(n).alias("rule"), F.coalesce((F.col("n_runs") >= k) & checks[n], no).alias("triggered"), F.lit(level).alias("l"), F.lit(action).alias("a"), F.lit(why).alias("w")) for n, level, action, why in RULES))
    rows = held.select(*series, "n_runs", last(r)["run_id"].alias("run_id"), F.explode(told).alias("t"))
    only = lambda c: F.when(F.col("t.triggered"), F.col(c))
    return rows.select(*series, "n_runs", "run_id", "t.rule", "t.triggered", F.coalesce(only("t.l"), F.lit(0)).alias("level"), only("t.a").alias("action"), only("t.w").alias("reason"))
