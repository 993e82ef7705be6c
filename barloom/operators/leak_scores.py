"""Verdicts over a table of scores, one row an evaluated target: composite score, leak status, suspicion, gate for costly importances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A score above which a task's result is too good, by task; forward returns are regressions of their own.
HIGH = {"forward_return": 0.5, "regression": 0.7, "binary": 0.9, "multiclass": 0.9}


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _sum(*terms: tuple[Column, float]) -> Column:
    """The values of the terms that hold; a term on something unknown doesn't."""
    return sum((F.when(_holds(c), v).otherwise(0.0) for c, v in terms), F.lit(0.0))


def composite(score: str = "auc", sd: str = "sd", importance: str = "mean_importance", n_models: str = "n_models", task: str = "task", weights: tuple[float, float, float] = (0.5, 0.25, 0.25)) -> Column:
    """Weighted score, consistency 1 / (1 + sd) and importance times 1 + score, raised by 2 % a model, at most 10 %. A regression's score counts from 0 on, and
    one of 0 or less lowers its importance by 0.67 of its size, at most by half. NULL if any part is."""
    regression, s = F.col(task) == "regression", F.col(score)
    weighed = F.when(regression & (s <= 0), F.greatest(F.lit(0.5), 1.0 - F.abs(s) * 0.67)).otherwise(1.0 + s)
    parts = F.when(regression, F.when(s < 0, 0.0).otherwise(s)).otherwise(s), 1.0 / (1.0 + F.col(sd)), F.col(importance) * weighed
    bonus = F.when(F.col(n_models) >= 5, 0.1).otherwise(F.col(n_models) * 0.02)
    return sum((w * p for w, p in zip(weights, parts, strict=True)), F.lit(0.0)) * (1.0 + bonus)


def leak_status(scores: DataFrame, high: dict[str, float] = HIGH, most_models: int = 3, composite_high: float = 0.5, importance_high: float = 0.7) -> DataFrame:
    """scores(target, task, auc, composite, mean_importance, model_scores map of a model's name to its score) with n_flags and status: HIGH_SCORE if the score is
    above its task's bound, or those of most_models models or more are; INCONSISTENT if the composite or the importance is high and the score low;
    SUSPICIOUS by two flags or more, else OK. Null and NaN scores raise no flag; an unknown task has the bound of a binary one."""
    forward = (F.col("task") == "regression") & F.startswith("target", F.lit("fwd_ret_"))
    kind = F.when(_holds(forward), "forward_return").otherwise(F.col("task"))
    bound = F.coalesce(F.create_map(*(F.lit(v) for kv in high.items() for v in kv))[kind], F.lit(high["binary"]))
    regression = _holds(F.col("task") == "regression")
    low, lowest = F.when(regression, 0.2).otherwise(0.6), F.when(regression, 0.1).otherwise(0.5)
    above = lambda v: v.isNotNull() & ~F.isnan(v) & (v > bound)
    too_good = F.size(F.filter(F.map_values("model_scores"), above))
    high_flags = above(F.col("auc")), too_good >= most_models
    odd_flags = (F.col("composite") > composite_high) & (F.col("auc") < low), (F.col("mean_importance") > importance_high) & (F.col("auc") < lowest)
    count = lambda flags: sum((_holds(f).cast("int") for f in flags), F.lit(0))
    found = scores.withColumns({"_high": count(high_flags), "_odd": count(odd_flags)})
    status = F.when(F.col("n_flags") > 1, "SUSPICIOUS").when(F.col("_high") == 1, "HIGH_SCORE").when(F.col("_odd") == 1, "INCONSISTENT").otherwise("OK")
    return found.withColumn("n_flags", F.col("_high") + F.col("_odd")).withColumn("status", status).drop("_high", "_odd")


def suspicion(train: str = "train", cv: str = "cv", top_share: str = "top_share") -> Column:
    """From 0 to 1, how much a good training score looks like a leak rather than overfitting: a high cv score, a perfect training score with a small gap to it
    and a dominant feature add to it; a plain cv score, a large gap and no dominant feature take from it. Parts that are null say nothing."""
    c, gap, top = F.col(cv), F.col(train) - F.col(cv), F.col(top_share)
    close = (gap < 0.05) & (F.col(train) >= 0.99)
    added = _sum((c >= 0.85, 0.4), ((c >= 0.75) & (c < 0.85), 0.2), (c < 0.55, -0.2), (close, 0.3), (gap > 0.2, -0.2), (top >= 0.5, 0.3), ((top >= 0.4) & (top < 0.5), 0.2), (top < 0.2, -0.1))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(added, 9)))


def skip_reason(train: str = "train", cv: str = "cv", val: str = "val", n_features: str = "n_features", perfect: float = 0.99, most_gap: float = 0.2, most_features: int | None = None) -> Column:
    """Why costly importances of a model aren't worth their time, the first that holds: train_score, train_cv_gap, train_val_gap, n_features, else none."""
    t = F.col(train)
    out = F.when(_holds(t >= perfect), "train_score").when(_holds(t - F.col(cv) >= most_gap), "train_cv_gap").when(_holds(t - F.col(val) >= most_gap), "train_val_gap")
    return (out if most_features is None else out.when(_holds(F.col(n_features) >= most_features), "n_features")).otherwise("none")
