"""Runs against the one before: metrics by tiers, rankings of features."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.portable import correlation

#: Relative changes that warn and alert, and absolute ones where the baseline is 0; of plain and of critical metrics.
LIMITS = {False: (0.05, 0.2, 0.01, 0.1), True: (0.01, 0.03, 0.001, 0.01)}


def metric_drift(runs: DataFrame, series: Sequence[str], signatures: Sequence[str], metrics: Sequence[str], critical: Collection[str] = (), limits: dict[bool, tuple[float, float, float, float]] = LIMITS) -> DataFrame:
    """runs(*series, run_id, ts, *signatures, *metrics) to a row a run and metric that has a value in it and in its baseline: run_id, baseline_id, metric, now, base,
    delta, rel_delta (null where base is 0), tier (OK, WARN, ALERT) and status (STABLE, DRIFTING, DIVERGED).

    The baseline is the series' last run before with the same signatures, which stands just before it in their common window; runs without all signatures have
    none. NaN is no value. Runs follow by ts, then id."""
    held = runs.dropna(subset=list(signatures))
    order = Window.partitionBy(*series, *signatures).orderBy("ts", "run_id")
    whole = lambda m: F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double"))
    seen = held.withColumn("_base", F.lag(F.struct(F.col("run_id"), *(whole(m).alias(m) for m in metrics))).over(order)).filter("_base IS NOT NULL")
    facts = F.array(*(F.struct(F.lit(m).alias("metric"), whole(m).alias("now"), F.col(f"_base.{m}").alias("base"), F.lit(m in critical).alias("critical")) for m in metrics))
    long = seen.select(*series, "run_id", "ts", F.col("_base.run_id").alias("baseline_id"), F.inline(facts)).dropna(subset=["now", "base"])
    delta = F.col("now") - F.col("base")
    rel = F.when(F.col("base") != 0, delta / F.col("base"))
    limit = lambda k: F.when(F.col("critical"), limits[True][k]).otherwise(limits[False][k])
    size, warn, alert = F.abs(F.coalesce("rel_delta", "delta")), F.when(F.col("base") != 0, limit(0)).otherwise(limit(2)), F.when(F.col("base") != 0, limit(1)).otherwise(limit(3))
    rated = long.withColumns({"delta": delta, "rel_delta": rel}).withColumn("tier", F.when(size < warn, "OK").when(size < alert, "WARN").otherwise("ALERT"))
    return rated.withColumn("status", F.when(F.col("tier") == "OK", "STABLE").when(F.col("tier") == "WARN", "DRIFTING").otherwise("DIVERGED"))


def reproducibility(snapshots: DataFrame, series: Sequence[str], top: int = 20, most_delta: float = 0.01, least_overlap: float = 0.7, least_corr: float = 0.7, near: float = 1.1) -> DataFrame:
    """snapshots(*series, run_id, ts, score, feature, importance), a row a feature of a run, to a row a run: delta_score (absolute), overlap (Jaccard similarity of the top
    features, ties by name), corr (Spearman's of importances over the features of either run, 0 where one lacks it; null for fewer than two or without spread), and
    status: no_previous_run; unstable by any limit; borderline within 70 % of the delta or `near` times the other limits; else stable. What is null fails no limit.

    Every row is sent on to its series' next run too, so two runs meet in one aggregate and no snapshots are joined. Runs follow by ts, then id; a null importance is 0
    and rows without a feature don't count."""
    runs = Window.partitionBy(*series).orderBy("ts", "run_id")
    numbered = snapshots.filter("feature IS NOT NULL").withColumn("_i", F.coalesce(F.nanvl("importance", F.lit(0.0)), F.lit(0.0))).withColumn("_r", F.dense_rank().over(runs))
    last = numbered.withColumn("_last", F.max("_r").over(Window.partitionBy(*series)))
    # what a run says of itself, and to the next one
    sent = F.array(F.struct(F.col("_r").alias("_run"), F.lit(1).alias("_now")), F.struct((F.col("_r") + 1).alias("_run"), F.lit(0).alias("_now")))
    both = last.select(*series, "run_id", "ts", "score", "feature", "_i", "_last", F.inline(sent)).filter("_run <= _last")
    mine = lambda c, now: F.when(F.col("_now") == now, F.col(c))
    met = both.groupBy(*series, "_run", "feature").agg(*(F.max(mine(c, 1)).alias(c) for c in ("run_id", "ts", "score")), F.max(mine("score", 0)).alias("_was"), F.max(mine("_i", 1)).alias("_a"), F.max(mine("_i", 0)).alias("_b"))
    run = Window.partitionBy(*series, "_run")
    full = met.withColumns({"_x": F.coalesce("_a", F.lit(0.0)), "_y": F.coalesce("_b", F.lit(0.0))})
    mean_rank = lambda c: F.rank().over(run.orderBy(c)) + (F.count("*").over(Window.partitionBy(*series, "_run", c)) - 1) / 2
    in_top = lambda c: F.col(c).isNotNull() & (F.row_number().over(run.orderBy(F.col(c).desc_nulls_last(), "feature")) <= top)
    placed = full.withColumns({"_p": mean_rank("_x"), "_q": mean_rank("_y"), "_t": in_top("_a"), "_u": in_top("_b")})
    found = placed.groupBy(*series, "_run").agg(F.max("run_id").alias("run_id"), F.max("ts").alias("ts"), F.abs(F.max("score") - F.max("_was")).alias("_d"), F.try_divide(F.count_if(F.col("_t") & F.col("_u")), F.count_if(F.col("_t") | F.col("_u"))).alias("_o"), correlation("_p", "_q").alias("_c"), F.count("_b").alias("_n"))
    later = F.col("_run") > 1
    value = {"delta_score": F.when(later & ~F.isnan("_d"), F.col("_d")), "overlap": F.when(later, F.col("_o")), "corr": F.when(later, F.col("_c"))}
    beyond = lambda d, o, c: F.coalesce(F.col("delta_score") > d, F.lit(False)) | F.coalesce(F.col("overlap") < o, F.lit(False)) | F.coalesce(F.col("corr") < c, F.lit(False))
    status = F.when(~later, "no_previous_run").when(beyond(most_delta, least_overlap, least_corr), "unstable").when(beyond(most_delta * 0.7, least_overlap * near, least_corr * near), "borderline").otherwise("stable")
    return found.withColumns(value).withColumn("status", status).select(*series, "run_id", "ts", *value, "status")
