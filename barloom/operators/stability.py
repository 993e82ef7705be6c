"""How alike the feature rankings of successive runs are."""

from __future__ import annotations

from bisect import bisect_right, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _tau(ranks: pd.Series) -> pd.Series:
    """Kendall's tau of each array of different ranks against its order; null for fewer than three."""

    def one(values) -> float | None:
        seen, inversions = [], 0
        for v in values:
            inversions += len(seen) - bisect_right(seen, v)
            insort(seen, v)
        pairs = len(seen) * (len(seen) - 1) / 2
        return 1 - 2 * inversions / pairs if len(seen) >= 3 else None

    return ranks.map(one)


def usable(snapshots: DataFrame, series: list[str], signatures: list[str]) -> DataFrame:
    """snapshots(*series, run_id, universe, *signatures, ...) of each series' largest universe, that of the most runs (the first by name of several), without runs
    that lack a signature (null or empty). A series whose remaining runs differ in a signature is refused as a whole: refused names the first such one, else null."""
    held = snapshots
    for s in signatures:
        held = held.filter((F.col(s).isNotNull()) & (F.col(s) != ""))
    runs = held.groupBy(*series, "universe", "run_id").agg(*(F.min(s).alias(f"_lo_{s}") for s in signatures), *(F.max(s).alias(f"_hi_{s}") for s in signatures))
    each = runs.groupBy(*series, "universe").agg(F.count("*").alias("_n"), *(F.min(f"_lo_{s}").alias(f"_lo_{s}") for s in signatures), *(F.max(f"_hi_{s}").alias(f"_hi_{s}") for s in signatures))
    first = each.withColumn("_at", F.row_number().over(Window.partitionBy(*series).orderBy(F.desc("_n"), "universe"))).filter("_at = 1")
    refused = F.coalesce(*(F.when(F.col(f"_lo_{s}") != F.col(f"_hi_{s}"), s) for s in signatures), F.lit(None).cast("string"))
    picked = first.select(*(F.col(c).alias(f"_k_{c}") for c in [*series, "universe"]), refused.alias("refused"))
    on: Column = F.lit(True)
    for c in [*series, "universe"]:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return held.join(picked, on).drop(*(f"_k_{c}" for c in [*series, "universe"]))


def pairs(snapshots: DataFrame, series: list[str], top: int = 20) -> DataFrame:
    """snapshots(*series, run_id, ts, feature, importance) to a row a run but the first of a series: run_id, previous_id, overlap (Jaccard similarity of the top features) and tau
    (Kendall's, over common features, null for fewer than three). Features rank by importance, then name; nulls are last; runs follow by ts, then id.

    A run's ranks meet as one array of its features, and runs meet their predecessor by a lag, not by a join of snapshots with each other."""
    key = F.struct((-F.coalesce("importance", F.lit(float("-inf")))).alias("i"), F.col("feature").alias("f"))
    run = snapshots.filter("feature IS NOT NULL").groupBy(*series, "run_id", "ts").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["f"]).alias("features"))
    w = Window.partitionBy(*series).orderBy("ts", "run_id")
    seen = run.withColumns({"previous_id": F.lag("run_id").over(w), "before": F.lag("features").over(w)}).filter("before IS NOT NULL")
    now, old = F.slice("features", 1, top), F.slice("before", 1, top)
    places = F.transform(F.filter("before", lambda f: F.array_contains("features", f)), lambda f: F.array_position("features", f))
    tau = F.pandas_udf(_tau, "double")
    return seen.select(*series, "run_id", "previous_id", "ts", F.coalesce(F.try_divide(F.size(F.array_intersect(now, old)), F.size(F.array_union(now, old))), F.lit(1.0)).alias("overlap"), tau(places).alias("tau"))


def summary(compared: DataFrame, series: list[str], stable: tuple[float, float] = (0.75, 0.65), diverged: float = 0.35) -> DataFrame:
    """pairs() to a row a series: n_comparisons, mean and standard deviation (of the population) of overlap and tau, and status: stable with both means at their limits
    (tau counts where there is any), diverged with a mean overlap under its limit, else drifting."""
    found = compared.groupBy(*series).agg(F.count("*").alias("n_comparisons"), F.avg("overlap").alias("mean_overlap"), F.stddev_pop("overlap").alias("sd_overlap"), F.avg("tau").alias("mean_tau"), F.stddev_pop("tau").alias("sd_tau"))
    good = (F.col("mean_overlap") >= stable[0]) & (F.col("mean_tau").isNull() | (F.col("mean_tau") >= stable[1]))
    return found.withColumn("status", F.when(good, "stable").when(F.col("mean_overlap") < diverged, "diverged").otherwise("drifting"))
