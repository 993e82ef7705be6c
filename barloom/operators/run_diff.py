"""Differences between runs: settings and metrics against the run before, the last comparable one and the best one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELTA = "map<string, struct<previous: double, current: double, change: double, share: double>>"


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def changed_keys(a: Column, b: Column) -> Column:
    """The keys, in order, under which two maps differ: missing in one of them, or with different values; a null map has no keys."""
    empty = F.expr("map_from_arrays(CAST(array() AS array<string>), CAST(array() AS array<string>))")
    a, b = F.coalesce(a, empty), F.coalesce(b, empty)
    keys = F.array_union(F.map_keys(a), F.map_keys(b))
    apart = lambda k: (F.map_contains_key(a, k) != F.map_contains_key(b, k)) | ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k))
    return F.array_sort(F.filter(keys, apart))


def metric_deltas(a: Column, b: Column, absolute: float, relative: float) -> Column:
    """DELTA of the metrics that both maps hold and that differ by more than both tolerances; share is the change over the previous value's size."""
    both = F.map_filter(F.map_zip_with(a, b, lambda _, x, y: F.struct(x.alias("previous"), y.alias("current"), (y - x).alias("change"), F.try_divide(y - x, F.abs(x)).alias("share"))), lambda _, d: _finite(d["previous"]) & _finite(d["current"]))
    return F.map_filter(both, lambda _, d: (F.abs(d["change"]) > absolute) & (F.abs(d["change"]) > relative * F.abs(d["previous"])))


def run_diff(runs: DataFrame, score: str, watched: list[str], absolute: float = 1e-4, relative: float = 1e-4, major: float = 0.05) -> DataFrame:
    """runs(series, run_id, ts, signature, settings map<string, string>, metrics map<string, double>) to one row a run: previous_id, comparable_id (the
    last earlier run of the series with an equal signature), best_id (the one of these with the highest score so far), changed (keys of
    settings that differ from the previous run's), deltas (against the comparable run), comparability and severity.

    comparability: `first` without an earlier run, `comparable` if the previous run has the same signature, `earlier` if only an older one has, else
    `none`. severity: `critical` if a watched setting changed, `major` if the score fell by more than `major` of the comparable run's, `minor` if
    anything else differs, else `none`. A null signature is comparable with nothing. One shuffle by series; runs of a series with one signature are a part
    of it, so the as-of search is a window over them and no pair of runs is formed.
    """
    order = Window.partitionBy("series").orderBy("ts", "run_id")
    alike = Window.partitionBy("series", "signature").orderBy("ts", "run_id")
    known = F.col("signature").isNotNull()
    one = F.struct("run_id", "settings", "metrics", "signature")
    held = runs.withColumn("previous", F.lag(one).over(order)).withColumn("comparable", F.when(known, F.lag(one).over(alike)))
    value = F.when(_finite(F.try_element_at("metrics", F.lit(score))), F.try_element_at("metrics", F.lit(score)))
    mine = held.withColumn("own", value)
    best = F.max(F.when(F.col("own").isNotNull(), F.struct("own", (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("age"), "run_id"))).over(alike.rowsBetween(Window.unboundedPreceding, 0))
    seen = mine.withColumn("best", F.when(known, best)).withColumn("changed", F.when(F.col("previous").isNull(), F.array().cast("array<string>")).otherwise(changed_keys(F.col("previous.settings"), F.col("settings"))))
    seen = seen.withColumn("deltas", F.when(F.col("comparable").isNotNull(), metric_deltas(F.col("comparable.metrics"), F.col("metrics"), absolute, relative)))
    comparability = F.when(F.col("previous").isNull(), "first").when(F.col("comparable").isNull(), "none").when(F.col("comparable.run_id").eqNullSafe(F.col("previous.run_id")), "comparable").otherwise("earlier")
    fell = F.coalesce(F.try_element_at("deltas", F.lit(score))["share"] < -major, F.lit(False))
    severity = F.when(F.size(F.array_intersect("changed", F.array(*map(F.lit, watched)))) > 0, "critical").when(fell, "major").when((F.size("changed") > 0) | (F.coalesce(F.size("deltas"), F.lit(0)) > 0), "minor").otherwise("none")
    return seen.select("series", "run_id", "ts", F.col("previous.run_id").alias("previous_id"), F.col("comparable.run_id").alias("comparable_id"), F.col("best.run_id").alias("best_id"), "changed", "deltas", comparability.alias("comparability"), severity.alias("severity"))
