"""Series of runs in segments: what the step before says of a run's score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row a group of non-null keys with the exact median of each column, its null values left out. Values are numbered in sorts that spill, so a group of any size
    needs no more memory than a small one."""
    long = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(list(keys), list(columns), "_c", "_x").dropna()
    group = Window.partitionBy(*keys, "_c")
    placed = long.withColumns({"_at": F.row_number().over(group.orderBy("_x")), "_n": F.count("*").over(group)})
    middle = placed.filter((2 * F.col("_at") >= F.col("_n")) & (2 * F.col("_at") <= F.col("_n") + 2)).groupBy(*keys, "_c").agg(F.avg("_x").alias("_m"))
    return middle.groupBy(*keys).agg(*(F.max(F.when(F.col("_c") == c, F.col("_m"))).alias(c) for c in columns))


def lag_frame(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], ts: str = "ts", least: int = 8) -> DataFrame:
    """keys, ts, target and, for each feature x, x (nulls filled by its segment's median), x_lag1 (the value before) and d_x (the change to it).

    Segments of fewer than `least` rows go, then rows without target or any lag or change, then segments that have fewer than `least` rows left. A feature
    without any value in a segment leaves no row of it; rows with a null key belong to no segment. Ties of ts are ordered by target and features."""
    middle = medians(df, keys, features).select(*keys, *(F.col(c).alias(f"_{c}") for c in features))
    filled = df.dropna(subset=list(keys)).join(middle, list(keys), "left").select(*keys, ts, target, *(F.coalesce(F.col(c).cast("double"), f"_{c}").alias(c) for c in features))
    whole = Window.partitionBy(*keys)
    series = whole.orderBy(ts, target, *features)
    lags = {f"{c}_lag1": F.lag(c).over(series) for c in features}
    long_enough = filled.withColumns({**lags, "_n": F.count("*").over(whole)}).filter(F.col("_n") >= least)
    made = long_enough.withColumns({f"d_{c}": F.col(c) - F.col(f"{c}_lag1") for c in features})
    complete = made.dropna(subset=[target, *(f"{c}_lag1" for c in features), *(f"d_{c}" for c in features)])
    return complete.withColumn("_n", F.count("*").over(whole)).filter(F.col("_n") >= least).drop("_n")
