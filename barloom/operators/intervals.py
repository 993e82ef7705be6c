"""The interval between bars, told from their times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COMMON = (1, 5, 15, 30, 60)


def bar_intervals(bars: DataFrame, default: int = 5, common: Sequence[int] = COMMON, longest: float = 1440.0, reach: float = 10.0, tolerance: float = 0.2) -> DataFrame:
    """bars(symbol, ts) to a row a symbol: n_gaps, median_gap in minutes, minutes, and status.

    Gaps of zero and over `longest` minutes don't count, then those over `reach` times the median of the rest. The median of what is left snaps to the
    nearest of the common intervals (the shorter of two) if it is within the tolerance of it: `snapped`. Otherwise, or without a gap, the default
    counts: `odd`, `no_gaps`. Repeated times are one; null times go. Different gaps are counted by symbol before their median is taken, so a group is as long as there are different gaps."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 6e7
    gap = at - F.lag(at).over(Window.partitionBy("symbol").orderBy("ts"))
    counts = bars.filter("ts IS NOT NULL").withColumn("gap", gap).groupBy("symbol", "gap").agg(F.count("*").alias("n"))
    sane = (F.col("gap") > 0) & (F.col("gap") <= longest)
    rough = counts.withColumn("sane", sane).withColumn("rough", F.expr("percentile(CASE WHEN sane THEN gap END, 0.5, n)").over(Window.partitionBy("symbol")))
    near = F.when(F.col("sane") & (F.col("gap") <= reach * F.col("rough")), F.col("gap"))
    found = rough.withColumn("near", near).groupBy("symbol").agg(F.coalesce(F.sum(F.when(F.col("near").isNotNull(), F.col("n"))), F.lit(0)).alias("n_gaps"), F.expr("percentile(near, 0.5, n)").alias("median_gap"))
    nearest = F.array_min(F.array(*(F.struct(F.abs(F.col("median_gap") - m).alias("off"), F.lit(m).alias("m")) for m in common)))
    snaps = nearest["off"] <= tolerance * nearest["m"]
    status = F.when(F.col("n_gaps") == 0, "no_gaps").when(snaps, "snapped").otherwise("odd")
    return found.withColumn("minutes", F.when(snaps, nearest["m"]).otherwise(default)).withColumn("status", status)
