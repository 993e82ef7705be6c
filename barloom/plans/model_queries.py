"""Queries whose results come from fitted models; no SQL gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.portable import KEY, apply_steps, change, lag, ratio, roll
from barloom.operators import models
from barloom.plans.registry import register, rounded
from barloom.sources import panels
from barloom.sources.scratch import staged

FEATURES = ["f1", "f2", "f3", "f4"]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars with features and a label, written once: a fit goes through its rows dozens of times, and bars are far fewer than ticks."""
    bars = panels.weekly_bars(spark, sf_dir)
    steps = {"f1": change("close"), "f2": change("close", 5), "f3": ratio("volume", roll("avg", "volume", 20)), "f4": ratio("high - low", "close"), "y": ratio(lag("close", -5), "close") + " - 1"}
    return staged(apply_steps(bars, steps).select("symbol", "ts", *FEATURES, "y"), "labelled")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).dropna().groupBy("symbol", F.date_trunc("month", "ts").alias("ts")).agg(F.avg(F.when(F.col("f2") * F.col("y") < 0, 1.0).otherwise(0.0)).alias("auc"))


register("ev_6", lambda s, d: rounded(models.importances(labelled(s, d), FEATURES, "y")))
register("ev_7", lambda s, d: rounded(models.evaluate_target(labelled(s, d), FEATURES, "y")))
register("ev_7_views", lambda s, d: rounded(models.views(labelled(s, d), FEATURES, "y")))
register("rg_7", lambda s, d: rounded(models.regime_forecasts(labelled(s, d), FEATURES, "y").groupBy("symbol", "regime").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean_prediction"))))
register("rg_8", lambda s, d: rounded(models.change_points(labelled(s, d), FEATURES, "y").groupBy("symbol", "regime").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean_prediction"))))
register("trd_2", lambda s, d: rounded(models.ridge_forecast(runs(s, d), "auc")))


def placebo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores on the true label, on one dealt anew by hash within its time, and on one a year away: the last two have to collapse."""
    rows = labelled(spark, sf_dir)
    at, dealt = Window.partitionBy("ts").orderBy("symbol"), Window.partitionBy("ts").orderBy(F.md5("symbol"))
    other = rows.select("ts", F.row_number().over(dealt).alias("place"), F.col("y").alias("shuffled"))
    joined = staged(rows.withColumn("place", F.row_number().over(at)).join(other, ["ts", "place"]).withColumn("shifted", F.expr(f"lead(y, 52) OVER ({KEY})")), "placebo")
    parts = [models.evaluate_target(joined, FEATURES, y).withColumn("label", F.lit(y)) for y in ("y", "shuffled", "shifted")]
    return rounded(parts[0].union(parts[1]).union(parts[2]))


register("qa_12_models", placebo)
