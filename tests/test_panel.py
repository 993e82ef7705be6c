from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from barloom.operators import panel
from barloom.sources import bars, panels


def test_bars_survive_a_round_trip_and_prune(spark, sf_dir):
    df = panels.weekly_bars(spark, sf_dir).filter("ts < '1995-04-01'").cache()
    one, two = [r["symbol"] for r in df.select("symbol").distinct().orderBy("symbol").limit(2).collect()]
    root = tempfile.mkdtemp(prefix="spark-") + "/bars"
    bars.write_bars(df, root, "1w")
    back = bars.scan_bars(spark, root, [one, two], "1w")
    assert back.count() == df.filter(F.col("symbol").isin(one, two)).count()
    assert "PartitionFilters: [isnotnull" in back._jdf.queryExecution().toString()
    assert bars.load_panel(back, 3).groupBy("symbol").count().filter("count > 3").isEmpty()
    report = {r["symbol"]: r["status"] for r in bars.load_report(back, spark.createDataFrame([(one,), ("none",)], "symbol string")).collect()}
    assert report == {one: "loaded", "none": "file_not_found"}
    with pytest.raises(ValueError):
        bars.write_bars(df.limit(0), root, "1w")
    with pytest.raises(ValueError):
        bars.checked(df.drop("close"))
    assert dict(bars.narrowed(df.withColumn("f", F.lit(1.5))).dtypes)["f"] == "float"
    assert bars.without_targets(df.withColumn("y_x", F.lit(1))).columns == df.columns


def test_asof_by_hand(spark):
    at = lambda m: f"2024-01-01 00:{m:02d}:00"
    base = spark.createDataFrame([("A", at(m), float(m)) for m in (0, 5, 10, 40)] + [("B", at(5), 1.0)], "symbol string, ts string, x double").withColumn("ts", F.to_timestamp("ts"))
    slow = spark.createDataFrame([("A", at(0), 1.0), ("A", at(5), 2.0)], "symbol string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    found = {(r["symbol"], r["ts"].minute): r["v"] for r in panel.asof_join(base, slow, ["v"], 5, 20).collect()}
    assert found == {("A", 0): None, ("A", 5): 1.0, ("A", 10): 2.0, ("A", 40): None, ("B", 5): None}


def test_cross_sections_and_folds(spark):
    df = spark.createDataFrame([(str(s), t, float(s if s < 3 else 2)) for t in range(20) for s in range(5)], "symbol string, ts int, x double")
    row = {r["symbol"]: r["r"] for r in df.withColumn("r", panel.rank_normalised("x")).filter("ts = 0").collect()}
    assert row == {"0": 0.2, "1": 0.4, "2": 0.8, "3": 0.8, "4": 0.8}
    assert df.withColumn("z", panel.zscore("x", 5)).groupBy("ts").agg(F.abs(F.sum("z")).alias("s")).filter("s > 1e-9").isEmpty()
    assert panel.capped(df, 2).count() == 40
    timed = df.withColumn("ts", F.timestamp_seconds(F.col("ts") * 86400))
    folded, cuts = panel.purged_folds(timed, 4, "2 DAYS")
    assert {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()} == {0: 25, 1: 25, 2: 25, 3: 25}
    train = folded.join(cuts.filter("test_fold = 2"), F.col("ts") <= F.col("cutoff"))
    assert train.agg(F.max(F.unix_timestamp("ts"))).first()[0] == 8 * 86400
    seq = df.withColumn("q", panel.sequences(["x"], 3)).filter("symbol = '1'").orderBy("ts").collect()
    assert seq[1]["q"] is None and seq[2]["q"] == [[1.0]] * 3
