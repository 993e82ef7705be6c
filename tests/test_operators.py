from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from barloom.functions.ewm import with_means
from barloom.functions.portable import apply_steps
from barloom.operators import features, metadata, targets
from barloom.operators.zigzag import zigzag
from barloom.plans import registry
from barloom.streaming import live


def bars(spark, prices, symbol="A"):
    rows = [(symbol, i, float(p), float(p), float(p), float(p), 10, float(p), 1) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume long, vwap double, n_trades long")


def column(df, name):
    return [r[name] for r in df.orderBy("ts").select(name).collect()]


def test_horizon_is_whole_bars_and_needs_an_interval():
    assert targets.horizon_bars(15, 5) == 3
    assert targets.horizon_bars(17, 5) == 3
    for interval in (0, None, -5):
        with pytest.raises(ValueError):
            targets.horizon_bars(15, interval)


def test_first_touch_by_hand(spark):
    prices = [100, 101, 100, 101, 100, 101, 100, 120, 100, 80, 100, 101, 100]
    found = column(apply_steps(bars(spark, prices), *targets.barrier(3, 1.0)), "y_first_touch")
    assert found[6] == 1  # the next close is far above the barrier
    assert found[-3:] == [None] * 3  # fewer than three bars follow
    assert found[0] is None  # no volatility yet


def test_labels_look_only_ahead_and_only_h_bars(spark):
    prices = 100 + np.cumsum(np.random.default_rng(42).normal(size=60) * 0.5)
    steps = targets.barrier(5, 0.5)
    before = column(apply_steps(bars(spark, prices), *steps), "y_first_touch")
    later = prices.copy()
    later[46:] *= 2  # beyond bar 40 + 5
    assert column(apply_steps(bars(spark, later), *steps), "y_first_touch")[:41] == before[:41]


def test_features_do_not_look_ahead(spark):
    prices = 100 + np.cumsum(np.random.default_rng(1).normal(size=80))
    later = prices.copy()
    later[60:] += 7
    for group in ("FT-9", "FT-16", "FT-18", "FT-21"):
        a, b = (features.add_group(bars(spark, p), group).filter("ts < 60").orderBy("ts").collect() for p in (prices, later))
        assert a == b


def test_ewm_is_adjusted_and_skips_nulls(spark):
    x = [1.0, None, 3.0, 4.0, None, 2.0, 8.0]
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(x)], "symbol string, ts long, x double")
    df = with_means(df.union(df.selectExpr("'B'", "ts", "2 * x")), {"e": ("x", 5)}).filter("symbol = 'A'")
    expected = pd.Series(x).ewm(span=5, adjust=True).mean()
    for got, want, v in zip(column(df, "e"), expected, x, strict=True):
        assert (got is None) if v is None else got == pytest.approx(want, rel=1e-9)


def test_ewm_carries_over_batches(spark):
    x = np.random.default_rng(3).normal(size=4000)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame([(s, i, float(v)) for s in "AB" for i, v in enumerate(x)], "symbol string, ts long, x double")
        got = column(with_means(df, {"e": ("x", 20)}).filter("symbol = 'B'"), "e")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert got == pytest.approx(pd.Series(x).ewm(span=20, adjust=True).mean().tolist(), rel=1e-9)


def test_zigzag(spark):
    found = zigzag(bars(spark, [100, 111, 120, 100, 90, 105]), 0.1).orderBy("ts").collect()
    assert [r["direction"] for r in found] == [0, 1, 1, -1, -1, 1]


def plain_zigzag(closes, reversal):
    out, extreme, direction = [], None, 0
    for c in closes:
        if c is not None:
            if extreme is None:
                extreme = c
            elif direction >= 0 and c <= extreme * (1 - reversal):
                extreme, direction = c, -1
            elif direction <= 0 and c >= extreme * (1 + reversal):
                extreme, direction = c, 1
            elif (direction > 0 and c > extreme) or (direction < 0 and c < extreme):
                extreme = c
        out.append((extreme, direction))
    return out


@pytest.mark.parametrize("batch", [7, 10_000])
def test_zigzag_over_batches(spark, batch):
    rng = np.random.default_rng(3)
    closes = {s: [None if rng.random() < odds else float(round(v, 3)) for v in 100 * np.exp(np.cumsum(rng.normal(0, size, 400)))] for s, odds, size in (("A", 0, 0.03), ("B", 0.2, 0.05), ("C", 0, 0.0005))} | {"D": [None, None], "E": [None, 5.0, 5.0, 4.0]}
    df = spark.createDataFrame([(s, i, c) for s, cs in closes.items() for i, c in enumerate(cs)], "symbol string, ts long, close double").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = {(r["symbol"], r["ts"]): (r["pivot"], r["direction"]) for r in zigzag(df, 0.1).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {(s, i): v for s, cs in closes.items() for i, v in enumerate(plain_zigzag(cs, 0.1))}
    assert zigzag(df.limit(0), 0.1).collect() == []


def test_asof_never_looks_ahead(spark, sf_dir):
    joined = registry.QUERIES["jn_1"](spark, sf_dir)
    assert joined.filter(F.col("avail") > F.col("ts")).isEmpty()
    assert joined.count() == registry.QUERIES["prj_4"](spark, sf_dir).count()


def test_lookbacks(spark):
    expected = {"price_momentum_60d": 86400, "volume_momentum_20d": 28800, "volatility_3d": 4320, "market_correlation_60d": 86400, "rsi_30": 150, "cci_30": 150, "hour_of_day": 0, "vol_24h": 1440, "ret_15m": 15, "unknown_thing": 1440}
    names = spark.createDataFrame([(n,) for n in expected], "feature string")
    assert {r["feature"]: r["lookback_min"] for r in metadata.feature_meta(names, 5.0).collect()} == expected


def test_names_decide_what_may_be_used(spark):
    features = metadata.feature_meta(spark.createDataFrame([(n,) for n in ("fwd_ret_30m", "zigzag_high", "ret_30m", "rsi_14", "ichimoku_chikou")], "feature string"))
    targets = metadata.target_meta(spark.createDataFrame([("y_will_peak_30m_0.5",), ("tth_2h",)], "target string"))
    found = {(r["target"], r["feature"]): r["reason"] for r in metadata.excluded(features, targets, spark.createDataFrame([("^rsi",)], "pattern string")).collect()}
    assert [found["y_will_peak_30m_0.5", f] for f in ("fwd_ret_30m", "zigzag_high", "ret_30m", "rsi_14", "ichimoku_chikou")] == ["other_target", "kept", "overlap", "pattern", "looks_ahead"]
    ok = {(r["target"], r["feature"]): r["reason"] for r in metadata.conditional(features, targets).collect()}
    assert ok["y_will_peak_30m_0.5", "zigzag_high"] == "lookback" and ok["tth_2h", "rsi_14"] == "ok"
    asked = spark.createDataFrame([("TTH_2h_x",), ("none",)], "asked string")
    assert {r["asked"]: r["target"] for r in metadata.resolved(asked, targets).collect()} == {"TTH_2h_x": "tth_2h", "none": None}


def test_ring_buffer_fills_and_is_dropped_when_quiet(spark, tmp_path):
    at = lambda minutes: f"2024-01-01 {minutes // 60:02d}:{minutes % 60:02d}:00"
    batches = [[("A", at(i), 1.0 + i, i) for i in range(5)] + [("B", at(2), float("nan"), 90)], [("B", at(300 + i), 2.0 + i, 100 + i) for i in range(3)], [("B", at(310), 9.0, 200), ("A", at(1), 99.0, 300)]]
    for rows in batches:
        df = spark.createDataFrame(rows, "symbol string, ts string, price double, event_id long").withColumn("ts", F.to_timestamp("ts"))
        df.select("symbol", "ts", "price", F.struct("event_id").alias("tie")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    found = live.drained(live.ring_buffer(stream, 3, 600.0, "10 minutes"), str(tmp_path), "update").collect()
    by = {}
    for r in sorted(found, key=lambda r: r["number"]):
        by.setdefault(r["symbol"], []).append((r["prices"], r["ready"]))
    assert by["A"][0] == ([3.0, 4.0, 5.0], True) and ([], False) in by["A"][1:]
    assert by["B"][-1] == ([3.0, 4.0, 9.0], True)


def test_empty_bars(spark):
    empty = bars(spark, [1.0]).limit(0)
    assert features.add_group(empty, "FT-16").collect() == []
    assert targets.add_labels(empty, *targets.barrier(3)).collect() == []
