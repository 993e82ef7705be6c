"""Fitted operators over rows whose structure is known."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from barloom.operators import evaluation, models
from barloom.plans import registry


@pytest.fixture(scope="module")
def rows(spark):
    rng, start = np.random.default_rng(5), datetime.datetime(2024, 1, 1)
    made = []
    for i in range(1200):
        f1, f2, f3 = (float(v) for v in rng.normal(size=3))
        made.append((str(i % 4), start + datetime.timedelta(days=i // 4), f1, f2, f3, 1.0, 2 * f1 + 0.3 * f2 + float(rng.normal()) * 0.2))
    return spark.createDataFrame(made, "symbol string, ts timestamp, f1 double, f2 double, f3 double, same double, y double").cache()


def test_every_method_ranks_the_feature_that_matters_first(rows):
    found = models.importances(rows, ["f1", "f2", "f3"], "y").collect()
    by = {}
    for r in found:
        by.setdefault(r["method"], {})[r["feature"]] = r["importance"]
    assert set(by) == {"random_forest", "boosted_trees", "lasso", "ridge", "elastic_net", "elimination", "stability", "f_test", "mutual_information"}
    for method, of in by.items():
        assert max(of, key=of.get) == "f1" and of["f1"] > of["f3"], method
    pdf = rows.toPandas()
    r = np.corrcoef(pdf["f1"], pdf["y"])[0, 1]
    assert by["f_test"]["f1"] == pytest.approx(r * r * 1198 / (1 - r * r), rel=1e-6)
    assert by["elimination"]["f1"] == 2.0 and by["stability"]["f1"] == 1.0 and by["mutual_information"]["f3"] < 0.1


def test_folds_are_purged_and_score_well(rows):
    found = models.evaluate_target(rows, ["f1", "f2", "f3"], "y", 3, 10).collect()
    assert [r["fold"] for r in found] == [0, 1, 2] and all(r["ic"] > 0.95 for r in found)
    assert [r["n_train"] for r in found] == sorted(r["n_train"] for r in found)
    assert found[0]["n_train"] <= 4 * (75 - 9)
    seen = {(r["view"], r["name"]): r for r in models.views(rows.withColumn("copy", F.col("y") * 2), ["f1", "copy"], "y").collect()}
    assert len(seen) == 7 and all(r["leaky"] == "f1,copy" and r["ic"] > 0.99 and 0.9 < r["composite"] <= 1.0 or r["n"] < 400 for r in seen.values())


def test_regimes_and_forecasts(rows, spark):
    pdf = models.regime_forecasts(rows, ["f1", "f2", "f3", "same"], "y").toPandas().merge(rows.toPandas(), on=["symbol", "ts"])
    assert len(pdf) == 1200 and np.corrcoef(pdf["prediction"], pdf["y"])[0, 1] > 0.9
    two = spark.createDataFrame([("A", i, float(i % 2 * 50 + i % 3), float(i % 2 * 50)) for i in range(200)], "symbol string, ts int, f double, y double")
    kinds = models.change_points(two, ["f"], "y").toPandas()
    assert kinds.groupby(kinds["ts"] % 2)["regime"].nunique().tolist() == [1, 1] and kinds["regime"].nunique() == 2


def test_ridge_forecast_follows_a_line(spark):
    runs = spark.createDataFrame([("A", i, 0.5 + 0.01 * i) for i in range(30)] + [("B", 0, 0.7)], "symbol string, ts int, v double")
    found = {r["symbol"]: r for r in models.ridge_forecast(runs, "v", ridge=1e-6).collect()}
    assert found["A"]["forecast"] == pytest.approx(0.8, abs=1e-3) and found["A"]["mae"] < 1e-3 and found["B"]["mae"] is None


def test_exact_quantile_and_auc(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=3000), 2)
    df = spark.createDataFrame([(float(v), int(v + rng.normal() > 0), "a") for v in x] + [(None, 1, "a")], "x double, p int, k string")
    for p in (0.0, 0.3, 0.5, 0.9999, 1.0):
        assert evaluation.exact_quantile(df, F.col("x"), p) == pytest.approx(np.quantile(x, p))
    assert evaluation.exact_quantile(df.limit(0), F.col("x"), 0.5) is None
    held = df.dropna().toPandas()
    pos, neg = held[held["p"] == 1]["x"].to_numpy(), held[held["p"] == 0]["x"].to_numpy()
    expected = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert evaluation.auc(df, "k", "x", F.col("p") == 1).first()["auc"] == pytest.approx(expected)
    prints = [d.agg(evaluation.fingerprint(F.col("x"), F.col("p")).alias("f")).first()["f"] for d in (df, df.orderBy("x"), df.withColumn("p", F.when(F.col("x") == float(x[7]), 1 - F.col("p")).otherwise(F.col("p"))))]
    assert prints[0] == prints[1] != prints[2]


def test_crowded_brackets_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "MOST_ORDERED", 40)
    monkeypatch.setattr(evaluation, "BRACKET", 0.02)
    x = np.concatenate([np.random.default_rng(5).normal(size=9000), np.zeros(3000)])
    df = spark.createDataFrame([(float(v), float(v) ** 2) for v in x] + [(None, None)], "x double, z double")
    ps = [0.0, 0.1, 0.4, 0.5, 0.9, 1.0]
    found = evaluation.exact_quantiles(df, ["x", "z"], ps)
    for p in ps:
        assert found["x", p] == pytest.approx(np.quantile(x, p)) and found["z", p] == pytest.approx(np.quantile(x**2, p))
        assert evaluation.exact_quantile(df, F.col("x"), p) == pytest.approx(np.quantile(x, p))


@pytest.mark.parametrize("name", ["rg_8", "rg_7", "qa_12_models"])
def test_fits_go_through_rows_written_once(spark, sf_dir, name, monkeypatch):
    """No pass of a fit makes the bars anew."""
    seen = []

    def watched(make):
        def called(rows, *more):
            seen.append(rows.inputFiles())
            return make(rows, *more)

        return called

    for f in ("change_points", "regime_forecasts", "evaluate_target"):
        monkeypatch.setattr(models, f, watched(getattr(models, f)))
    assert registry.QUERIES[name](spark, sf_dir).count() > 0
    assert seen and not any("lineitem" in f for files in seen for f in files)
