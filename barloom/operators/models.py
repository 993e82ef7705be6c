"""Model-backed operators on pyspark.ml: importances, target evaluation, regimes, forecasts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.portable import correlation


def assembled(rows: DataFrame, features: list[str]) -> DataFrame:
    """Rows without nulls, their features as one vector."""
    return VectorAssembler(inputCols=features, outputCol="vec").transform(rows.dropna(subset=features))


def univariate(rows: DataFrame, features: list[str], label: str) -> DataFrame:
    """method, feature, importance: the F statistic of a line through each feature alone, in one pass."""
    found = rows.agg(*(correlation(f, label).alias(f"r{i}") for i, f in enumerate(features)), *(F.count_if(F.col(f).isNotNull() & F.col(label).isNotNull()).alias(f"n{i}") for i, f in enumerate(features)))
    listed = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, f in enumerate(features)))
    r2 = F.pow("x.r", 2)
    return found.select(F.explode(listed).alias("x")).select(F.lit("f_test").alias("method"), "x.feature", F.coalesce(F.try_divide(r2 * (F.col("x.n") - 2), 1 - r2), F.lit(0.0)).alias("importance"))


def mutual_information(rows: DataFrame, features: list[str], label: str, bins: int = 10) -> DataFrame:
    """method, feature, importance in nats, between feature and label cut at their approximate quantiles; counts of at most bins^2 cells a feature."""
    cuts = rows.agg(*(F.percentile_approx(c, F.array(*(F.lit(i / bins) for i in range(1, bins))), 10_000).alias(c) for c in [*features, label])).first()
    cell = lambda c: F.size(F.filter(F.array(*map(F.lit, cuts[c] or [])), lambda b: b < F.col(c)))
    kept = rows.filter(F.col(label).isNotNull()).select(cell(label).alias("y"), *(F.when(F.col(f).isNotNull(), cell(f)).alias(f) for f in features))
    counts = kept.unpivot(["y"], features, "feature", "x").dropna().groupBy("feature", "x", "y").agg(F.count("*").alias("n"))
    total = lambda *by: F.sum("n").over(Window.partitionBy("feature", *by))  # noqa: E731  a few hundred rows
    part = counts.withColumn("i", F.col("n") / total() * F.log(F.col("n") * total() / (total("x") * total("y"))))
    return part.groupBy("feature").agg(F.sum("i").alias("importance")).select(F.lit("mutual_information").alias("method"), "feature", "importance")


def importances(rows: DataFrame, features: list[str], label: str, seed: int = 7, draws: int = 5) -> DataFrame:
    """method, feature, importance of a random forest, boosted trees, lasso, ridge and elastic net over standardised features, F tests, mutual
    information, recursive elimination by the ridge (the round in which a feature goes, the last one highest), and stability selection (the share of
    half samples, dealt by hash, in which the lasso keeps a feature)."""
    held = assembled(rows, features).dropna(subset=[label])
    scaler = StandardScaler(inputCol="vec", outputCol="x", withMean=True).fit(held)
    data = scaler.transform(held).select("x", F.col(label).alias("label"), *features, F.xxhash64(*features, label).alias("dealt")).persist(StorageLevel.MEMORY_AND_DISK)
    spread = float(data.agg(F.stddev_pop("label")).first()[0] or 1.0)
    trees = {"random_forest": RandomForestRegressor(featuresCol="x", numTrees=10, maxDepth=4, seed=seed), "boosted_trees": GBTRegressor(featuresCol="x", maxIter=10, maxDepth=3, seed=seed)}
    found = [(name, f, float(v)) for name, model in trees.items() for f, v in zip(features, model.fit(data).featureImportances.toArray(), strict=True)]
    line = lambda mix, column="x", penalty=0.02: LinearRegression(featuresCol=column, elasticNetParam=mix, regParam=penalty * spread)
    for name, mix in (("lasso", 1.0), ("ridge", 0.0), ("elastic_net", 0.5)):
        found += [(name, f, abs(float(v))) for f, v in zip(features, line(mix).fit(data).coefficients.toArray(), strict=True)]
    left, rounds = list(features), 0
    while left:  # one feature a round
        part = VectorSlicer(inputCol="x", outputCol="some", indices=[features.index(f) for f in left]).transform(data)
        size = np.abs(line(0.0, "some").fit(part).coefficients.toArray())
        found.append(("elimination", left.pop(int(size.argmin())), float(rounds)))
        rounds += 1
    kept = np.zeros(len(features))
    for k in range(draws):
        half = data.filter(F.pmod(F.xxhash64("dealt", F.lit(k)), F.lit(2)) == 0)
        kept += np.abs(line(1.0, penalty=0.05).fit(half).coefficients.toArray()) > 1e-9
    found += [("stability", f, float(v)) for f, v in zip(features, kept / draws, strict=True)]
    data.unpersist()
    return rows.sparkSession.createDataFrame(found, "method string, feature string, importance double").union(univariate(rows, features, label)).union(mutual_information(rows, features, label))


def evaluate_target(rows: DataFrame, features: list[str], label: str, folds: int = 3, purge_days: int = 35) -> DataFrame:
    """Purged time-series CV of a ridge: fold, n_train, n_test, ic, mae. Folds are cut on the distinct times, training ends a purge before a fold."""
    times = rows.select("ts").distinct()
    cut = times.withColumn("fold", F.ntile(folds + 1).over(Window.orderBy("ts")) - 2)  # one row a time, not a row of data
    data = assembled(rows, features).dropna(subset=[label]).join(cut, "ts").cache()
    out = []
    for k, start in data.filter("fold >= 0").groupBy("fold").agg(F.min("ts").alias("start")).orderBy("fold").collect():
        train = data.filter(F.col("ts") <= F.lit(start) - F.expr(f"INTERVAL {purge_days} DAYS"))
        n = train.count()
        if not n:
            continue
        model = LinearRegression(featuresCol="vec", labelCol=label, regParam=0.01).fit(train)
        test = model.transform(data.filter(F.col("fold") == k))
        r = test.agg(F.count("*").alias("n"), correlation(label, "prediction").alias("ic"), F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae")).first()
        out.append((k, n, r["n"], r["ic"], r["mae"]))
    data.unpersist()
    return rows.sparkSession.createDataFrame(out, "fold int, n_train long, n_test long, ic double, mae double")


def views(rows: DataFrame, features: list[str], label: str, symbols: int = 3, leak: float = 0.95) -> DataFrame:
    """view, name, ic, n, leaky, composite: out-of-time IC of a ridge over all symbols, for each of the first symbols by rows on its own, and for all
    but that one tested on it. leaky: features whose own correlation with the label is beyond `leak`. composite: half the IC's size, a quarter
    for its agreeing with the whole's sign, a quarter for up to 400 rows."""
    data = assembled(rows, features).dropna(subset=[label]).persist(StorageLevel.MEMORY_AND_DISK)
    split = data.select("ts").distinct().withColumn("half", F.ntile(4).over(Window.orderBy("ts"))).filter("half = 4").agg(F.min("ts").alias("t")).first()["t"]  # a row a time
    suspects = [f for f, r in zip(features, data.agg(*(correlation(f, label) for f in features)).first(), strict=True) if r is not None and abs(r) > leak]
    early, late = data.filter(F.col("ts") < F.lit(split)), data.filter(F.col("ts") >= F.lit(split))
    largest = [r["symbol"] for r in data.groupBy("symbol").count().orderBy(F.desc("count"), "symbol").limit(symbols).collect()]
    asked = [("cross_sectional", None, early, late)]
    asked += [("symbol", s, early.filter(F.col("symbol") == s), late.filter(F.col("symbol") == s)) for s in largest]
    asked += [("leave_one_out", s, early.filter(F.col("symbol") != s), late.filter(F.col("symbol") == s)) for s in largest]
    out = []
    for view, name, train, test in asked:
        r = LinearRegression(featuresCol="vec", labelCol=label, regParam=0.01).fit(train).transform(test).agg(correlation(label, "prediction").alias("ic"), F.count("*").alias("n")).first()
        out.append((view, name, r["ic"], r["n"]))
    data.unpersist()
    sign = np.sign(out[0][2] or 0.0)
    scored = [(v, s, ic, n, ",".join(suspects), 0.5 * abs(ic or 0.0) + 0.25 * float(np.sign(ic or 0.0) == sign) + 0.25 * min(n / 400, 1.0)) for v, s, ic, n in out]
    return rows.sparkSession.createDataFrame(scored, "view string, name string, ic double, n long, leaky string, composite double")


def latent_regimes(rows: DataFrame, features: list[str], k: int = 3, seed: int = 7, least_variance: float = 1e-12, kept: float = 0.95) -> DataFrame:
    """symbol, ts, regime, p: features that vary are scaled, projected on as many components as hold `kept` of their variance, and clustered by a
    Gaussian mixture; p is the probability of each regime."""
    spread = rows.agg(*(F.var_pop(f).alias(f) for f in features)).first()
    varied = [f for f in features if (spread[f] or 0.0) > least_variance]
    data = assembled(rows, varied)
    data = StandardScaler(inputCol="vec", outputCol="x", withMean=True).fit(data).transform(data)
    share = np.cumsum(PCA(k=len(varied), inputCol="x", outputCol="pc").fit(data).explainedVariance.toArray())
    data = PCA(k=int(np.searchsorted(share, kept - 1e-9)) + 1, inputCol="x", outputCol="pc").fit(data).transform(data)
    return GaussianMixture(featuresCol="pc", k=k, seed=seed).fit(data).transform(data).withColumn("p", vector_to_array("probability")).withColumnRenamed("prediction", "regime")


def regime_forecasts(rows: DataFrame, features: list[str], label: str, k: int = 3, seed: int = 7) -> DataFrame:
    """symbol, ts, regime, prediction: a ridge for each regime, its rows weighed by their probability of it; the prediction is the regimes' mean,
    weighed alike."""
    data = latent_regimes(rows.dropna(subset=[label]), features, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for c in range(k):
        weighed = data.withColumn("w", F.get("p", F.lit(c)))
        model = LinearRegression(featuresCol="x", labelCol=label, weightCol="w", regParam=0.1).fit(weighed.filter("w > 1e-6"))
        parts.append((model.coefficients.toArray(), model.intercept))
    x = vector_to_array("x")
    each = [sum((F.get(x, F.lit(i)) * float(w) for i, w in enumerate(ws)), F.lit(float(b))) for ws, b in parts]
    return data.select("symbol", "ts", "regime", sum((F.get("p", F.lit(c)) * e for c, e in enumerate(each)), F.lit(0.0)).alias("prediction"))


def change_points(rows: DataFrame, features: list[str], label: str, seed: int = 7) -> DataFrame:
    """Two k-means regimes and a ridge in each: symbol, ts, regime, prediction."""
    data = assembled(rows, features).dropna(subset=[label])
    data = KMeans(featuresCol="vec", predictionCol="regime", k=2, seed=seed).fit(data).transform(data)
    parts = [LinearRegression(featuresCol="vec", labelCol=label, regParam=0.1).fit(p).transform(p) for c in range(2) if not (p := data.filter(F.col("regime") == c)).isEmpty()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("symbol", "ts", "regime", "prediction")


def ridge_forecast(runs: DataFrame, value: str, ridge: float = 1.0, half_life: float = 6.0) -> DataFrame:
    """Weighted ridge on the run's place with a walk-forward error: symbol, forecast, mae. A group is a series of runs, a few hundred rows."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("ts")[value].to_numpy(dtype=float)

        def ahead(part: np.ndarray) -> float:
            n = len(part)
            x, w = np.stack([np.ones(n), np.arange(n) / 10], axis=1), 0.5 ** ((n - 1 - np.arange(n)) / half_life)
            beta = np.linalg.solve(x.T @ (w[:, None] * x) + ridge * np.diag([0.0, 1.0]), x.T @ (w * part))
            return float(beta[0] + beta[1] * n / 10)

        errors = [abs(ahead(y[:i]) - y[i]) for i in range(4, len(y))]
        return pd.DataFrame({"symbol": [pdf["symbol"].iloc[0]], "forecast": [ahead(y)], "mae": [float(np.mean(errors)) if errors else None]})

    return runs.select("symbol", "ts", value).dropna().groupBy("symbol").applyInPandas(fit, "symbol string, forecast double, mae double")
