"""Sums of products of columns, by group, in one scan; correlations, greedy selection and linear fits come from them without another look at the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

#: Names of a pair's sums: rows that hold both, the first's, its squares', the second's, its squares', the products'.
SUMS = ("n", "sx", "sxx", "sy", "syy", "sxy")


def _matrix(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(batch.schema.get_field_index(c)).to_pandas(), dtype=float) for c in columns]) if batch.num_rows else np.empty((0, len(columns)))


def _shift(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """A value near each column's own, so that sums of squares keep their digits: that of one row."""
    row = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).dropna().first()
    found = np.array([0.0 if row is None else row[c] for c in columns])
    return np.where(np.isfinite(found), found, 0.0)


def pair_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """i, j (i < j, places in columns) and SUMS over the rows where both are finite, of every pair of columns.

    A task multiplies its Arrow batches into matrices of columns by columns, and gives one row a pair; Spark adds them up. So a scan serves
    hundreds of columns, and neither a plan nor a task grows with the square of their number beyond those matrices."""
    shift, k = _shift(df, columns), len(columns)
    upper = np.triu_indices(k, 1)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, k, k))
        for batch in batches:
            x = _matrix(batch, columns) - shift
            there = np.isfinite(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            sums += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        n, s, ss, p = sums
        parts = [n[upper], s[upper], ss[upper], s.T[upper], ss.T[upper], p[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *map(pa.array, parts)], names=["i", "j", *SUMS])

    schema = StructType([StructField(c, IntegerType()) for c in "ij"] + [StructField(c, DoubleType()) for c in SUMS])
    held = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).mapInArrow(multiplied, schema)
    return held.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in SUMS))


def correlation() -> Column:
    """Pearson's coefficient out of SUMS; null where either column doesn't vary."""
    spread = lambda s, ss: F.col(ss) * F.col("n") - F.col(s) * F.col(s)
    x, y = spread("sx", "sxx"), spread("sy", "syy")
    least = 1e-12 * F.col("n")
    varies = (x > least * F.col("sxx")) & (y > least * F.col("syy"))
    return F.when(varies, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(x * y))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """fa, fb, n, corr of every pair of columns, over the rows that hold both."""
    name = lambda c: F.element_at(F.array(*map(F.lit, columns)), F.col(c) + 1)
    return pair_sums(df, columns).select(name("i").alias("fa"), name("j").alias("fb"), F.col("n").cast("long").alias("n"), correlation().alias("corr"))


def selected(df: DataFrame, features: list[str], label: str, most: float = 0.95, count: int | None = None) -> DataFrame:
    """feature, place, corr, kept, because: features in the order of the size of their correlation with the label (equal ones by name, those without
    one last); one goes if it correlates beyond `most` with one that is kept before it, which is named, or if `count` are kept already. One
    scan; the pass itself is over a matrix of features by features."""
    spark = df.sparkSession
    rows = correlations(df, [*features, label]).collect()  # a row a pair of columns
    with_label = {r["fa"]: r["corr"] for r in rows if r["fb"] == label}
    between = {frozenset((r["fa"], r["fb"])): abs(r["corr"] or 0.0) for r in rows if r["fb"] != label}
    order = sorted(features, key=lambda f: (with_label.get(f) is None, -round(abs(with_label.get(f) or 0.0), 12), f))
    kept, out = [], []
    for place, f in enumerate(order, 1):
        full = count is not None and len(kept) >= count
        twin = next((g for g in kept if between.get(frozenset((f, g)), 0.0) > most), None)
        if not full and twin is None:
            kept.append(f)
        out.append((f, place, with_label.get(f), f in kept, "count" if full else twin))
    return spark.createDataFrame(out, "feature string, place int, corr double, kept boolean, because string")


def products(df: DataFrame, by: list[str], features: list[str], label: str) -> DataFrame:
    """by, m: for each group the matrix of sums of products of (1, features, label), row by row as one array, over the rows that hold all. Groups
    combine within a task before the shuffle; a group's matrix is the only thing that meets."""
    columns = [*features, label]
    size = len(columns) + 1
    whole = df.select(*by, *(F.col(c).cast("double").alias(c) for c in columns)).dropna(subset=columns)
    for c in columns:
        whole = whole.filter(~F.isnan(c) & (F.abs(c) < float("inf")))

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for name, own in batch.groupby(by, dropna=False, sort=False):
                x = np.column_stack([np.ones(len(own)), own[columns].to_numpy(dtype=float)])
                sums[name] = sums.get(name, 0.0) + x.T @ x
        for name, m in sums.items():
            yield pd.DataFrame({**dict(zip(by, name, strict=True)), "cell": np.arange(size * size, dtype=np.int32), "v": m.ravel()})

    schema = StructType([*(whole.schema[b] for b in by), StructField("cell", IntegerType()), StructField("v", DoubleType())])
    cells = whole.mapInPandas(multiplied, schema).groupBy(*by, "cell").agg(F.sum("v").alias("v"))
    return cells.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "v"))), lambda c: c["v"]).alias("m"))  # size * size cells a group


def ridge(m: np.ndarray, penalty: float) -> np.ndarray:
    """Intercept and weights of a ridge out of a matrix of products(); features are scaled to unit variance, those that don't vary weigh nothing."""
    n, k = m[0, 0], len(m) - 2
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[:k], 0.0))
    varies = sd > 1e-9 * (1 + np.abs(mean[:k]))
    weights = np.zeros(k)
    if varies.any():
        scale = sd[varies]
        gram = cov[:k, :k][np.ix_(varies, varies)] / np.outer(scale, scale)
        weights[varies] = np.linalg.solve(gram + penalty * np.eye(len(scale)), cov[:k, k][varies] / scale) / scale
    return np.concatenate([[mean[k] - weights @ mean[:k]], weights])


def fit_quality(m: np.ndarray, weights: np.ndarray) -> tuple[float | None, float]:
    """Correlation of a linear prediction with the label, and its mean squared error, over the rows of a matrix of products()."""
    n, k = m[0, 0], len(m) - 1
    x, xy, yy = m[:k, :k], m[:k, k], m[k, k]
    p, pp, py = weights @ m[0, :k], weights @ x @ weights, weights @ xy
    spread, own = pp / n - (p / n) ** 2, yy / n - (m[0, k] / n) ** 2
    varies = spread > 1e-12 * (1 + pp / n) and own > 1e-12 * (1 + yy / n)
    return float((py / n - p / n * m[0, k] / n) / np.sqrt(spread * own)) if varies else None, float(max((yy - 2 * py + pp) / n, 0.0))
