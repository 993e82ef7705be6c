"""How well a target can be told, seen from every side: over all symbols, within each, and from all others to each."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.moments import fit_quality, products, ridge

VIEWS = "view string, name string, n_train long, n_test long, ic double, mse double, leaky string, composite double"


def split_time(df: DataFrame, test_share: float):
    """The first time of the test part: the last distinct times, so many of all of them."""
    order = Window.orderBy("ts")
    times = df.select("ts").distinct().select("ts", F.percent_rank().over(order).alias("p"))  # a row a time
    return times.filter(F.col("p") >= 1 - test_share).agg(F.min("ts").alias("t")).first()["t"]


def symbol_views(df: DataFrame, features: list[str], label: str, test_share: float = 0.25, penalty: float = 0.01, leak: float = 0.95, whole_rows: int = 400) -> DataFrame:
    """VIEWS: a ridge's out-of-time quality for `cross_sectional` (all symbols), and of every symbol for `symbol` (fitted on it alone) and
    `leave_one_out` (fitted on all others, tested on it).

    One scan sums the products of features and label by symbol and part; whatever is fitted or tested is made of these sums: leaving a symbol out is
    the total less its own, and a correlation or an error of a linear prediction needs no rows. Symbols are fitted side by side, a matrix each; the
    driver sees the total alone. leaky: features whose own correlation with the label is beyond `leak` over all rows; composite: half the size of the
    correlation, a quarter for agreeing with the sign over all symbols, a quarter for up to whole_rows test rows. A view without rows to
    train or test on has no ic; no rows give no views.
    """
    start = split_time(df, test_share)
    if start is None:
        return df.sparkSession.createDataFrame([], VIEWS)
    part = F.when(F.col("ts") >= F.lit(start), "test").otherwise("train")
    sums = products(df.filter(F.col("symbol").isNotNull()).withColumn("part", part), ["symbol", "part"], features, label)
    each = sums.groupBy("symbol").agg(*(F.max(F.when(F.col("part") == p, F.col("m"))).alias(p) for p in ("train", "test"))).persist()
    size = len(features) + 2
    totals = each.select(*(F.posexplode_outer(p).alias(f"i_{p}", f"v_{p}") for p in ("train",))).groupBy("i_train").agg(F.sum("v_train").alias("v")).orderBy("i_train").collect()
    tested = each.select(F.posexplode_outer("test").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()  # size * size numbers
    square = lambda rows, c: np.array([r["v"] for r in rows if r[c] is not None]).reshape(size, size) if any(r[c] is not None for r in rows) else np.zeros((size, size))
    train, test = square(totals, "i_train"), square(tested, "i")
    both = train + test
    n = max(both[0, 0], 1.0)
    mean, cov = both[0] / n, both / n - np.outer(both[0], both[0]) / n / n
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    own = [cov[i + 1, size - 1] / (sd[i + 1] * sd[-1]) if sd[i + 1] * sd[-1] > 1e-12 * (1 + abs(mean[i + 1])) else 0.0 for i in range(len(features))]
    leaky = ",".join(f for f, r in zip(features, own, strict=True) if abs(r) > leak)

    def seen(view: str, name: str | None, fitted: np.ndarray, held: np.ndarray, sign: float) -> tuple:
        ic, mse = fit_quality(held, ridge(fitted, penalty)) if fitted[0, 0] > 1 and held[0, 0] > 1 else (None, None)
        score = 0.5 * abs(ic or 0.0) + 0.25 * float(ic is not None and np.sign(ic) == sign) + 0.25 * min(held[0, 0] / whole_rows, 1.0)
        return view, name, int(round(fitted[0, 0])), int(round(held[0, 0])), ic, mse, leaky, float(score)

    whole = seen("cross_sectional", None, train, test, 0.0)
    sign = float(np.sign(whole[4] or 0.0))
    whole = (*whole[:-1], whole[-1] + (0.25 if whole[4] else 0.0))

    def fits(batches):
        for batch in batches:
            rows = []
            for symbol, a, b in zip(batch["symbol"], batch["train"], batch["test"], strict=True):
                mine, held = (np.zeros((size, size)) if m is None else np.asarray(m, dtype=float).reshape(size, size) for m in (a, b))
                rows += [seen("symbol", symbol, mine, held, sign), seen("leave_one_out", symbol, train - mine, held, sign)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in VIEWS.split(", ")])

    return df.sparkSession.createDataFrame([whole], VIEWS).union(each.mapInPandas(fits, VIEWS))
