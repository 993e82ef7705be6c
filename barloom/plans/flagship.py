"""One question end to end: the information coefficient of each feature for the return of the next bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.portable import apply_steps
from barloom.operators import features, targets
from barloom.plans.registry import register, rounded
from barloom.sources import panels

GROUPS = {"FT-9": ["mom_5d", "price_momentum_20d"], "FT-10": ["volatility_20d"], "FT-16": ["rsi_14"], "FT-18": ["bb_percent_b_20"], "FT-38": ["volume_ratio_20d"]}
NAMES = [n for names in GROUPS.values() for n in names]


def feature_ic(spark: SparkSession, sf_dir: str, horizon: int = 5, least: int = 10) -> DataFrame:
    """feature, n_ts, mean_ic, ic_ir, best first."""
    bars = panels.weekly_bars(spark, sf_dir)
    built = reduce(lambda df, group: df.transform(features.add_group, group), GROUPS, bars)
    rows = apply_steps(built, *targets.forward_returns((horizon,))).select("symbol", "ts", F.col(f"fwd_ret_{horizon}").alias("y"), *NAMES)
    long = rows.unpivot(["symbol", "ts", "y"], NAMES, "feature", "x").dropna(subset=["x", "y"])
    ranked = long.select("feature", "ts", *(F.rank().over(Window.partitionBy("feature", "ts").orderBy(c)).alias(f"r{c}") for c in ("x", "y")))
    per_ts = ranked.groupBy("feature", "ts").agg(F.count("*").alias("n"), F.corr("rx", "ry").alias("ic")).filter(F.col("n") >= least)
    out = per_ts.groupBy("feature").agg(F.count("ic").alias("n_ts"), F.avg("ic").alias("mean_ic"), F.try_divide(F.avg("ic"), F.stddev_samp("ic")).alias("ic_ir"))
    return rounded(out.orderBy(F.desc(F.abs("mean_ic")), "feature"))


def _sql(horizon: int = 5, least: int = 10) -> str:
    from barloom.functions.portable import change, lag, ratio, roll, steps_sql

    exprs = {"mom_5d": change("close", 5), "price_momentum_20d": change("close", 20), "volume_ratio_20d": ratio("volume", roll("avg", "volume", 20)), "y": ratio(lag("close", -horizon), "close") + " - 1", "ret": change("close"), "d": f"close - {lag('close')}", "m20": roll("avg", "close", 20), "s20": roll("stddev_samp", "close", 20)}
    second = {"volatility_20d": roll("stddev_samp", "ret", 20), "bb_percent_b_20": ratio("close - (m20 - 2 * s20)", "4 * s20"), "gain": "CASE WHEN d IS NOT NULL THEN greatest(d, 0.0) END", "loss": "CASE WHEN d IS NOT NULL THEN greatest(-d, 0.0) END"}
    third = {"rsi_14": f"CASE WHEN {roll('avg', 'loss', 14)} = 0 THEN 100.0 ELSE 100 - 100 / (1 + {roll('avg', 'gain', 14)} / nullif({roll('avg', 'loss', 14)}, 0)) END"}
    inner = steps_sql(f"({panels.BARS_W})", panels.BAR_COLUMNS, exprs, second, third)
    long = " UNION ALL ".join(f"SELECT symbol, ts, y, '{n}' AS feature, {n} AS x FROM b" for n in NAMES)
    return f"""WITH b AS (SELECT * FROM {inner}), l AS ({long}),
r AS (SELECT feature, ts, rank() OVER (PARTITION BY feature, ts ORDER BY x) AS rx, rank() OVER (PARTITION BY feature, ts ORDER BY y) AS ry FROM l WHERE x IS NOT NULL AND y IS NOT NULL),
p AS (SELECT feature, ts, corr(rx, ry) AS ic FROM r GROUP BY feature, ts HAVING count(*) >= {least})
SELECT feature, count(ic) AS n_ts, round(avg(ic) + 3e-8, 6) AS mean_ic, round(avg(ic) / stddev_samp(ic) + 3e-8, 6) AS ic_ir FROM p GROUP BY feature"""


register("feature_ic", feature_ic, _sql())
