"""Cross-sections, sampling, splits, sorts and sets over the weekly panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.functions.portable import apply_steps, change, lag, over, ratio
from barloom.operators import evaluation, panel
from barloom.plans.bar_queries import KEY, TS, F, L, R
from barloom.plans.registry import sql_op
from barloom.sources import panels


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars with four features and the return of the next five bars."""
    steps = {"f1": change("close"), "f2": change("close", 5), "f3": "volume / nullif(avg(volume) " + over(19) + ", 0)", "f4": ratio("high - low", "close"), "y": ratio(lag("close", -5), "close") + " - 1"}
    return apply_steps(panels.weekly_bars(spark, sf_dir), steps)


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir).dropna(subset=["y", "f1", "f2"])
    wide = rows.join(rows.groupBy("ts").agg(fn.count("*").alias("n")).filter("n >= 10").select("ts"), "ts")
    return panel.capped(wide, 20).select("symbol", "ts", "y", "f1", "f2")


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cuts = panel.purged_rows(panels.weekly_bars(spark, sf_dir), 5, "35 DAYS")
    return rows.join(cuts, rows["ts"] <= cuts["cutoff"]).groupBy("test_fold").agg(fn.count("*").alias("n_train"), fn.countDistinct("symbol").alias("n_symbols"), fn.max("ts").alias("last_train"))


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = features(spark, sf_dir).select("symbol", "ts", panel.sequences(["f1"], 5).alias("q")).filter("q IS NOT NULL")
    return made.select("symbol", "ts", *(fn.get(fn.get("q", fn.lit(4 - k)), fn.lit(0)).alias(f"x{k}") for k in range(5)))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir)
    return rows.select("symbol", "ts", fn.coalesce("f1", fn.lit(evaluation.exact_quantile(rows, fn.col("f1"), 0.5))).alias("f1"))


def _outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir).filter("y IS NOT NULL")
    a = rows.agg(fn.avg("y").alias("m"), fn.stddev_pop("y").alias("s")).first()
    q1, q3 = evaluation.exact_quantiles(rows, ["y"], [0.25, 0.75]).values()
    sigma, fence = fn.abs(fn.col("y") - a["m"]) <= 5 * a["s"], fn.col("y").between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return rows.select("symbol", "ts", "y", sigma.cast("int").alias("keep_sigma"), fence.cast("int").alias("keep_iqr"))



X = "symbol, CAST(ts AS STRING) AS ts"
sql_op("csx_1", f"SELECT {X}, {R('CASE WHEN n >= 10 THEN (f1 - m) / CASE WHEN s = 0 THEN 1 ELSE s END ELSE f1 END')} AS z FROM (SELECT symbol, ts, f1, count(f1) OVER (PARTITION BY ts) AS n, avg(f1) OVER (PARTITION BY ts) AS m, stddev_pop(f1) OVER (PARTITION BY ts) AS s FROM {{feats}}) q", F, by=lambda s, d: features(s, d).select("symbol", "ts", panel.zscore("f1").alias("z")))
sql_op("csx_2", f"SELECT {X}, {R('(rk + (tied - 1) / 2.0) / n')} AS rank_norm FROM (SELECT symbol, ts, rank() OVER (PARTITION BY ts ORDER BY f1) AS rk, count(*) OVER (PARTITION BY ts, f1) AS tied, count(*) OVER (PARTITION BY ts) AS n FROM {{feats}} WHERE f1 IS NOT NULL) q", F, by=lambda s, d: features(s, d).filter("f1 IS NOT NULL").select("symbol", "ts", panel.rank_normalised("f1").alias("rank_norm")))
_Q = "SELECT ts AS k, percentile(f1, 0.05) AS lo, percentile(f1, 0.95) AS hi, avg(f1) AS m, stddev_samp(f1) AS s FROM {feats} GROUP BY ts"
sql_op("csx_3", f"SELECT symbol, CAST(f.ts AS STRING) AS ts, {R('coalesce((greatest(least(f1, hi), lo) - m) / (s + 1e-8), 0.0)')} AS x FROM {{feats}} f JOIN {{q}} q ON f.ts = q.k", {**F, "q": _Q})
sql_op("csx_4", f"SELECT symbol, CAST(f.ts AS STRING) AS ts, {R('coalesce((greatest(least(f1, m + 2.33 * s), m - 2.33 * s) - m) / (s + 1e-8), 0.0)')} AS x FROM {{feats}} f JOIN {{q}} q ON f.ts = q.k", {**F, "q": _Q})
sql_op("csx_5", f"SELECT symbol, CAST(f.ts AS STRING) AS ts, {R('coalesce((greatest(least(f1, m + 2.33 * s), m - 2.33 * s) - m) / (s + 1e-8), 0.0)')} AS x FROM {{feats}} f JOIN {{q}} q ON f.ts = q.k WHERE f.ts = (SELECT max(k) FROM {{q}})", {**F, "q": _Q})
_MD5 = "md5(concat(CAST(ts AS STRING), symbol))"
sql_op("csx_6", f"SELECT {X}, {R('y')} AS y, {R('f1')} AS f1, {R('f2')} AS f2 FROM (SELECT *, count(*) OVER (PARTITION BY ts) AS n, row_number() OVER (PARTITION BY ts ORDER BY {_MD5}) AS pick FROM {{feats}} WHERE y IS NOT NULL AND f1 IS NOT NULL AND f2 IS NOT NULL) q WHERE n >= 10 AND pick <= 20", F, by=_capped)
_T = "SELECT ts AS k, count(*) AS n FROM {bars_w} GROUP BY ts"
_TR = "SELECT k, n, row_number() OVER (ORDER BY k) AS r, count(*) OVER () AS nt, sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before, sum(n) OVER () AS total FROM {t}"
T = {"t": _T, "tr": _TR}
sql_op("csx_7", "SELECT symbol, CAST(b.ts AS STRING) AS ts, CASE WHEN r <= CAST(floor(0.8 * nt) AS INT) THEN 'train' ELSE 'test' END AS split FROM {bars_w} b JOIN {tr} t ON b.ts = t.k", T)
_ROWS = "SELECT b.symbol, b.ts, CAST(floor((before + row_number() OVER (PARTITION BY b.ts ORDER BY b.symbol) - 1) * 5 / total) AS INT) AS fold FROM {bars_w} b JOIN {tr} t ON b.ts = t.k"
_CUT = "SELECT fold AS test_fold, min(ts) - INTERVAL '35' DAY AS cutoff FROM {folds} GROUP BY fold"
sql_op("csx_8", "SELECT test_fold, count(*) AS n_train, count(DISTINCT symbol) AS n_symbols, CAST(max(ts) AS STRING) AS last_train FROM {folds} f JOIN {cuts} c ON f.ts <= c.cutoff GROUP BY test_fold", {**T, "folds": _ROWS, "cuts": _CUT}, by=_folds)
sql_op("csx_9", "SELECT test_fold, count(*) AS n_train FROM (SELECT r, n, r % 5 AS g FROM {tr}) a JOIN (SELECT DISTINCT r % 5 AS test_fold FROM {tr}) f ON a.g <> f.test_fold JOIN (SELECT r AS last_r, r % 5 AS g2 FROM {tr}) z ON z.g2 = f.test_fold WHERE a.r < z.last_r - 17 AND z.last_r > 340 GROUP BY test_fold", T)
sql_op("csx_10", f"SELECT symbol, count(*) AS n, count(*) FILTER (WHERE substr({_MD5}, 1, 1) < 'c') AS n_train FROM {{bars_w}} GROUP BY symbol")
sql_op("csx_11", f"SELECT {X}, {R('coalesce(f1, med)')} AS f1 FROM {{feats}} CROSS JOIN (SELECT percentile(f1, 0.5) AS med FROM {{feats}}) m", F, by=_filled)
sql_op("csx_12", f"SELECT {X}, {R('y')} AS y, CASE WHEN abs(y - m) <= 5 * s THEN 1 ELSE 0 END AS keep_sigma, CASE WHEN y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS keep_iqr FROM {{feats}} CROSS JOIN (SELECT avg(y) AS m, stddev_pop(y) AS s, percentile(y, 0.25) AS q1, percentile(y, 0.75) AS q3 FROM {{feats}}) a WHERE y IS NOT NULL", F, by=_outliers)
sql_op("csx_13", f"SELECT {X}, {R('greatest(least(coalesce(f1, 0.0), 1e6), -1e6)')} AS f1, CASE WHEN f1 IS NULL OR y IS NULL THEN 0 ELSE 1 END AS complete FROM {{feats}}", F)
sql_op("csx_14", f"SELECT {X} FROM (SELECT symbol, ts, row_number() OVER (ORDER BY {_MD5}) AS rn FROM {{bars_w}}) q WHERE rn <= 1000", by=lambda s, d: panels.weekly_bars(s, d).select("symbol", "ts").orderBy(fn.expr(_MD5)).limit(1000))
sql_op("csx_15", f"SELECT {X}, {R('f1')} AS x, {R('lag1')} AS x_lag1, {R('f1 - lag1')} AS d_x FROM (SELECT symbol, ts, f1, lag(f1) OVER ({KEY}) AS lag1 FROM {{feats}}) q", F)
sql_op("csx_16", f"SELECT symbol, segment, count(*) AS n, CAST(min(ts) AS STRING) AS first_ts FROM (SELECT symbol, ts, sum(CASE WHEN k <> before OR before IS NULL THEN 1 ELSE 0 END) OVER ({KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment FROM (SELECT symbol, ts, sign_up AS k, lag(sign_up) OVER ({KEY}) AS before FROM (SELECT symbol, ts, CASE WHEN f2 > 0 THEN 1 ELSE 0 END AS sign_up FROM {{feats}}) a) b) c GROUP BY symbol, segment", F)
sql_op("csx_17", f"SELECT {X}, {', '.join(f'{R(f'x{k}')} AS x{k}' for k in range(5))} FROM (SELECT symbol, ts, {', '.join(f'lag(f1, {k}) OVER ({KEY}) AS x{k}' for k in range(5))} FROM {{feats}}) q WHERE {' AND '.join(f'x{k} IS NOT NULL' for k in range(5))}", F, by=_sequences)
sql_op("csx_18", f"SELECT {X}, {R('CASE WHEN p > 0.8 THEN 0.0 WHEN p > 0.6 THEN 0.5 * f2 ELSE f2 END')} AS gated, CASE WHEN p > 0.6 THEN 1 ELSE 0 END AS was_gated FROM (SELECT symbol, ts, f2, percent_rank() OVER (PARTITION BY ts ORDER BY f4) AS p FROM {{feats}}) q", F)

sql_op("srt_1", f"SELECT symbol, {TS}, row_number() OVER ({KEY}) AS place FROM {{bars_w}}")
sql_op("srt_2", f"SELECT {X} FROM (SELECT symbol, ts, row_number() OVER (PARTITION BY ts ORDER BY {_MD5}) AS rn FROM {{bars_w}}) q WHERE rn <= 10")
sql_op("srt_3", f"SELECT {X}, {R('close')} AS close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM {{bars_w}}) q WHERE rn <= 10")
# Importance of a feature: its absolute correlation with the label, overall and by symbol.
_IMP = "SELECT symbol, feature, coalesce(abs(corr(x, y)), 0.0) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY symbol, feature"
_TOT = "SELECT feature, avg(importance) AS importance FROM {imp} GROUP BY feature"
I = {**L, "imp": _IMP, "tot": _TOT}  # noqa: E741
_RANK = "row_number() OVER (ORDER BY round(importance, 9) DESC, feature)"
sql_op("srt_4", f"SELECT feature, {R('importance')} AS importance, {_RANK} AS rank, {R('sum(importance) OVER (ORDER BY round(importance, 9) DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(importance) OVER ()')} AS cumulative FROM {{tot}}", I)
sql_op("srt_5", f"SELECT feature FROM (SELECT feature, {_RANK} AS rn, sum(importance) OVER (ORDER BY round(importance, 9) DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(importance) OVER () AS share FROM {{tot}}) q WHERE share <= 0.8 OR rn <= 2", I)
sql_op("srt_6", "SELECT symbol, feature, round(importance, 6) AS importance FROM {imp} i WHERE feature IN (SELECT feature FROM (SELECT 'f1' AS feature UNION ALL SELECT 'f3') k)", I)
sql_op("srt_7", f"SELECT symbol, {TS}, {R('close')} AS close FROM (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol, date_trunc('month', ts) ORDER BY ts) AS rn FROM {{bars_w}}) q WHERE rn = 1")
sql_op("set_1", f"SELECT symbol, {TS}, {R('close')} AS close FROM {{bars_w}} UNION ALL SELECT symbol, {TS}, {R('close')} AS close FROM {{bars_h}}")
sql_op("set_2", f"SELECT symbol, {TS}, {R('close')} AS close, CAST(NULL AS DOUBLE) AS f1 FROM {{bars_h}} UNION ALL SELECT symbol, {TS}, CAST(NULL AS DOUBLE), {R('f1')} FROM {{feats}}", F)
sql_op("set_3", "SELECT symbol, 'both' AS side FROM (SELECT symbol FROM {bars_w} WHERE volume > 400 INTERSECT SELECT symbol FROM {bars_w} WHERE volume < 20) q UNION ALL SELECT symbol, 'only_low' FROM (SELECT symbol FROM {bars_w} WHERE volume < 20 EXCEPT SELECT symbol FROM {bars_w} WHERE volume > 400) z")
_TOP = "SELECT symbol, feature FROM (SELECT symbol, feature, row_number() OVER (PARTITION BY symbol ORDER BY round(importance, 9) DESC, feature) AS rn FROM {imp}) q WHERE rn <= 2"
sql_op("set_4", f"SELECT a, b, {R('1.0 * shared / (4 - shared)')} AS jaccard FROM (SELECT l.symbol AS a, r.symbol AS b, count(*) AS shared FROM {{top}} l JOIN {{top}} r ON l.feature = r.feature AND l.symbol < r.symbol GROUP BY 1, 2) q", {**I, "top": _TOP})
sql_op("set_5", "SELECT symbol, row_number() OVER (ORDER BY first_ts, symbol) AS place FROM (SELECT symbol, min(ts) AS first_ts FROM {bars_w} GROUP BY symbol) q")
