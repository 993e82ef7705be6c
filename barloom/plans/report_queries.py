"""Sequences, selection, target views, probes, trends, run differences, consensus and audits over the weekly panel; most SQL is written apart from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.operators import consensus, evaluation, moments, probes, run_diff, sequences, stages, target_views, trends
from barloom.plans.bar_queries import F, L
from barloom.plans.panel_queries import features
from barloom.plans.quality_queries import NAMES, P
from barloom.plans.registry import register, rounded, sql_op
from barloom.sources import panels

KEY = "PARTITION BY symbol ORDER BY ts"
LENGTH = 4


# Windows as samples: flattened for the comparison, x<step>_<feature>.
def _flat(samples: DataFrame) -> DataFrame:
    value = lambda k, j: fn.get(fn.get("x", fn.lit(k)), fn.lit(j))
    return samples.select("symbol", "ts", "y", *(value(k, j).alias(f"x{k}_{f}") for k in range(LENGTH) for j, f in enumerate(("f1", "f3"))))


def _windows_sql(stride: int, before: int) -> str:
    """Lags over numbered clean rows."""
    clean = f"SELECT symbol, ts, y, f1, f3, row_number() OVER ({KEY}) AS place FROM {{feats}} WHERE f1 IS NOT NULL AND f3 IS NOT NULL"
    cells = ", ".join(f"lag({f}, {LENGTH - 1 - k + before}) OVER ({KEY}) AS x{k}_{f}" for k in range(LENGTH) for f in ("f1", "f3"))
    shown = ", ".join(f"round(x{k}_{f} + 3e-8, 6) AS x{k}_{f}" for k in range(LENGTH) for f in ("f1", "f3"))
    return f"SELECT symbol, CAST(ts AS STRING) AS ts, round(y + 3e-8, 6) AS y, {shown} FROM (SELECT symbol, ts, y, place, {cells} FROM ({clean}) c) q WHERE y IS NOT NULL AND place >= {LENGTH + before} AND (place - {LENGTH + before}) % {stride} = 0"


def _samples(spark: SparkSession, sf_dir: str, stride: int, before: bool) -> DataFrame:
    return sequences.windows(features(spark, sf_dir), ["f1", "f3"], "y", LENGTH, stride, before)


sql_op("csx_17_windows", _windows_sql(1, 0), F, by=lambda s, d: _flat(_samples(s, d, 1, False)))
sql_op("csx_17_ahead", _windows_sql(3, 1), F, by=lambda s, d: _flat(_samples(s, d, 3, True)))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks over samples in which every sample of the symbols 1 and 2 is broken: a step less, a null."""
    made = _samples(spark, sf_dir, 1, False)
    short = fn.when(fn.col("symbol") == "1", fn.slice("x", 2, LENGTH)).when(fn.col("symbol") == "2", fn.transform("x", lambda r: fn.array(fn.lit(None).cast("double"), fn.get(r, fn.lit(1))))).otherwise(fn.col("x"))
    return sequences.checks(made.withColumn("x", short), LENGTH, 2)


_N = f"SELECT symbol FROM ({_windows_sql(1, 0)}) w"
sql_op("csx_17_checks", f"SELECT c.name AS \"check\", (SELECT count(*) FROM ({_N}) n WHERE n.symbol = c.symbol) AS broken, (SELECT count(*) FROM ({_N}) n) AS n FROM (SELECT 'length' AS name, '1' AS symbol UNION ALL SELECT 'width', NULL UNION ALL SELECT 'missing', '2' UNION ALL SELECT 'infinite', NULL UNION ALL SELECT 'label', NULL UNION ALL SELECT 'repeated', NULL) c", F, by=_checked)


# Correlations of many columns, and what the greedy pass keeps.
_CORR = " UNION ALL ".join(f"SELECT '{a}' AS fa, '{b}' AS fb, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}) + 3e-8, 6) AS corr FROM {{feats}}" for i, a in enumerate([*NAMES, "y"]) for b in [*NAMES, "y"][i + 1 :])
sql_op("qa_5_matrix", _CORR, F, by=lambda s, d: moments.correlations(features(s, d), [*NAMES, "y"]))
register("qa_5_selected", lambda s, d: rounded(moments.selected(features(s, d), [*NAMES, "close", "volume"], "y", 0.3)))

# A target seen from every side, and with the signal taken out.
register("ev_7_symbols", lambda s, d: rounded(target_views.symbol_views(features(s, d), NAMES, "y")))
register("qa_12_probes", lambda s, d: rounded(probes.leak_probes(features(s, d), NAMES, "y", ["open", "high", "low", "close", "volume"])))


# Runs of each symbol, one a month.
def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = features(spark, sf_dir).filter("y IS NOT NULL AND f2 IS NOT NULL")
    rate = lambda c: fn.avg(fn.when(c, 1.0).otherwise(0.0))
    return held.groupBy("symbol", fn.date_trunc("month", "ts").alias("ts")).agg(rate(fn.col("f2") * fn.col("y") < 0).alias("auc"), rate(fn.col("y") > 0).alias("pos_rate"), fn.count("*").alias("n"), fn.count("f3").alias("n_selected"))


NOW = "TIMESTAMP '1999-01-01 00:00:00'"
_D = "unix_timestamp(CAST(ts AS TIMESTAMP)) / 86400.0"
_NUM = f"SELECT symbol, ts, auc, {_D} AS d, row_number() OVER ({KEY}) AS i, count(*) OVER (PARTITION BY symbol) AS m FROM {{runs}}"
_LINE = f"SELECT a.symbol, a.i, a.m, a.auc, a.d - f.d0 AS x, power(0.5, (unix_timestamp({NOW}) / 86400.0 - a.d) / 180.0) AS w, f.d0 FROM {{num}} a JOIN (SELECT symbol AS s0, min(d) AS d0 FROM {{num}} GROUP BY symbol) f ON a.symbol = f.s0"
_MID = "SELECT symbol AS s1, sum(w * x) / sum(w) AS mx, sum(w * auc) / sum(w) AS my, sum(w) AS sw FROM {line} GROUP BY symbol"
_SLOPE = "SELECT symbol AS s2, sum(w * (x - mx) * (auc - my)) / sum(w * (x - mx) * (x - mx)) AS slope FROM {line} JOIN {mid} ON symbol = s1 GROUP BY symbol"
T = {**P, "num": _NUM, "line": _LINE, "mid": _MID, "slopes": _SLOPE}
_ALPHA = 1 - 0.5 ** (1 / 180)
sql_op("trd_1_series", f"SELECT symbol, count(*) AS n_runs, round(1000 * max(slope) + 3e-8, 6) AS slope, round(max(my - slope * mx) + 3e-8, 6) AS intercept, round(sqrt(sum(w * (auc - my - slope * (x - mx)) * (auc - my - slope * (x - mx))) / max(sw) + 1e-12) + 3e-8, 6) AS residual_sd, round(sum(CASE WHEN i = 1 THEN 1.0 ELSE {_ALPHA} END * power({1 - _ALPHA}, m - i) * auc) + 3e-8, 6) AS ewma FROM {{line}} JOIN {{mid}} ON symbol = s1 JOIN {{slopes}} ON symbol = s2 GROUP BY symbol", T,
       by=lambda s, d: trends.trends(_runs(s, d), ["symbol"], "auc", 180.0, fn.expr(NOW)).select("symbol", "n_runs", (1000 * fn.col("slope")).alias("slope"), "intercept", "residual_sd", "ewma"))
_CUTS = "SELECT a.symbol, a.i AS nth, count(*) FILTER (WHERE b.i < a.i) AS left_n, count(*) FILTER (WHERE b.i >= a.i) AS right_n, avg(b.auc) FILTER (WHERE b.i < a.i) AS left_m, avg(b.auc) FILTER (WHERE b.i >= a.i) AS right_m, coalesce(var_pop(b.auc) FILTER (WHERE b.i < a.i) * count(*) FILTER (WHERE b.i < a.i), 0.0) + var_pop(b.auc) FILTER (WHERE b.i >= a.i) * count(*) FILTER (WHERE b.i >= a.i) AS rest, var_pop(b.auc) * count(*) AS whole FROM {num} a JOIN {num} b ON a.symbol = b.symbol GROUP BY a.symbol, a.i"
_BEST = "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round((whole - rest) / greatest(rest / (left_n + right_n - 2), 1e-12), 9) DESC, nth) AS pick FROM {cuts} WHERE left_n >= 3 AND right_n >= 3"
sql_op("trd_1_breaks", "SELECT symbol, 1 AS round, CAST(nth AS INT) AS nth, round(left_m + 3e-8, 6) AS before, round(right_m + 3e-8, 6) AS after FROM {best} WHERE pick = 1 AND (whole - rest) / greatest(rest / (left_n + right_n - 2), 1e-12) >= 2.0", {**P, "num": _NUM, "cuts": _CUTS, "best": _BEST},
       by=lambda s, d: trends.breaks(_runs(s, d), ["symbol"], "auc", least_gain=2.0, rounds=1).select("symbol", "round", "nth", "before", "after"))


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with settings that change over time: a window by size, a season only in its months."""
    size, month = fn.when(fn.col("n") >= 5, "wide").otherwise("narrow"), fn.month("ts")
    settings = fn.map_filter(fn.create_map(fn.lit("window"), size, fn.lit("season"), fn.when(month <= 3, "winter").when(month.between(6, 8), "summer"), fn.lit("universe"), fn.lit("all")), lambda _, v: v.isNotNull())
    run_id = fn.concat("symbol", fn.lit("/"), fn.date_format("ts", "yyyy-MM"))
    return _runs(spark, sf_dir).select(fn.col("symbol").alias("series"), run_id.alias("run_id"), "ts", size.alias("signature"), settings.alias("settings"), fn.create_map(fn.lit("auc"), "auc", fn.lit("pos_rate"), "pos_rate").alias("metrics"))


def _differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_diff.run_diff(_settings(spark, sf_dir), "auc", ["universe"])
    return found.select("run_id", "previous_id", "comparable_id", "best_id", fn.array_join("changed", ",").alias("changed"), fn.coalesce(fn.size("deltas"), fn.lit(0)).alias("n_deltas"), "comparability", "severity")


_SET = "SELECT symbol, concat(symbol, '/', substr(CAST(ts AS STRING), 1, 7)) AS run_id, ts, CASE WHEN n >= 5 THEN 'wide' ELSE 'narrow' END AS win, CASE WHEN month(ts) <= 3 THEN 'winter' WHEN month(ts) BETWEEN 6 AND 8 THEN 'summer' END AS season, auc, pos_rate FROM {runs}"
_SEEN = f"SELECT *, lag(run_id) OVER ({KEY}) AS previous_id, lag(win) OVER ({KEY}) AS pw, lag(season) OVER ({KEY}) AS ps, lag(run_id) OVER (PARTITION BY symbol, win ORDER BY ts) AS comparable_id, lag(auc) OVER (PARTITION BY symbol, win ORDER BY ts) AS pa, lag(pos_rate) OVER (PARTITION BY symbol, win ORDER BY ts) AS pp, max(auc) OVER (PARTITION BY symbol, win ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top FROM {{sets}}"
_TOLD = "SELECT *, CASE WHEN previous_id IS NULL THEN '' WHEN coalesce(ps, '') <> coalesce(season, '') AND pw <> win THEN 'season,window' WHEN coalesce(ps, '') <> coalesce(season, '') THEN 'season' WHEN pw <> win THEN 'window' ELSE '' END AS changed, CASE WHEN comparable_id IS NOT NULL AND abs(auc - pa) > 1e-4 AND abs(auc - pa) > 1e-4 * abs(pa) THEN 1 ELSE 0 END AS da, CASE WHEN comparable_id IS NOT NULL AND abs(pos_rate - pp) > 1e-4 AND abs(pos_rate - pp) > 1e-4 * abs(pp) THEN 1 ELSE 0 END AS dp FROM {seen}"
sql_op("drf_2_changes", "SELECT run_id, previous_id, comparable_id, (SELECT min(b.run_id) FROM {told} b WHERE b.symbol = a.symbol AND b.win = a.win AND b.ts <= a.ts AND b.auc = a.top) AS best_id, changed, da + dp AS n_deltas, CASE WHEN previous_id IS NULL THEN 'first' WHEN comparable_id IS NULL THEN 'none' WHEN comparable_id = previous_id THEN 'comparable' ELSE 'earlier' END AS comparability, CASE WHEN da = 1 AND (auc - pa) / nullif(abs(pa), 0) < -0.05 THEN 'major' WHEN changed <> '' OR da + dp > 0 THEN 'minor' ELSE 'none' END AS severity FROM {told} a", {**P, "sets": _SET, "seen": _SEEN, "told": _TOLD}, by=_differences)


# Three families of importances over symbols, one of them weighed double, and a gate.
_FAM = "SELECT 'corr' AS family, symbol, feature, coalesce(abs(corr(x, y)), 0.0) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY symbol, feature UNION ALL SELECT 'sign', symbol, feature, abs(avg(CASE WHEN x * y > 0 THEN 1.0 ELSE 0.0 END) - 0.5) FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL AND feature <> 'f4' GROUP BY symbol, feature UNION ALL SELECT 'tail', symbol, feature, avg(CASE WHEN abs(y) > 0.5 THEN abs(x) ELSE 0.0 END) FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL AND symbol < '2' GROUP BY symbol, feature"
_GATE = "SELECT feature, CASE WHEN avg(importance) > 0.3 THEN 1.0 WHEN avg(importance) > 0.1 THEN 0.3 ELSE 0.0 END AS score FROM {fam} WHERE family = 'corr' GROUP BY feature"
_GRID = "SELECT a.family, s.symbol, f.feature, coalesce(i.importance, 0.0) AS importance FROM (SELECT DISTINCT family FROM {fam}) a JOIN (SELECT DISTINCT family, symbol FROM {fam}) s ON a.family = s.family CROSS JOIN (SELECT DISTINCT feature FROM {fam}) f LEFT JOIN {fam} i ON i.family = a.family AND i.symbol = s.symbol AND i.feature = f.feature"
_BY = "SELECT family, feature, avg(importance) * CASE WHEN family = 'corr' THEN 2.0 ELSE 1.0 END AS score FROM {grid} GROUP BY family, feature"
_ALL = "SELECT s.feature, avg(s.score) AS base, stddev_samp(s.score) AS spread, count(*) FILTER (WHERE s.score > 0) AS agree, max(CASE WHEN g.score >= 1 THEN 0.2 WHEN g.score <= 0 THEN -0.3 ELSE 0.0 END) AS gate_effect FROM {by_family} s LEFT JOIN {gate} g ON s.feature = g.feature GROUP BY s.feature"
C = {**L, "fam": _FAM}


def _consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features(spark, sf_dir).unpivot(["symbol", "ts", "y"], NAMES, "feature", "x").filter("x IS NOT NULL AND y IS NOT NULL")
    by = lambda df, name, e: df.groupBy("symbol", "feature").agg(e.alias("importance")).select(fn.lit(name).alias("family"), "symbol", "feature", "importance")
    corr = by(long, "corr", fn.coalesce(fn.abs(fn.corr("x", "y")), fn.lit(0.0)))
    given = corr.union(by(long.filter("feature <> 'f4'"), "sign", fn.abs(fn.avg(fn.when(fn.col("x") * fn.col("y") > 0, 1.0).otherwise(0.0)) - 0.5))).union(by(long.filter("symbol < '2'"), "tail", fn.avg(fn.when(fn.abs("y") > 0.5, fn.abs("x")).otherwise(0.0))))
    gate = corr.groupBy("feature").agg(fn.avg("importance").alias("m")).select("feature", fn.when(fn.col("m") > 0.3, 1.0).when(fn.col("m") > 0.1, 0.3).otherwise(0.0).alias("score"))
    return consensus.consensus(given, {"corr": 2.0}, gate).select("feature", "base", "spread", "agree", "gate_effect", "final", "place")


sql_op("ag_18_consensus", "SELECT feature, round(base + 3e-8, 6) AS base, round(spread + 3e-8, 6) AS spread, agree, round(gate_effect + 3e-8, 6) AS gate_effect, round(base + gate_effect + 3e-8, 6) AS final, row_number() OVER (ORDER BY round(base + gate_effect, 12) DESC, feature) AS place FROM {merged}", {**C, "gate": _GATE, "grid": _GRID, "by_family": _BY, "merged": _ALL}, by=_consensus)


# Outliers: the fence over all features, and the rule on the label.
_QS = "SELECT " + ", ".join(f"percentile({c}, 0.25) AS {c}_l, percentile({c}, 0.75) AS {c}_h" for c in NAMES) + " FROM {feats}"
_INSIDE = " AND ".join(f"coalesce({c} BETWEEN {c}_l - 1.5 * ({c}_h - {c}_l) AND {c}_h + 1.5 * ({c}_h - {c}_l), TRUE)" for c in NAMES)
sql_op("csx_12_fences", f"SELECT symbol, CAST(ts AS STRING) AS ts, CASE WHEN {_INSIDE} THEN 1 ELSE 0 END AS inside FROM {{feats}} CROSS JOIN {{qs}}", {**F, "qs": _QS}, by=lambda s, d: evaluation.fences(features(s, d), NAMES).select("symbol", "ts", fn.col("inside").cast("int").alias("inside")))
sql_op("csx_12_extremes", "SELECT symbol, count(*) AS n FROM {feats} CROSS JOIN (SELECT avg(y) AS m, stddev_pop(y) AS s FROM {feats}) a WHERE y IS NULL OR abs(y - m) <= 2 * s GROUP BY symbol", F, by=lambda s, d: evaluation.without_extremes(features(s, d), "y", 2.0).groupBy("symbol").agg(fn.count("*").alias("n")))


# A feature's way through the stages, by symbol.
def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features(spark, sf_dir).unpivot(["symbol", "ts", "y"], NAMES, "feature", "x").withColumnRenamed("symbol", "view")
    stats = long.groupBy("view", "feature").agg(fn.count("x").alias("n"), fn.corr("x", "y").alias("c"), fn.avg(fn.col("x").isNull().cast("int")).alias("missing"))
    asked = stats.select("view", "feature").union(stats.filter("feature = 'f1'").select("view", fn.lit("f9").alias("feature")))
    there = stats.filter("n > 0")
    kept = there.filter("missing < 0.02")
    facts = stages.stage_facts({"requested": asked, "allowed": stats.filter("feature <> 'f4'"), "present": there.filter("feature <> 'f4'"), "kept": kept.filter("feature <> 'f4'"), "used": kept.filter("feature <> 'f4' AND abs(c) > 0.4")})
    return stages.audit(facts).select("view", "feature", "last_stage", "lost_at", "reason")


_ST = "SELECT symbol AS view, feature, count(x) AS n, corr(x, y) AS c, avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) AS missing FROM {long} GROUP BY symbol, feature"
sql_op("qa_13_stages", "SELECT view, feature, CASE WHEN feature = 'f4' THEN 'requested' WHEN n = 0 THEN 'allowed' WHEN missing >= 0.02 THEN 'present' WHEN coalesce(abs(c), 0.0) > 0.4 THEN 'used' ELSE 'kept' END AS last_stage, CASE WHEN feature = 'f4' THEN 'allowed' WHEN n = 0 THEN 'present' WHEN missing >= 0.02 THEN 'kept' WHEN coalesce(abs(c), 0.0) > 0.4 THEN NULL ELSE 'used' END AS lost_at, CASE WHEN feature = 'f4' THEN 'not_in_registry' WHEN n = 0 THEN 'not_in_data' WHEN missing >= 0.02 THEN 'dropped_by_quality' WHEN coalesce(abs(c), 0.0) > 0.4 THEN 'ok' ELSE 'not_selected' END AS reason FROM {stats} UNION ALL SELECT view, 'f9', 'requested', 'allowed', 'not_in_registry' FROM {stats} WHERE feature = 'f1'", {**L, "stats": _ST}, by=_audit)
