"""Data quality, leakage, evaluation, stability, drift, trend and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.operators import evaluation
from barloom.plans.bar_queries import KEY, F, L, R
from barloom.plans.panel_queries import I, features
from barloom.plans.registry import sql_op
from barloom.sources import panels

NAMES = ["f1", "f2", "f3", "f4"]


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).unpivot(["symbol", "ts", "y"], NAMES, "feature", "x")


def _redundant(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.correlations(features(spark, sf_dir), NAMES)
    return found.select("fa", "fb", "corr", (fn.abs("corr") > 0.95).cast("int").alias("redundant"))


def _recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label by leads, one too late after weeks of a number of trades that seven divides, against the label by arrays."""
    bars = panels.weekly_bars(spark, sf_dir)
    at = lambda k: fn.expr(f"lead(close, {k}) OVER ({KEY})") >= fn.col("close") * 1.05
    leads = bars.select("symbol", "ts", (fn.when(at(1), 1).when(at(2), 2).when(at(3), 3) + fn.when(fn.col("n_trades") % 7 == 0, 1).otherwise(0)).alias("tth"))
    return evaluation.mismatches(leads, evaluation.time_to_hit_by_array(bars, 0.05, 3), ["symbol", "ts"], "tth", "hit")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).filter("y IS NOT NULL AND f1 IS NOT NULL").select("symbol", "ts", "y", (-fn.col("f1")).alias("p"))


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantised = fn.round(fn.col("p") * 1000).cast("bigint")
    return _predictions(spark, sf_dir).groupBy("symbol").agg(fn.count("*").alias("n"), evaluation.fingerprint(fn.col("ts"), quantised).alias("fingerprint"))


def _cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = panels.weekly_bars(spark, sf_dir)
    each = bars.groupBy("symbol").agg(fn.count("*").alias("n"))
    spread = each.agg(fn.min("n").alias("least_rows"), fn.max("n").alias("most_rows"), fn.avg("n").alias("mean_rows"))
    whole = bars.agg(fn.count("*").alias("n_rows"), fn.countDistinct("symbol").alias("n_symbols"), fn.min("ts").cast("string").alias("first_ts"), fn.max("ts").cast("string").alias("last_ts"), evaluation.fingerprint(fn.col("symbol"), fn.col("ts")).alias("fingerprint"))
    return whole.crossJoin(spread)  # one row each



X = "symbol, CAST(ts AS STRING) AS ts"
# Bar intervals in minutes, and rules about them.
_GAPS = f"SELECT symbol, ts, (unix_timestamp(CAST(ts AS TIMESTAMP)) - unix_timestamp(CAST(lag(ts) OVER ({KEY}) AS TIMESTAMP))) / 60.0 AS gap FROM {{bars_h}}"
G = {"gaps": _GAPS}
sql_op("qa_1", f"SELECT g.symbol, {R('percentile(gap, 0.5)')} AS median_gap, CASE WHEN abs(percentile(gap, 0.5) - 60) <= 12 THEN 60 WHEN abs(percentile(gap, 0.5) - 30) <= 6 THEN 30 ELSE NULL END AS snapped FROM {{gaps}} g JOIN (SELECT symbol AS k, percentile(gap, 0.5) AS med FROM {{gaps}} WHERE gap > 0 AND gap <= 1440 GROUP BY symbol) m ON g.symbol = m.k WHERE gap > 0 AND gap <= 10 * med GROUP BY g.symbol", G)
sql_op("qa_2", "SELECT symbol, CASE WHEN percentile(gap * 60, 0.5) BETWEEN 30 AND 100000 THEN 's' WHEN percentile(gap * 60, 0.5) > 100000 THEN 'ms' ELSE 'unknown' END AS unit FROM {gaps} GROUP BY symbol", G)
sql_op("qa_3", f"SELECT {X}, {R('gap')} AS gap FROM {{gaps}} WHERE gap IS NOT NULL AND abs(gap - 60) > 0.1 AND gap < 1440", G)
sql_op("qa_4", f"SELECT feature, {R('corr(x, y)')} AS corr, {R('avg(CASE WHEN abs(x - y) < 1e-9 THEN 1.0 ELSE 0.0 END)')} AS match, CASE WHEN abs(corr(x, y)) >= 0.99 THEN 1 ELSE 0 END AS near_copy FROM {{long}} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature", L)
_PAIRS = "SELECT a.feature AS fa, b.feature AS fb, corr(a.x, b.x) AS c FROM {long} a JOIN {long} b ON a.symbol = b.symbol AND a.ts = b.ts AND a.feature < b.feature WHERE a.x IS NOT NULL AND b.x IS NOT NULL GROUP BY a.feature, b.feature"
sql_op("qa_5", f"SELECT fa, fb, {R('c')} AS corr, CASE WHEN abs(c) > 0.95 THEN 1 ELSE 0 END AS redundant FROM {{pairs}}", {**L, "pairs": _PAIRS}, by=_redundant)
# A score of each symbol: how well a feature's sign tells the label's.
_SCORE = "SELECT symbol, avg(CASE WHEN (f2 > 0) = (y < 0) THEN 1.0 ELSE 0.0 END) AS auc, abs(corr(f2, y)) AS ic, count(*) AS n, stddev_samp(y) AS sd FROM {feats} WHERE f2 IS NOT NULL AND y IS NOT NULL GROUP BY symbol"
S = {**F, "score": _SCORE}
sql_op("qa_6", f"SELECT symbol, {R('auc')} AS auc, CASE WHEN auc >= 0.95 THEN 'HIGH_SCORE' WHEN auc >= 0.8 AND ic < 0.2 THEN 'INCONSISTENT' WHEN auc >= 0.75 THEN 'SUSPICIOUS' ELSE 'OK' END AS status FROM {{score}}", S)
sql_op("qa_7", f"SELECT symbol, {R('0.5 * auc + 0.25 * ic + 0.25 * least(n / 400.0, 1.0)')} AS composite FROM {{score}}", S)
sql_op("qa_8", f"SELECT symbol, feature, {R('importance / nullif(total, 0)')} AS share, {R('importance / nullif(second, 0)')} AS over_second, CASE WHEN importance / nullif(total, 0) >= 0.5 OR importance / nullif(second, 0) > 3 THEN 1 ELSE 0 END AS suspect FROM (SELECT symbol, feature, importance, sum(importance) OVER (PARTITION BY symbol) AS total, lead(importance) OVER (PARTITION BY symbol ORDER BY importance DESC, feature) AS second, row_number() OVER (PARTITION BY symbol ORDER BY importance DESC, feature) AS rn FROM {{imp}}) q WHERE rn = 1", I)
_HALF = "SELECT CASE WHEN year(ts) < 1999 THEN 'early' ELSE 'late' END AS run, feature, coalesce(abs(corr(x, y)), 0.0) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, feature"
sql_op("qa_9", f"SELECT coalesce(a.feature, b.feature) AS feature, {R('a.importance')} AS full_imp, {R('b.importance')} AS safe_imp, {R('a.importance - b.importance')} AS diff, CASE WHEN abs(a.importance - b.importance) > 0.5 * greatest(a.importance, b.importance) THEN 1 ELSE 0 END AS flagged FROM (SELECT feature, importance FROM {{half}} WHERE run = 'early') a FULL OUTER JOIN (SELECT feature, importance FROM {{half}} WHERE run = 'late') b ON a.feature = b.feature", {**L, "half": _HALF})
_HIT = f"SELECT symbol, ts, close, CASE WHEN lead(close, 1) OVER ({KEY}) >= close * 1.05 THEN 1 WHEN lead(close, 2) OVER ({KEY}) >= close * 1.05 THEN 2 WHEN lead(close, 3) OVER ({KEY}) >= close * 1.05 THEN 3 END AS tth FROM {{bars_w}}"
sql_op("qa_10", f"SELECT tth, count(*) AS n, {R('count(*) / (1.0 * sum(count(*)) OVER ())')} AS share FROM {{hit}} WHERE tth IS NOT NULL GROUP BY tth", {"hit": _HIT})
sql_op("qa_11", "SELECT symbol, count(*) AS n, count(*) FILTER (WHERE n_trades % 7 = 0 AND tth IS NOT NULL) AS mismatches FROM {hit} GROUP BY symbol", {"hit": _HIT.replace("close, CASE", "close, n_trades, CASE")}, by=_recomputed)
_AUC = "(sum(CASE WHEN pos = 1 THEN rk + (tied - 1) / 2.0 ELSE 0.0 END) - sum(pos) * (sum(pos) + 1) / 2.0) / nullif(sum(pos) * (count(*) - sum(pos)), 0)"
_RK = "SELECT feature, CASE WHEN y > 0 THEN 1 ELSE 0 END AS pos, rank() OVER (PARTITION BY feature ORDER BY x) AS rk, count(*) OVER (PARTITION BY feature, x) AS tied FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL"
sql_op("qa_12", f"SELECT feature, {R(_AUC)} AS auc, count(*) AS n FROM {{rk}} GROUP BY feature", {**L, "rk": _RK}, by=lambda s, d: evaluation.auc(_long(s, d), "feature", "x", fn.col("y") > 0))
sql_op("qa_13", "SELECT feature, count(*) AS requested, count(x) AS present, count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) AS used, CASE WHEN count(x) = count(*) THEN 'kept' ELSE 'nulls' END AS reason FROM {long} GROUP BY feature", L)
sql_op("qa_14", f"SELECT symbol, count(*) AS n, {R('avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END)')} AS old_rate, {R('avg(CASE WHEN y > 0.01 THEN 1.0 ELSE 0.0 END)')} AS new_rate FROM {{feats}} WHERE y IS NOT NULL GROUP BY symbol", F)
sql_op("qa_15", f"SELECT symbol, {R('max(share)')} AS top_share, CASE WHEN max(share) >= 0.5 THEN 'dominant' WHEN max(share) >= 0.3 THEN 'high' ELSE 'ok' END AS flag FROM (SELECT symbol, importance / nullif(sum(importance) OVER (PARTITION BY symbol), 0) AS share FROM {{imp}}) q GROUP BY symbol", I)
sql_op("qa_16", f"SELECT feature, {R('avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END)')} AS nan_ratio, CASE WHEN count(DISTINCT x) <= 1 THEN 1 ELSE 0 END AS constant, CASE WHEN avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0.0 END) > 0.5 THEN 1 ELSE 0 END AS bad_target FROM {{long}} GROUP BY feature", L)
# One "run" a month and symbol.
_RUN = "SELECT symbol, date_trunc('month', ts) AS ts, avg(CASE WHEN f2 * y < 0 THEN 1.0 ELSE 0.0 END) AS auc, avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END) AS pos_rate, count(*) AS n, count(f3) AS n_selected FROM {feats} WHERE y IS NOT NULL AND f2 IS NOT NULL GROUP BY 1, 2"
_PREV = f"SELECT *, lag(auc) OVER ({KEY}) AS prev_auc, lag(n) OVER ({KEY}) AS prev_n, lag(pos_rate) OVER ({KEY}) AS prev_pos, row_number() OVER ({KEY}) AS place, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS back FROM {{runs}}"
P = {**F, "runs": _RUN, "prev": _PREV}
sql_op("qa_17", f"SELECT {X}, CASE WHEN auc > 0.95 THEN 'suspicious_score' WHEN n < prev_n / 2.0 THEN 'cohort_shrank' WHEN abs(auc - prev_auc) > 0.4 THEN 'score_jump' ELSE 'ok' END AS rule FROM {{prev}}", P)
# Evaluation of a prediction: the negative of the last return.
_PRED = "SELECT symbol, ts, y, -f1 AS p FROM {feats} WHERE y IS NOT NULL AND f1 IS NOT NULL"
_IC = "SELECT ts, count(*) AS n, corr(y, p) AS ic, corr(ry, rp) AS rank_ic, avg(CASE WHEN y * p > 0 THEN 1.0 ELSE 0.0 END) AS hit FROM (SELECT ts, y, p, rank() OVER (PARTITION BY ts ORDER BY y) AS ry, rank() OVER (PARTITION BY ts ORDER BY p) AS rp FROM {pred}) q GROUP BY ts HAVING count(*) > 2 AND stddev_samp(p) > 1e-12 AND stddev_samp(y) > 1e-12"
E = {**F, "pred": _PRED, "ic": _IC}
sql_op("ev_1", f"SELECT count(*) AS n_ts, {R('avg(ic)')} AS mean_ic, {R('avg(rank_ic)')} AS mean_rank_ic, {R('avg(ic) / nullif(stddev_samp(ic), 0)')} AS ic_ir, {R('sum(hit * n) / sum(n)')} AS hit_rate FROM {{ic}}", E)
sql_op("ev_2", f"SELECT symbol, {R('1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0)')} AS r2, {R('avg((y - p) * (y - p))')} AS mse, {R('avg(abs(y - p))')} AS mae, {R('corr(y, p)')} AS ic FROM {{pred}} GROUP BY symbol", E)
_BIN = "SELECT symbol AS feature, CASE WHEN y > 0 THEN 1 ELSE 0 END AS pos, 1 / (1 + exp(-greatest(least(p, 30.0), -30.0))) AS prob, rank() OVER (PARTITION BY symbol ORDER BY p) AS rk, count(*) OVER (PARTITION BY symbol, p) AS tied FROM {pred}"
sql_op("ev_3", f"SELECT feature AS symbol, {R(_AUC)} AS auc, {R('avg(-ln(CASE WHEN pos = 1 THEN greatest(prob, 1e-8) ELSE greatest(1 - prob, 1e-8) END))')} AS log_loss, {R('avg(CASE WHEN (prob >= 0.5) = (pos = 1) THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM {{bin}} GROUP BY feature", {**E, "bin": _BIN})
_CLS = "SELECT CASE WHEN y > 0.1 THEN 2 WHEN y < -0.1 THEN 0 ELSE 1 END AS c, CASE WHEN p > 0.1 THEN 2 WHEN p < -0.1 THEN 0 ELSE 1 END AS q FROM {pred}"
sql_op("ev_4", f"SELECT k, {R('2.0 * tp / nullif(np + nt, 0)')} AS f1, {R('acc')} AS accuracy FROM (SELECT k, count(*) FILTER (WHERE c = k AND q = k) AS tp, count(*) FILTER (WHERE q = k) AS np, count(*) FILTER (WHERE c = k) AS nt, avg(CASE WHEN c = q THEN 1.0 ELSE 0.0 END) AS acc FROM {{cls}} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) z GROUP BY k) w", {**E, "cls": _CLS})
sql_op("ev_5", "SELECT symbol, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(concat(CAST(ts AS VARCHAR), '|', CAST(CAST(round(p * 1000) AS BIGINT) AS VARCHAR))), 1, 8) AS BIGINT)) AS VARCHAR) AS fingerprint FROM {pred} GROUP BY symbol", E, by=_fingerprints)

# Importance roll-ups and their stability.
sql_op("ag_17", f"SELECT symbol, feature, {R('CASE WHEN total > 0 THEN importance / total ELSE 1.0 / n END')} AS share FROM (SELECT symbol, feature, importance, sum(importance) OVER (PARTITION BY symbol) AS total, count(*) OVER (PARTITION BY symbol) AS n FROM {{imp}}) q", I)
sql_op("ag_18", f"SELECT feature, {R('avg(importance)')} AS mean_imp, {R('percentile(importance, 0.5)')} AS median_imp, {R('exp(avg(ln(greatest(importance, 1e-12))))')} AS geo_imp, {R('stddev_pop(importance)')} AS sd, count(*) FILTER (WHERE importance > 0.05) AS agree, row_number() OVER (ORDER BY round(avg(importance), 12) DESC, feature) AS place FROM {{imp}} GROUP BY feature", I)
sql_op("ag_19", f"SELECT feature, {R('count(*) FILTER (WHERE rn <= 2) / (1.0 * count(*))')} AS agreement, {R('max(importance)')} AS max_score, CASE WHEN count(*) FILTER (WHERE rn <= 2) >= 0.7 * count(*) THEN 'HIGH' WHEN count(*) FILTER (WHERE rn <= 2) >= 0.4 * count(*) THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round(importance, 9) DESC, feature) AS rn FROM {{imp}}) q GROUP BY feature", I)
_FACTS = "SELECT symbol, ts, 'auc' AS metric, auc AS v FROM {runs} UNION ALL SELECT symbol, ts, 'pos_rate', pos_rate FROM {runs} UNION ALL SELECT symbol, ts, 'n', CAST(n AS DOUBLE) FROM {runs}"
sql_op("ag_20", f"SELECT metric, symbol, {R('avg(v)')} AS mean, {R('stddev_pop(v)')} AS sd, {R('min(v)')} AS lo, {R('max(v)')} AS hi, count(*) AS n FROM {{facts}} GROUP BY GROUPING SETS ((metric, symbol), (metric))", {**P, "facts": _FACTS})
_SYM = "SELECT 'y5' AS target, symbol, auc FROM {score} UNION ALL SELECT 'y5_half', symbol, auc / 2 FROM {score} UNION ALL SELECT 'y5_boost', symbol, least(auc * 1.4, 1.0) FROM {score}"
A = {**S, "sym": _SYM}
_AGG = "SELECT target, avg(auc) AS mean, percentile(auc, 0.5) AS med, min(auc) AS lo, max(auc) AS hi, percentile(auc, 0.75) - percentile(auc, 0.25) AS iqr, avg(CASE WHEN auc >= 0.6 THEN 1.0 ELSE 0.0 END) AS good FROM {sym} GROUP BY target"
A = {**A, "agg": _AGG}
sql_op("ag_21", f"SELECT target, {R('mean')} AS mean, {R('med')} AS median, {R('lo')} AS lo, {R('hi')} AS hi, {R('iqr')} AS iqr, {R('good')} AS frac_good FROM {{agg}}", A)
sql_op("ag_22", "SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts, CAST(sum(CAST('0x' || substr(md5(concat(symbol, '|', CAST(ts AS VARCHAR))), 1, 8) AS BIGINT)) AS VARCHAR) AS fingerprint, min(n) AS least_rows, max(n) AS most_rows, round(count(*) / count(DISTINCT symbol) + 3e-8, 6) AS mean_rows FROM (SELECT symbol, ts, count(*) OVER (PARTITION BY symbol) AS n FROM {bars_w}) b", by=_cohort)
sql_op("ag_23", f"SELECT target, symbol, {R('auc')} AS auc, 'symbol' AS level FROM {{sym}} UNION ALL SELECT target, NULL, {R('mean')}, 'cross_sectional' FROM {{agg}}", A)
_SNAP = "SELECT year(ts) AS snap, feature, coalesce(abs(corr(x, y)), 0.0) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, feature"
_SR = "SELECT snap, feature, importance, row_number() OVER (PARTITION BY snap ORDER BY round(importance, 9) DESC, feature) AS rk FROM {snap}"
N = {**L, "snap": _SNAP, "sr": _SR}
_TAU = "SELECT a.snap AS s1, b.snap AS s2, sum(CASE WHEN (a.rk - a2.rk) * (b.rk - b2.rk) > 0 THEN 1 ELSE -1 END) / (1.0 * count(*)) AS tau FROM {sr} a JOIN {sr} a2 ON a.snap = a2.snap AND a.feature < a2.feature JOIN {sr} b ON b.snap = a.snap + 1 AND b.feature = a.feature JOIN {sr} b2 ON b2.snap = b.snap AND b2.feature = a2.feature GROUP BY a.snap, b.snap"
_JAC = "SELECT a.snap AS s1, b.snap AS s2, count(*) / (4.0 - count(*)) AS jaccard FROM {sr} a JOIN {sr} b ON b.snap = a.snap + 1 AND a.feature = b.feature WHERE a.rk <= 2 AND b.rk <= 2 GROUP BY a.snap, b.snap"
N = {**N, "tau": _TAU, "jac": _JAC}
sql_op("stb_1", f"SELECT t.s1, t.s2, {R('tau')} AS kendall, {R('coalesce(jaccard, 0.0)')} AS jaccard FROM {{tau}} t LEFT JOIN {{jac}} j ON t.s1 = j.s1", N)
sql_op("stb_2", f"SELECT feature, {R('count(*) FILTER (WHERE rk <= 2) / (1.0 * count(*))')} AS frequency FROM {{sr}} GROUP BY feature", N)
sql_op("stb_3", "SELECT t.s1, CASE WHEN coalesce(jaccard, 0.0) >= 0.75 AND tau >= 0.65 THEN 'stable' WHEN tau >= 0.0 THEN 'drifting' ELSE 'diverged' END AS label FROM {tau} t LEFT JOIN {jac} j ON t.s1 = j.s1", N)
sql_op("stb_4", f"SELECT a.snap, {R('corr(a.rk, b.rk)')} AS spearman, {R('avg(a.importance) - avg(b.importance)')} AS delta FROM {{sr}} a JOIN {{sr}} b ON b.snap = a.snap - 1 AND a.feature = b.feature GROUP BY a.snap", N)
sql_op("stb_5", "SELECT feature, CASE WHEN cs >= 0.1 AND sy >= 0.5 THEN 'CORE' WHEN sy >= 0.5 THEN 'SYMBOL_SPECIFIC' WHEN cs >= 0.1 THEN 'CS_SPECIFIC' ELSE 'WEAK' END AS tag FROM (SELECT feature, avg(importance) AS cs, avg(CASE WHEN importance > 0.1 THEN 1.0 ELSE 0.0 END) AS sy FROM {imp} GROUP BY feature) q", I)
sql_op("drf_1", f"SELECT {X}, {R('auc - prev_auc')} AS delta, {R('(auc - prev_auc) / nullif(prev_auc, 0)')} AS rel_delta, CASE WHEN prev_auc IS NULL THEN 'NONE' WHEN abs(coalesce((auc - prev_auc) / nullif(prev_auc, 0), auc)) >= 0.2 THEN 'ALERT' WHEN abs(coalesce((auc - prev_auc) / nullif(prev_auc, 0), auc)) >= 0.05 THEN 'WARN' ELSE 'OK' END AS tier FROM {{prev}}", P)
sql_op("drf_2", f"SELECT {X}, CASE WHEN prev_n IS NULL THEN 'first' WHEN n = prev_n THEN 'comparable' ELSE 'changed' END AS comparability, n - prev_n AS d_n, {R('pos_rate - prev_pos')} AS d_pos, {R('max(auc) OVER (' + KEY + ' ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS best_auc FROM {{prev}}", P)
_W = "power(0.5, (back - 1) / 6.0)"
_FIT = f"SELECT symbol, sum({_W}) AS w, sum({_W} * place) AS wx, sum({_W} * auc) AS wy, sum({_W} * place * place) AS wxx, sum({_W} * place * auc) AS wxy FROM {{prev}} GROUP BY symbol"
sql_op("trd_1", f"SELECT symbol, {R('(w * wxy - wx * wy) / nullif(w * wxx - wx * wx, 0)')} AS slope, {R('wy / w')} AS level, CASE WHEN (w * wxy - wx * wy) / nullif(w * wxx - wx * wx, 0) < -0.01 THEN 'declining' WHEN (w * wxy - wx * wy) / nullif(w * wxx - wx * wx, 0) > 0.01 THEN 'improving' ELSE 'flat' END AS trend FROM {{fit}}", {**P, "fit": _FIT})
sql_op("dec_1", "SELECT symbol, CASE WHEN avg(CASE WHEN back <= 3 THEN auc END) < 0.8 * avg(CASE WHEN back > 3 THEN auc END) THEN 'score_decline' WHEN abs(avg(CASE WHEN back <= 3 THEN pos_rate END) - avg(CASE WHEN back > 3 THEN pos_rate END)) > 0.1 THEN 'balance_drift' ELSE 'none' END AS decision FROM {prev} GROUP BY symbol", P)
sql_op("rte_1", "SELECT target, CASE WHEN hi >= 0.95 THEN 'BLOCKED' WHEN mean >= 0.65 AND good >= 0.5 THEN 'BOTH' WHEN mean >= 0.65 THEN 'CROSS_SECTIONAL' WHEN good > 0 THEN 'SYMBOL_SPECIFIC' ELSE 'BLOCKED' END AS route FROM {agg}", A)
sql_op("rte_2", "SELECT s.target, s.symbol, CASE WHEN auc >= 0.95 THEN 'LEAK_BLOCKED' WHEN auc >= 0.65 AND mean >= 0.65 THEN 'BOTH' WHEN auc >= 0.65 THEN 'LOCAL' WHEN mean >= 0.65 THEN 'CROSS' ELSE 'EXPERIMENTAL' END AS route FROM {sym} s JOIN {agg} a ON s.target = a.target", A)
