"""Verdicts on scores, splits, gates, lagged runs, frames and coverage of bars; the SQL is written apart from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.functions.portable import correlation
from barloom.operators import coverage, drift, gating, leak_scores, segments, splits, validation
from barloom.plans.bar_queries import KEY, NY, F, L
from barloom.plans.panel_queries import features
from barloom.plans.registry import NUDGE, sql_op
from barloom.sources import panels

R = f"round({{}} + {NUDGE}, 6)".format
X = "symbol, CAST(ts AS STRING) AS ts"


# Bars of minutes for some symbols and of hours for others, some times twice.
def _uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = panels.ticks_to_bars(panels.hourly_ticks(spark, sf_dir), "minute").filter("length(symbol) % 2 = 0")
    both = fine.unionByName(panels.hourly_bars(spark, sf_dir).filter("length(symbol) % 2 = 1"))
    twice = both.filter("minute(ts) % 10 = 0").withColumns({"high": fn.col("high") * 2, "close": fn.col("close") * 2, "n_trades": fn.col("n_trades") + 100})
    return both.unionByName(twice)


_COLUMNS = "symbol, ts, open, high, low, close, volume, n_trades"
_UNEVEN = {
    "bars_m": panels.BARS_M,
    "both": f"SELECT {_COLUMNS} FROM {{bars_m}} WHERE length(symbol) % 2 = 0 UNION ALL SELECT {_COLUMNS} FROM {{bars_h}} WHERE length(symbol) % 2 = 1",
    "uneven": f"SELECT {_COLUMNS} FROM {{both}} UNION ALL SELECT symbol, ts, open, high * 2, low, close * 2, volume, n_trades + 100 FROM {{both}} WHERE minute(ts) % 10 = 0",
    "once": "SELECT * FROM {uneven} QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY n_trades) = 1",
    "pace": f"SELECT symbol AS k, min(gap) <= 300 AS merge FROM (SELECT symbol, epoch(ts) - epoch(lag(ts) OVER ({KEY})) AS gap FROM {{once}}) q GROUP BY symbol",
    "frames": "SELECT symbol, coalesce(merge, false) AS resampled, CASE WHEN merge THEN make_timestamp(CAST(floor(epoch(ts) / 900) * 900000000 AS BIGINT)) ELSE ts END AS bar, o.* EXCLUDE (symbol) FROM {once} o JOIN {pace} ON symbol = k",
    "made": "SELECT symbol, bar AS ts, resampled, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, sum(volume)::BIGINT AS volume, count(*) AS n_bars FROM {frames} GROUP BY symbol, bar, resampled",
}
sql_op("ag_3_timeframe", f"SELECT {X}, resampled, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, {R('close')} AS close, volume, n_bars FROM {{made}}", _UNEVEN, by=lambda s, d: coverage.by_timeframe(_uneven(s, d), 15).select("symbol", "ts", "resampled", "open", "high", "low", "close", "volume", "n_bars"))
_STEP = {**_UNEVEN, "steps": f"SELECT symbol, ts, (epoch(ts) - epoch(lag(ts) OVER ({KEY}))) / 60.0 AS gap FROM {{made}}", "seen": "SELECT symbol, ts, gap, gap < 1440 AS inside, abs(gap - round(gap / 15) * 15) > 0.1 OR gap < 14.9 AS wrong FROM {steps}"}
sql_op("ag_3_steps", "SELECT symbol, count(*) FILTER (WHERE inside) AS n_steps, count(*) FILTER (WHERE inside AND wrong) AS n_wrong, count(*) FILTER (WHERE inside AND NOT wrong AND gap > 15.1) AS n_holes, CAST(min(ts) FILTER (WHERE inside AND wrong) AS STRING) AS first_wrong FROM {seen} GROUP BY symbol", _STEP, by=lambda s, d: coverage.step_report(coverage.by_timeframe(_uneven(s, d), 15), 15))
_DAYS = {"days": f"SELECT symbol, CAST({NY} AS DATE) AS d, count(*) AS n FROM {{bars_h}} GROUP BY 1, 2", "placed": "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY d DESC) <= 5 AS late, n BETWEEN 23 AND 25 AS whole, n BETWEEN 17 AND 19 AS short FROM {days}"}
sql_op(
    "ag_6_coverage",
    f"SELECT symbol, count(*) AS sessions, CAST(min(d) AS STRING) AS first_date, CAST(max(d) AS STRING) AS last_date, {R('100.0 * count(*) FILTER (WHERE whole OR short) / count(*)')} AS pct_complete, {R('avg(n)')} AS avg_bars, count(*) FILTER (WHERE short) AS n_early, count(*) FILTER (WHERE late) AS recent_sessions, {R('100.0 * count(*) FILTER (WHERE late AND (whole OR short)) / count(*) FILTER (WHERE late)')} AS pct_recent FROM {{placed}} GROUP BY symbol",
    _DAYS,
    by=lambda s, d: coverage.session_coverage(panels.hourly_bars(s, d), 24, 18, 1, 5),
)


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars of suppliers' nations; the even ones have faults of every kind."""
    hit = lambda k: (fn.col("symbol").cast("int") % 2 == 0) & (fn.col("n_trades") % k == 0)
    bars = panels.weekly_bars(spark, sf_dir)
    spoilt = bars.withColumns({"open": fn.when(hit(7), 0.0).otherwise(fn.col("open")), "high": fn.when(hit(11), fn.col("low") - 1).otherwise(fn.col("high")), "low": fn.when(hit(5), fn.col("close") + 1).otherwise(fn.col("low")), "volume": fn.when(hit(13), -1).otherwise(fn.col("volume")), "close": fn.when(~hit(3), fn.col("close"))})
    return spoilt.unionByName(spoilt.filter(hit(4)))


_HIT = "CAST(symbol AS INT) % 2 = 0 AND n_trades % {} = 0".format
_FAULTY = {
    "spoilt": f"SELECT symbol, ts, n_trades, CASE WHEN {_HIT(7)} THEN 0.0 ELSE open END AS open, CASE WHEN {_HIT(11)} THEN low - 1 ELSE high END AS high, CASE WHEN {_HIT(5)} THEN close + 1 ELSE low END AS low, CASE WHEN {_HIT(13)} THEN -1 ELSE volume END AS volume, CASE WHEN {_HIT(3)} THEN NULL ELSE close END AS close FROM {{bars_w}}",
    "faulty": f"SELECT * FROM {{spoilt}} UNION ALL SELECT * FROM {{spoilt}} WHERE {_HIT(4)}",
    "counted": "SELECT symbol, count(*) AS n, count(*) FILTER (WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS n_price, count(*) FILTER (WHERE high < low OR high < open OR high < close) AS n_high, count(*) FILTER (WHERE low > open OR low > close) AS n_low, count(*) FILTER (WHERE volume < 0) AS n_volume, count(*) FILTER (WHERE close IS NULL) AS n_null, count(*) - count(DISTINCT ts) AS n_repeated, 1 - count(DISTINCT ts) / (date_diff('day', min(ts), max(ts)) / 7 + 1.0) AS missing FROM {faulty} GROUP BY symbol",
}
sql_op("prj_11_sanity", f"SELECT symbol, n, n_price, n_high, n_low, n_volume, n_null, n_repeated, {R('missing')} AS missing, n_price + n_high + n_low + n_volume + n_null + n_repeated = 0 AND missing < 0.05 AS sane FROM {{counted}}", _FAULTY, by=lambda s, d: coverage.sanity(_faulty(s, d), 10080))


# Splits by groups of weeks: the purge as asked for, and one that would leave no training week.
def _split_report(spark: SparkSession, sf_dir: str, purge: int) -> DataFrame:
    rows = splits.group_splits(panels.weekly_bars(spark, sf_dir).select("symbol", "ts"), 5, purge)
    return rows.groupBy("test_fold", "part").agg(fn.count("*").alias("n"), fn.countDistinct("ts").alias("n_times"), fn.min("ts").alias("first_ts"), fn.max("ts").alias("last_ts"), fn.max("purged").alias("purged"))


def _split_sql(purge: int) -> tuple[str, dict[str, str]]:
    parts = {
        "times": "SELECT ts, count(*) AS n, row_number() OVER (ORDER BY ts) - 1 AS r FROM {bars_w} GROUP BY ts",
        "dealt": "SELECT f.v::INT AS test_fold, ts, n, r, r % 5 = f.v AS own FROM {times}, (SELECT unnest(range(5)) AS v) f",
        "cut": f"SELECT test_fold AS k, count(*) AS groups, max(r) AS last, CASE WHEN count(*) > {purge} THEN {purge} ELSE greatest(1, count(*) // 10) END AS purged FROM {{dealt}} WHERE NOT own GROUP BY test_fold",
    }
    return "SELECT test_fold, CASE WHEN own THEN 'val' ELSE 'train' END AS part, sum(n)::BIGINT AS n, count(*) AS n_times, CAST(min(ts) AS STRING) AS first_ts, CAST(max(ts) AS STRING) AS last_ts, max(purged)::INT AS purged FROM {dealt} JOIN {cut} ON test_fold = k WHERE own OR r <= last - purged GROUP BY 1, 2", parts


for _name, _purge in (("csx_9_splits", 17), ("csx_9_reduced", 1_000_000)):
    sql_op(_name, *_split_sql(_purge), by=lambda s, d, purge=_purge: _split_report(s, d, purge))
_HASH = "CAST('0x' || substr(md5('7|' || symbol || '|' || CAST(ts AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"
sql_op("csx_10_parts", f"SELECT {X}, CASE WHEN {_HASH} < 0.7 THEN 'train' WHEN {_HASH} < 0.8 THEN 'val' ELSE 'test' END AS part FROM {{bars_w}}", by=lambda s, d: splits.hash_split(panels.weekly_bars(s, d).select("symbol", "ts"), ["symbol", "ts"], {"train": 0.7, "val": 0.1, "test": 0.2}, 7))


# A run a symbol and month, a segment a year; some runs lack their score or a feature.
def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = features(spark, sf_dir).filter("y IS NOT NULL AND f2 IS NOT NULL")
    share = lambda c: fn.avg(fn.when(c, 1.0).otherwise(0.0))
    runs = held.groupBy("symbol", fn.date_trunc("month", "ts").alias("ts")).agg(share(fn.col("f2") * fn.col("y") < 0).alias("auc"), share(fn.col("y") > 0).alias("pos_rate"), fn.avg("f4").alias("spread"), fn.count("*").alias("n"))
    odd = fn.month("ts") % 5 == fn.col("symbol").cast("int") % 5
    return runs.select("symbol", fn.year("ts").alias("segment"), "ts", fn.when(fn.month("ts") != 7, fn.col("auc")).alias("auc"), fn.when(~odd, fn.col("pos_rate")).alias("pos_rate"), "spread")


_G = "PARTITION BY symbol, segment ORDER BY ts"
_FRAME = {
    **F,
    "monthly": "SELECT symbol, date_trunc('month', ts) AS ts, avg(CASE WHEN f2 * y < 0 THEN 1.0 ELSE 0.0 END) AS auc, avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END) AS pos_rate, avg(f4) AS spread FROM {feats} WHERE y IS NOT NULL AND f2 IS NOT NULL GROUP BY 1, 2",
    "runs": "SELECT symbol, year(ts)::INT AS segment, ts, CASE WHEN month(ts) <> 7 THEN auc END AS auc, CASE WHEN month(ts) % 5 <> CAST(symbol AS INT) % 5 THEN pos_rate END AS pos_rate, spread FROM {monthly}",
    "filled": "SELECT symbol, segment, ts, auc, coalesce(pos_rate, median(pos_rate) OVER (PARTITION BY symbol, segment)) AS pos_rate, spread, count(*) OVER (PARTITION BY symbol, segment) AS n FROM {runs}",
    "lagged": f"SELECT symbol, segment, ts, auc, pos_rate, spread, lag(pos_rate) OVER ({_G}) AS pos_rate_lag1, lag(spread) OVER ({_G}) AS spread_lag1 FROM {{filled}} WHERE n >= 8",
    "kept": "SELECT *, count(*) OVER (PARTITION BY symbol, segment) AS n FROM {lagged} WHERE auc IS NOT NULL AND pos_rate_lag1 IS NOT NULL AND spread_lag1 IS NOT NULL AND pos_rate IS NOT NULL AND spread IS NOT NULL",
}
_SHOWN = ("auc", "pos_rate", "spread", "pos_rate_lag1", "spread_lag1")
sql_op("csx_15_frame", f"SELECT symbol, segment, CAST(CAST(ts AS TIMESTAMP) AS STRING) AS ts, {', '.join(f'{R(c)} AS {c}' for c in _SHOWN)}, {R('pos_rate - pos_rate_lag1')} AS d_pos_rate, {R('spread - spread_lag1')} AS d_spread FROM {{kept}} WHERE n >= 8", _FRAME, by=lambda s, d: segments.lag_frame(_runs(s, d), ["pos_rate", "spread"], "auc", ["symbol", "segment"]))


# The last five bars' return as a prediction, held back or raised by ranks of three features within their week.
RULES = [gating.Rule("p_peak", 0.5), gating.Rule("p_valley", 1.2), gating.blocked("p_fall")]


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = {p: fn.expr(f"CASE WHEN {x} IS NOT NULL THEN percent_rank() OVER (PARTITION BY ts ORDER BY {x} NULLS LAST) END") for p, x in (("p_peak", "f4"), ("p_valley", "f1"), ("p_fall", "f3"))}
    return features(spark, sf_dir).withColumns(ranks).select("symbol", "ts", fn.col("f2").alias("raw"), gating.gated("f2", RULES, 0.7).alias("gated"), *ranks)


_GATE = {**F, "ranked": "SELECT symbol, ts, f2 AS raw, " + ", ".join(f"CASE WHEN {x} IS NOT NULL THEN percent_rank() OVER (PARTITION BY ts ORDER BY {x} NULLS LAST) END AS {p}" for p, x in (("p_peak", "f4"), ("p_valley", "f1"), ("p_fall", "f3"))) + " FROM {feats}"}
_GATE["gates"] = "SELECT *, CASE WHEN p_fall > 0.8 THEN raw * 0 ELSE raw * CASE WHEN p_peak > 0.7 THEN 0.5 ELSE 1 END * CASE WHEN p_valley > 0.7 THEN 1.2 ELSE 1 END END AS gated FROM {ranked}"
_MOMENTS = "SELECT '{0}' AS name, '{1}' AS kind, count({0}) AS n, round(avg({0}) + 3e-8, 6) AS mean, round(stddev_pop({0}) + 3e-8, 6) AS sd, count(*) FILTER (WHERE {0} {2}) AS n_marked FROM {{gates}}".format
sql_op("csx_18_gated", f"SELECT {X}, {R('raw')} AS raw, {R('gated')} + 0.0 AS gated FROM {{gates}}", _GATE, by=lambda s, d: _gated(s, d).select("symbol", "ts", "raw", "gated"))
sql_op("csx_18_summary", " UNION ALL ".join([_MOMENTS("raw", "prediction", "= 0"), _MOMENTS("gated", "prediction", "= 0"), *(_MOMENTS(p, "barrier", "> 0.7") for p in ("p_peak", "p_valley", "p_fall"))]), _GATE, by=lambda s, d: gating.gating_summary(_gated(s, d), ["raw", "gated"], ["p_peak", "p_valley", "p_fall"]))


# Three one-feature models a symbol: how often the feature's sign is the label's opposite; a fifth of the symbols get scores too good to be true.
def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features(spark, sf_dir).unpivot(["symbol", "ts", "y"], ["f1", "f2", "f4"], "feature", "x").dropna(subset=["x", "y"])
    k, early = fn.col("symbol").cast("int"), fn.year("ts") < 1995
    hit, more = fn.when((fn.col("x") > 0) == (fn.col("y") < 0), 1.0).otherwise(0.0), fn.when(k % 5 == 0, 0.45).otherwise(0.0)
    models = long.groupBy("symbol", "feature").agg((fn.avg(hit) + more).alias("s"), fn.abs(correlation("x", "y")).alias("imp"), (fn.avg(fn.when(early, hit)) + more).alias("early"), (fn.avg(fn.when(~early, hit)) + fn.when(k % 10 == 0, 0.45).otherwise(0.0)).alias("late"))
    table = models.groupBy("symbol").agg(fn.avg("s").alias("auc"), fn.stddev_pop("s").alias("sd"), fn.count("*").alias("n_models"), (3 * fn.avg("imp")).alias("mean_importance"), fn.max("early").alias("train"), fn.avg("late").alias("cv"), fn.min("late").alias("val"), (fn.max("imp") / fn.sum("imp")).alias("top_share"), fn.map_from_entries(fn.collect_list(fn.struct("feature", "s"))).alias("model_scores"))
    named = table.withColumns({"task": fn.when(k % 3 == 0, "regression").when(k % 3 == 1, "binary").otherwise("multiclass"), "target": fn.when(k % 2 == 0, "fwd_ret_5").otherwise("up")})
    judged = leak_scores.leak_status(named.withColumn("composite", leak_scores.composite()))
    return judged.select("symbol", "auc", "composite", "n_flags", "status", leak_scores.suspicion().alias("suspicion"), leak_scores.skip_reason().alias("skip_reason"))


_SCORED = {
    **L,
    "hits": "SELECT symbol, feature, x, y, CAST(symbol AS INT) AS k, year(ts) < 1995 AS early, CASE WHEN (x > 0) = (y < 0) THEN 1.0 ELSE 0.0 END AS hit FROM {long} WHERE feature <> 'f3' AND x IS NOT NULL AND y IS NOT NULL",
    "models": "SELECT symbol, k, feature, avg(hit) + CASE WHEN k % 5 = 0 THEN 0.45 ELSE 0 END AS s, abs(corr(x, y)) AS imp, avg(hit) FILTER (WHERE early) + CASE WHEN k % 5 = 0 THEN 0.45 ELSE 0 END AS early, avg(hit) FILTER (WHERE NOT early) + CASE WHEN k % 10 = 0 THEN 0.45 ELSE 0 END AS late FROM {hits} GROUP BY symbol, k, feature",
    "bounds": "SELECT symbol, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 0.5 ELSE 0.7 END ELSE 0.9 END AS high, k % 3 = 0 AS reg, s, imp, early, late FROM {models}",
    "table": "SELECT symbol, reg, high, avg(s) AS auc, stddev_pop(s) AS sd, count(*) AS m, 3 * avg(imp) AS importance, max(early) AS train, avg(late) AS cv, min(late) AS val, max(imp) / sum(imp) AS top, count(*) FILTER (WHERE s > high) AS n_high FROM {bounds} GROUP BY symbol, reg, high",
    "rated": "SELECT *, (0.5 * CASE WHEN reg THEN greatest(auc, 0) ELSE auc END + 0.25 / (1 + sd) + 0.25 * importance * CASE WHEN reg AND auc <= 0 THEN greatest(0.5, 1 - abs(auc) * 0.67) ELSE 1 + auc END) * (1 + least(0.1, 0.02 * m)) AS composite FROM {table}",
    "flags": "SELECT *, (auc > high)::INT + (n_high >= 3)::INT AS a, (composite > 0.5 AND auc < CASE WHEN reg THEN 0.2 ELSE 0.6 END)::INT + (importance > 0.7 AND auc < CASE WHEN reg THEN 0.1 ELSE 0.5 END)::INT AS b FROM {rated}",
}
_SUSPECT = "CASE WHEN cv >= 0.85 THEN 0.4 WHEN cv >= 0.75 THEN 0.2 WHEN cv < 0.55 THEN -0.2 ELSE 0 END + CASE WHEN train - cv < 0.05 AND train >= 0.99 THEN 0.3 WHEN train - cv > 0.2 THEN -0.2 ELSE 0 END + CASE WHEN top >= 0.5 THEN 0.3 WHEN top >= 0.4 THEN 0.2 WHEN top < 0.2 THEN -0.1 ELSE 0 END"
sql_op(
    "qa_6_scores",
    f"SELECT symbol, {R('auc')} AS auc, {R('composite')} AS composite, a + b AS n_flags, CASE WHEN a + b > 1 THEN 'SUSPICIOUS' WHEN a = 1 THEN 'HIGH_SCORE' WHEN b = 1 THEN 'INCONSISTENT' ELSE 'OK' END AS status, {R(f'CAST(greatest(0, least(1, {_SUSPECT})) AS DOUBLE)')} AS suspicion, CASE WHEN train >= 0.99 THEN 'train_score' WHEN train - cv >= 0.2 THEN 'train_cv_gap' WHEN train - val >= 0.2 THEN 'train_val_gap' ELSE 'none' END AS skip_reason FROM {{flags}}",
    _SCORED,
    by=_scores,
)


# Runs of a symbol and month against the last one of an odd or even month alike; the positive rate is critical.
def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).withColumns({"run_id": fn.date_format("ts", "yyyy-MM"), "parity": fn.when(fn.month("ts") != 3, fn.month("ts") % 2)})
    return drift.metric_drift(runs, ["symbol"], ["parity"], ["auc", "pos_rate"], {"pos_rate"}).select("symbol", "run_id", "baseline_id", "metric", "now", "base", "delta", "rel_delta", "tier", "status")


_DRIFT = {
    **_FRAME,
    "signed": "SELECT symbol, strftime(ts, '%Y-%m') AS run_id, month(ts) % 2 AS parity, auc, pos_rate FROM {runs} WHERE month(ts) <> 3",
    "based": "SELECT a.symbol, a.run_id, max(b.run_id) AS baseline_id FROM {signed} a JOIN {signed} b ON a.symbol = b.symbol AND a.parity = b.parity AND b.run_id < a.run_id GROUP BY 1, 2",
    "pairs": "SELECT p.symbol, p.run_id, baseline_id, metric, now, base FROM {based} p JOIN (SELECT symbol, run_id, unnest(['auc', 'pos_rate']) AS metric, unnest([auc, pos_rate]) AS now FROM {signed}) a ON p.symbol = a.symbol AND p.run_id = a.run_id JOIN (SELECT symbol, run_id, unnest(['auc', 'pos_rate']) AS m, unnest([auc, pos_rate]) AS base FROM {signed}) b ON p.symbol = b.symbol AND baseline_id = b.run_id AND m = metric WHERE now IS NOT NULL AND base IS NOT NULL",
    "sized": "SELECT *, now - base AS delta, (now - base) / nullif(base, 0) AS rel, abs(CASE WHEN base = 0 THEN now ELSE (now - base) / base END) AS size, CASE WHEN metric = 'auc' THEN CASE WHEN base = 0 THEN [0.01, 0.1] ELSE [0.05, 0.2] END ELSE CASE WHEN base = 0 THEN [0.001, 0.01] ELSE [0.01, 0.03] END END AS lim FROM {pairs}",
}
sql_op("drf_1_metrics", f"SELECT symbol, run_id, baseline_id, metric, {R('now')} AS now, {R('base')} AS base, {R('delta')} AS delta, {R('rel')} AS rel_delta, CASE WHEN size < lim[1] THEN 'OK' WHEN size < lim[2] THEN 'WARN' ELSE 'ALERT' END AS tier, CASE WHEN size < lim[1] THEN 'STABLE' WHEN size < lim[2] THEN 'DRIFTING' ELSE 'DIVERGED' END AS status FROM {{sized}}", _DRIFT, by=_drift)


# A run a symbol and year: a feature's importance is its absolute correlation with the label; every third year lacks f3.
def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features(spark, sf_dir).unpivot(["symbol", "ts", "y"], ["f1", "f2", "f3", "f4"], "feature", "x").dropna(subset=["x", "y"])
    each = long.groupBy("symbol", fn.year("ts").alias("ts"), "feature").agg(fn.round(fn.coalesce(fn.abs(correlation("x", "y")), fn.lit(0.0)), 9).alias("importance"))
    score = fn.expr("round(avg(importance) OVER (PARTITION BY symbol, ts), 9)")
    return each.withColumn("score", score).filter("NOT (feature = 'f3' AND ts % 3 = 0)").withColumn("run_id", fn.col("ts").cast("string"))


_YEARLY = {
    **L,
    "each": "SELECT symbol, year(ts) AS yr, feature, round(CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN abs(corr(x, y)) ELSE 0.0 END, 9) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2, 3",
    "snaps": "SELECT symbol, yr, dense_rank() OVER (PARTITION BY symbol ORDER BY yr) AS r, feature, importance, score, row_number() OVER (PARTITION BY symbol, yr ORDER BY importance DESC, feature) <= 2 AS best FROM (SELECT *, round(avg(importance) OVER (PARTITION BY symbol, yr), 9) AS score FROM {each}) q WHERE NOT (feature = 'f3' AND yr % 3 = 0)",
    "steps": "SELECT DISTINCT a.symbol, a.yr, a.r, a.score, b.score AS was FROM {snaps} a LEFT JOIN {snaps} b ON a.symbol = b.symbol AND b.r = a.r - 1",
    "united": "SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.r, b.r + 1) AS r, coalesce(a.importance, 0) AS x, coalesce(b.importance, 0) AS y, coalesce(a.best, false) AS t, coalesce(b.best, false) AS u FROM {snaps} a FULL JOIN {snaps} b ON a.symbol = b.symbol AND a.r = b.r + 1 AND a.feature = b.feature",
    "ranks": "SELECT symbol, r, t, u, rank() OVER (PARTITION BY symbol, r ORDER BY x) + (count(*) OVER (PARTITION BY symbol, r, x) - 1) / 2.0 AS p, rank() OVER (PARTITION BY symbol, r ORDER BY y) + (count(*) OVER (PARTITION BY symbol, r, y) - 1) / 2.0 AS q FROM {united}",
    "alike": "SELECT symbol, r, count(*) FILTER (WHERE t AND u) / nullif(count(*) FILTER (WHERE t OR u), 0) AS overlap, CASE WHEN stddev_pop(p) > 0 AND stddev_pop(q) > 0 THEN corr(p, q) END AS corr FROM {ranks} GROUP BY symbol, r",
    "facts": "SELECT s.symbol, yr, s.r, abs(score - was) AS d, CASE WHEN s.r > 1 THEN overlap END AS o, CASE WHEN s.r > 1 THEN corr END AS c FROM {steps} s JOIN {alike} a ON s.symbol = a.symbol AND s.r = a.r",
}
sql_op(
    "stb_4_runs",
    f"SELECT symbol, CAST(yr AS VARCHAR) AS run_id, {R('d')} AS delta_score, {R('o')} AS overlap, {R('c')} AS corr, CASE WHEN r = 1 THEN 'no_previous_run' WHEN coalesce(d > 0.05, false) OR coalesce(o < 0.3, false) OR coalesce(c < 0.1, false) THEN 'unstable' WHEN coalesce(d > 0.035, false) OR coalesce(o < 0.33, false) OR coalesce(c < 0.11, false) THEN 'borderline' ELSE 'stable' END AS status FROM {{facts}}",
    _YEARLY,
    by=lambda s, d: drift.reproducibility(_yearly(s, d), ["symbol"], 2, 0.05, 0.3, 0.1).select("symbol", "run_id", "delta_score", "overlap", "corr", "status"),
)


# Features, labels and predictions with values missing, without end, constant or out of range.
def _spoilt_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = {
        "f1": "CASE WHEN f4 > 1 THEN CAST('inf' AS DOUBLE) ELSE f1 END", "f3": "CASE WHEN f4 > 0.5 THEN CAST('nan' AS DOUBLE) ELSE f3 END", "same": "CASE WHEN f2 IS NOT NULL THEN 3 END",
        "mostly": "CASE WHEN f1 > 0.3 THEN y END", "fwd_ret_5": "3 * f2", "will_peak": "y", "mdd_5": "CASE WHEN f2 > 0 THEN 1 ELSE 0 END",
    }
    df = features(spark, sf_dir)
    return df.select("symbol", "ts", "f2", "y", *(fn.expr(e).cast("double").alias(c) for c, e in made.items()))


_SPOILT = {**F, "odd": "SELECT symbol, ts, f2, y, CASE WHEN f4 > 1 THEN CAST('inf' AS DOUBLE) ELSE f1 END AS f1, CASE WHEN f4 > 0.5 THEN CAST('nan' AS DOUBLE) ELSE f3 END AS f3, CAST(CASE WHEN f2 IS NOT NULL THEN 3 END AS DOUBLE) AS same, CASE WHEN f1 > 0.3 THEN y END AS mostly, 3 * f2 AS fwd_ret_5, y AS will_peak, CAST(CASE WHEN f2 > 0 THEN 1 ELSE 0 END AS DOUBLE) AS mdd_5 FROM {feats}"}
_KINDS = {"f1": "feature", "f2": "feature", "f3": "feature", "same": "feature", "y": "target", "mostly": "target", "fwd_ret_5": "prediction", "will_peak": "prediction", "mdd_5": "prediction"}
_SPOILT["flat"] = " UNION ALL ".join(f"SELECT '{c}' AS name, '{k}' AS kind, {c} AS x, {c} IS NULL OR isnan({c}) AS gone FROM {{odd}}" for c, k in _KINDS.items())
_SPOILT["told"] = "SELECT name, kind, count(*) AS n, count(*) FILTER (WHERE gone) AS n_missing, count(*) FILTER (WHERE isinf(x)) AS n_inf, count(*) FILTER (WHERE gone) / count(*) AS missing, count(DISTINCT x) FILTER (WHERE NOT gone) = 1 AS constant, min(x) FILTER (WHERE isfinite(x)) AS lo, max(x) FILTER (WHERE isfinite(x)) AS hi, avg(x) FILTER (WHERE isfinite(x)) AS mean, stddev_pop(x) FILTER (WHERE isfinite(x)) AS sd FROM {flat} GROUP BY name, kind"
_PROBLEMS = "concat_ws(',', CASE WHEN constant AND kind <> 'prediction' THEN 'constant' END, CASE WHEN name = 'fwd_ret_5' AND abs(hi) > 2 THEN 'extreme' END, CASE WHEN n_inf > 0 THEN 'infinite' END, CASE WHEN missing > 0.1 AND NOT (kind = 'target' AND missing > 0.5) THEN 'missing' END, CASE WHEN kind = 'target' AND missing > 0.5 THEN 'mostly_missing' END, CASE WHEN name IN ('will_peak', 'mdd_5') AND (lo < 0 OR hi > 1) THEN 'outside_unit' END)"
sql_op("qa_16_columns", f"SELECT name, kind, n, n_missing, n_inf, {R('missing')} AS missing, constant, {_PROBLEMS} AS problems, NOT (kind = 'target' AND (constant OR missing > 0.5)) AS valid FROM {{told}}", _SPOILT, by=lambda s, d: validation.column_report(_spoilt_panel(s, d), ["f1", "f2", "f3", "same"], ["y", "mostly"], ["fwd_ret_5", "will_peak", "mdd_5"]).select("name", "kind", "n", "n_missing", "n_inf", "missing", "constant", fn.array_join("problems", ",").alias("problems"), "valid"))
sql_op("ag_12_columns", f"SELECT name, kind, {R('mean')} AS mean, {R('sd')} AS sd, {R('lo')} AS lo, {R('hi')} AS hi, p.* FROM {{told}} JOIN (SELECT count(*) AS n, count(DISTINCT ts) AS n_times, round(count(*) / count(DISTINCT ts) + 3e-8, 6) AS per_time, CAST(min(ts) AS STRING) AS first_ts, CAST(max(ts) AS STRING) AS last_ts FROM {{odd}}) p ON true WHERE name IN ('f1', 'f2', 'f3', 'y')", _SPOILT, by=lambda s, d: validation.panel_stats(_spoilt_panel(s, d), ["f1", "f2", "f3"], "y"))
