"""Files of mixed types, symbols, times, volumes, intervals, changes of labels, routes and decisions; the SQL is written apart from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.functions.ewm import ewm_sql
from barloom.functions.portable import steps_sql
from barloom.operators import decisions, evaluation, interactions, intervals, label_checks, routes, run_rules, stability
from barloom.operators.features import CHAINS, add_group
from barloom.plans.bar_queries import F, L
from barloom.plans.panel_queries import features
from barloom.plans.registry import NUDGE, register, rounded, sql_op, translated
from barloom.sources import mixed, panels, symbols, times
from barloom.sources.scratch import fresh_folder

KEY = "PARTITION BY symbol ORDER BY ts"
R = f"round({{}} + {NUDGE}, 6)".format


# Bars in files of three kinds: whole prices and fractional volumes, times as texts, and as they are.
def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, bars = fresh_folder(spark, "mixed"), panels.weekly_bars(spark, sf_dir).withColumn("interval", fn.lit("1w"))
    whole = bars.filter("symbol < '10'").withColumns({"close": fn.floor("close"), "volume": fn.col("volume") + fn.when(fn.col("n_trades") % 2 == 0, 0.25).otherwise(0.0)})
    text = bars.filter("symbol >= '10' AND symbol < '2'").withColumn("ts", fn.date_format("ts", "yyyy-MM-dd")).withColumn("close", fn.col("close").cast("string"))
    for part in (whole, text, bars.filter("symbol >= '2'")):
        part.repartition("symbol").write.mode("append").partitionBy("interval", "symbol").parquet(root)
    return mixed.scan_mixed(spark, root, interval="1w")


_MIXED = "SELECT symbol, ts, CASE WHEN symbol < '10' THEN floor(close) ELSE close END AS close, volume, n_trades, volume + CASE WHEN symbol < '10' AND n_trades % 2 = 0 THEN 0.25 ELSE 0.0 END AS raw FROM {bars_w}"
sql_op("src_1_mixed", f"SELECT symbol, CAST(CAST(ts AS TIMESTAMP) AS STRING) AS ts, {R('close')} AS close, volume, n_trades, {R('raw')} AS volume_raw FROM {{mixed}}", {"mixed": _MIXED}, by=lambda s, d: _mixed(s, d).select("symbol", "ts", "close", "volume", "n_trades", "volume_raw"))
sql_op("src_1_rounding", f"SELECT symbol, count(*) AS n, count(*) FILTER (WHERE raw <> floor(raw)) AS n_rounded, {R('avg(CASE WHEN raw <> floor(raw) THEN 1.0 ELSE 0.0 END)')} AS share, CAST(0 AS BIGINT) AS n_half, count(*) FILTER (WHERE raw - floor(raw) = 0.25) AS n_quarter FROM {{mixed}} GROUP BY symbol", {"mixed": _MIXED}, by=lambda s, d: mixed.rounding_report(_mixed(s, d)).select("symbol", "n", "n_rounded", "share", "n_half", "n_quarter"))
sql_op("src_4_batch", "SELECT symbol FROM (SELECT DISTINCT symbol FROM {bars_w}) q ORDER BY md5(concat('7|', symbol)), symbol LIMIT 8", by=lambda s, d: symbols.batch(panels.weekly_bars(s, d), 8, 7))


# Customers' segments, a third of them spelled as share classes by a slash, a third by a dash.
def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = fn.col("c_custkey") % 3
    raw = spark.read.parquet(f"{sf_dir}/customer.parquet").select(fn.when(kind == 0, fn.lower(fn.concat("c_mktsegment", fn.lit("/a")))).when(kind == 1, fn.concat("c_mktsegment", fn.lit("-B"))).otherwise(fn.col("c_mktsegment")).alias("symbol"))
    return symbols.universe(raw, ["MACHINERY"], {"BUILDING.A": "BUILDING-A"})


_UNIVERSE = "SELECT symbol, clean, CASE WHEN clean = 'BUILDING.A' THEN 'BUILDING-A' ELSE clean END AS stored, n, CASE WHEN clean = 'MACHINERY' THEN 'blacklisted' WHEN symbol = clean THEN 'kept' ELSE 'changed' END AS status FROM (SELECT symbol, regexp_replace(upper(symbol), '[/-]', '.') AS clean, count(*) AS n FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) || '/a' WHEN 1 THEN c_mktsegment || '-B' ELSE c_mktsegment END AS symbol FROM {customer}) r GROUP BY symbol) u"
sql_op("src_5_universe", "SELECT * FROM {universe}", {"universe": _UNIVERSE}, by=_universe)
sql_op("src_5_audit", "SELECT status, count(*) AS n_symbols, CAST(sum(n) AS BIGINT) AS n_rows FROM {universe} GROUP BY status", {"universe": _UNIVERSE}, by=lambda s, d: symbols.audit(_universe(s, d)))


# Events' times as texts of five kinds, the last of them none.
def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, k = fn.col("ts").cast("timestamp"), fn.col("event_id") % 5
    text = fn.when(k == 0, fn.date_format(at, "yyyy-MM-dd HH:mm:ss")).when(k == 1, fn.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 2, fn.date_format(at, "yyyyMMdd")).when(k == 3, fn.unix_millis(at).cast("string")).otherwise("soon")
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.alias("text"))
    return df.select("event_id", fn.unix_seconds(times.as_time("text", df.schema["text"].dataType)).alias("epoch_s"))


sql_op("src_6_texts", "SELECT event_id, CASE event_id % 5 WHEN 2 THEN CAST(floor(epoch(date_trunc('day', ts))) AS BIGINT) WHEN 4 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS epoch_s FROM {events}", by=_texts)


def _volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", (fn.round(fn.col("value") * 4) / 4).alias("volume_raw"))
    apart = mixed.volume_policy(raw, "separate").select("event_id", fn.col("volume").alias("volume_int"), "volume_adj")
    held = mixed.volume_policy(raw, "quarantine").select(fn.col("event_id").alias("e"), "volume", fn.col("quarantined").cast("int").alias("quarantined"))
    return apart.join(held, fn.col("event_id") == fn.col("e")).drop("e")


sql_op("prj_2_policies", "SELECT event_id, CAST(floor(v) AS BIGINT) AS volume_int, v - floor(v) AS volume_adj, CASE WHEN v = floor(v) THEN CAST(v AS BIGINT) END AS volume, CASE WHEN v <> floor(v) THEN 1 ELSE 0 END AS quarantined FROM (SELECT event_id, round(value * 4) / 4.0 AS v FROM {events}) q", by=_volumes)


# Two versions of a label: the later one wants one percent more, starts at each symbol's third week and lacks symbol 7.
def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = panels.weekly_bars(spark, sf_dir).selectExpr("symbol", "ts", "close", f"lead(close, 5) OVER ({KEY}) AS later", f"row_number() OVER ({KEY}) AS place")
    label = lambda df, more: df.withColumn("y", fn.when(fn.col("later") > fn.col("close") * more, 1).when(fn.col("later").isNotNull(), 0))
    found = label_checks.label_changes(label(bars, 1.0), label(bars.filter("place > 2 AND symbol <> '7'"), 1.01), ["symbol", "ts"], "y", "symbol", 1)
    return found.select("symbol", "n_old", "n_new", "only_old", "only_new", "n_both", "n_diff", "match_rate", "old_mean", "new_mean", fn.get("examples", fn.lit(0))["ts"].alias("first_diff"))


_AGED = f"SELECT symbol, ts, place, CASE WHEN later > close THEN 1 WHEN later IS NOT NULL THEN 0 END AS y0, CASE WHEN place > 2 AND symbol <> '7' THEN CASE WHEN later > close * 1.01 THEN 1 WHEN later IS NOT NULL THEN 0 END END AS y1, place > 2 AND symbol <> '7' AS fresh FROM (SELECT *, lead(close, 5) OVER ({KEY}) AS later, row_number() OVER ({KEY}) AS place FROM {{bars_w}}) q"
sql_op("jn_3_changes", f"SELECT symbol, count(*) AS n_old, count(*) FILTER (WHERE fresh) AS n_new, count(*) FILTER (WHERE NOT fresh) AS only_old, CAST(0 AS BIGINT) AS only_new, count(y1) AS n_both, count(*) FILTER (WHERE y0 <> y1) AS n_diff, {R('avg(CASE WHEN y0 = y1 THEN 1.0 WHEN y0 <> y1 THEN 0.0 END)')} AS match_rate, {R('avg(y0) FILTER (WHERE fresh)')} AS old_mean, {R('avg(y1)')} AS new_mean, CAST(min(ts) FILTER (WHERE y0 <> y1) AS STRING) AS first_diff FROM {{aged}} GROUP BY symbol", {"aged": _AGED}, by=_changes)

# Intervals of hourly bars; the SQL lists gaps where the operator counts them.
_GAP = f"SELECT symbol, epoch(ts) / 60.0 - lag(epoch(ts) / 60.0) OVER ({KEY}) AS gap FROM {{bars_h}}"
_ROUGH = "SELECT symbol AS s, quantile_cont(gap, 0.5) AS rough FROM {gaps} WHERE gap > 0 AND gap <= 1440 GROUP BY symbol"
_NEAR = "SELECT symbol, count(gap) AS n_gaps, quantile_cont(gap, 0.5) AS median_gap FROM {gaps} JOIN {rough} ON symbol = s WHERE gap > 0 AND gap <= 1440 AND gap <= 10 * rough GROUP BY symbol"
sql_op("qa_1_intervals", f"SELECT symbol, n_gaps, {R('median_gap')} AS median_gap, coalesce(minutes, 5) AS minutes, CASE WHEN minutes IS NULL THEN 'odd' ELSE 'snapped' END AS status FROM (SELECT *, CASE WHEN abs(median_gap - 60) <= 12 THEN 60 WHEN abs(median_gap - 30) <= 6 THEN 30 WHEN abs(median_gap - 15) <= 3 THEN 15 WHEN abs(median_gap - 5) <= 1 THEN 5 WHEN abs(median_gap - 1) <= 0.2 THEN 1 END AS minutes FROM {{near}}) q", {"gaps": _GAP, "rough": _ROUGH, "near": _NEAR}, by=lambda s, d: intervals.bar_intervals(panels.hourly_bars(s, d)))


# Features against a binary label, with a copy and a flipped copy of it planted.
def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = fn.when(fn.col("y") > 0, 1.0).when(fn.col("y").isNotNull(), 0.0)
    df = features(spark, sf_dir).withColumns({"up": up, "f_copy": up, "f_flip": 1 - up, "is_weekend_up": up})
    return label_checks.near_copies(df, ["f1", "f2", "f_copy", "f_flip", "is_weekend_up"], "up", True).select("feature", "n", "match", "match_flipped", fn.col("leak").cast("int").alias("leak"))


_UP = "SELECT *, CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END AS up FROM {feats} WHERE y IS NOT NULL"
_MATCH = lambda name, x, leak: f"SELECT '{name}' AS feature, count(*) AS n, {R(f'avg(CASE WHEN abs({x} - up) < 1e-4 THEN 1.0 ELSE 0.0 END)')} AS match, {R(f'avg(CASE WHEN abs({x} - 1.0 + up) < 1e-4 THEN 1.0 ELSE 0.0 END)')} AS match_flipped, {leak} AS leak FROM {{up}}"
sql_op("qa_4_copies", " UNION ALL ".join(_MATCH(*a) for a in (("f1", "f1", 0), ("f2", "f2", 0), ("f_copy", "up", 1), ("f_flip", "(1.0 - up)", 1), ("is_weekend_up", "up", 0))), {**F, "up": _UP}, by=_copies)

# Three labels, and how well the last five weeks' loss tells them, over all and by symbol.
TARGETS = {"up_35d": "y > 0", "jump_35d": "y > 0.2", "next_7d": "y1 > 0"}


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir).selectExpr("symbol", "ts", "-f2 AS x", "y", f"lead(close, 1) OVER ({KEY}) / close - 1 AS y1").filter("x IS NOT NULL")
    told = fn.array(*(fn.struct(fn.lit(t).alias("target"), fn.expr(f"CAST({e} AS INT)").alias("pos")) for t, e in TARGETS.items()))
    return rows.select("symbol", "ts", "x", fn.inline(told)).filter("pos IS NOT NULL")


def _facts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row a key: score (AUC to nine places), rows, stability by the change of the share of positives, leak and task."""
    series = rows.withColumn("series", fn.concat_ws("|", *keys))
    score = evaluation.auc(series, "series", "x", fn.col("pos") == 1).select("series", fn.round("auc", 9).alias("score"))
    rate = lambda late: fn.avg(fn.when((fn.year("ts") >= 1996) == late, fn.col("pos")))
    moved = fn.abs(rate(True) - rate(False))
    stable = fn.when(moved.isNull(), "UNKNOWN").when(moved <= 0.08, "STABLE").when(moved <= 0.2, "DRIFTING").otherwise("DIVERGED")
    found = series.groupBy("series", *keys).agg(fn.count("*").alias("rows"), stable.alias("stability")).join(score, "series").drop("series")
    return found.withColumn("leak", fn.when(fn.col("score") >= 0.95, "BLOCKED").otherwise("SAFE")).withColumn("task", fn.lit("BINARY_CLASSIFICATION"))


def _cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_labelled(spark, sf_dir), ["target"])


def _local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_labelled(spark, sf_dir), ["target", "symbol"])


def _scores(facts: DataFrame) -> DataFrame:
    return facts.withColumnRenamed("score", "auc").drop("rows", "stability", "leak", "task")


_BASE = f"SELECT symbol, ts, -f2 AS x, y, y1 FROM (SELECT *, lead(close, 1) OVER ({KEY}) / close - 1 AS y1 FROM {{feats}}) q WHERE f2 IS NOT NULL"
_LABELLED = " UNION ALL ".join(f"SELECT '{t}' AS target, symbol, ts, x, CASE WHEN {e} THEN 1 ELSE 0 END AS pos FROM {{base}} WHERE {e.split()[0]} IS NOT NULL" for t, e in TARGETS.items())


def _facts_sql(keys: str) -> str:
    ranked = f"SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY x) AS rk, count(*) OVER (PARTITION BY {keys}, x) AS tied FROM {{labelled}}"
    auc = "round((sum(CASE WHEN pos = 1 THEN rk + (tied - 1) / 2.0 ELSE 0.0 END) - sum(pos) * (sum(pos) + 1) / 2.0) / nullif(sum(pos) * (count(*) - sum(pos)), 0), 9)"
    each = f"SELECT {keys}, {auc} AS score, count(*) AS n, abs(avg(pos) FILTER (WHERE year(ts) >= 1996) - avg(pos) FILTER (WHERE year(ts) < 1996)) AS moved FROM ({ranked}) r GROUP BY {keys}"
    return f"SELECT *, CASE WHEN moved IS NULL THEN 'UNKNOWN' WHEN moved <= 0.08 THEN 'STABLE' WHEN moved <= 0.2 THEN 'DRIFTING' ELSE 'DIVERGED' END AS stability FROM ({each}) e"


T = {**F, "base": _BASE, "labelled": _LABELLED, "crossed": _facts_sql("target"), "local": _facts_sql("target, symbol")}
_SUMMARY = "SELECT target AS t, count(score) AS n_symbols, avg(score) AS mean, quantile_cont(score, 0.5) AS med, min(score) AS lo, max(score) AS hi, quantile_cont(score, 0.75) - quantile_cont(score, 0.25) AS iqr, count(*) FILTER (WHERE score >= 0.6) / (1.0 * count(score)) AS good, coalesce(string_agg(symbol, ',' ORDER BY symbol) FILTER (WHERE score >= 0.6), '') AS winners FROM {local} GROUP BY target"
T = {**T, "summed": _SUMMARY}
sql_op("ag_21_winners", f"SELECT t AS target, n_symbols, {R('mean')} AS mean, {R('med')} AS median, {R('lo')} AS lo, {R('hi')} AS hi, {R('iqr')} AS iqr, {R('good')} AS frac_good, winners FROM {{summed}}", T, by=lambda s, d: routes.target_summary(_scores(_local(s, d))).withColumn("winners", fn.array_join("winners", ",")))
sql_op("ag_23_candidates", f"SELECT target, symbol, {R('score')} AS auc, 'symbol' AS level, 'both' AS mode FROM {{local}} WHERE target <> 'next_7d' UNION ALL SELECT target, NULL, {R('score')}, 'cross_sectional', CASE WHEN target = 'next_7d' THEN 'cross_sectional_only' ELSE 'both' END FROM {{crossed}}", T, by=lambda s, d: routes.candidates(_scores(_cross(s, d)), _scores(_local(s, d)).filter("target <> 'next_7d'")))
_ROUTE = "CASE WHEN score IS NULL THEN CASE WHEN hi >= 0.6 THEN 'SYMBOL_SPECIFIC' ELSE 'BLOCKED' END WHEN score >= 0.9 OR hi >= 0.95 THEN 'BLOCKED' WHEN score >= 0.65 AND good >= 0.5 THEN 'CROSS_SECTIONAL' WHEN score < 0.65 AND hi >= 0.6 THEN 'SYMBOL_SPECIFIC' WHEN score >= 0.65 AND (iqr > 0.15 OR good < 0.5) THEN 'BOTH' ELSE 'CROSS_SECTIONAL' END"
sql_op("rte_1_routes", f"SELECT target, {R('score')} AS auc, {_ROUTE} AS route FROM {{crossed}} JOIN {{summed}} ON target = t", T, by=lambda s, d: routes.target_routes(_scores(_cross(s, d)), _scores(_local(s, d))).select("target", "auc", "route"))
#: Fewer rows are asked for than of bars of five minutes; a horizon of over a day is let through by less.
RULES = routes.RouteRules(routes.SideRules(500, 0.62, 0.7, ("STABLE", "DRIFTING")), routes.SideRules(40, 0.64, 0.72, ("STABLE",)), experimental_score=0.55)
_STATE = "CASE WHEN n < {rows} OR score IS NULL OR score >= 0.95 THEN 'DISALLOWED' WHEN score >= {strong} AND stability IN ({ok}) THEN 'STRONG' WHEN score >= {least} AND stability IN ({ok}) THEN 'WEAK' WHEN score >= 0.55 AND stability IN ('DRIFTING', 'UNKNOWN') THEN 'EXPERIMENTAL' ELSE 'DISALLOWED' END".format
_SIDES = f"SELECT l.target, l.symbol, coalesce(c.state, 'DISALLOWED') AS cross_state, l.state AS local_state FROM (SELECT target, symbol, {_STATE(rows=40, strong=0.72, least=0.64, ok="'STABLE'")} AS state FROM {{local}}) l LEFT JOIN (SELECT target AS t, {_STATE(rows=500, strong=0.7, least=0.62, ok="'STABLE', 'DRIFTING'")} AS state FROM {{crossed}}) c ON l.target = c.t"
sql_op("rte_2_routes", "SELECT target, symbol, 'very_long' AS tier, cross_state, local_state, CASE WHEN cross_state = 'DISALLOWED' AND local_state = 'DISALLOWED' THEN 'BLOCKED' WHEN cross_state = 'DISALLOWED' THEN 'SYMBOL_SPECIFIC' WHEN local_state = 'DISALLOWED' THEN 'CROSS_SECTIONAL' WHEN 'EXPERIMENTAL' IN (cross_state, local_state) THEN 'EXPERIMENTAL_ONLY' ELSE 'BOTH' END AS route FROM {sides}", {**T, "sides": _SIDES}, by=lambda s, d: routes.symbol_routes(_cross(s, d), _local(s, d), RULES).select("target", "symbol", "tier", "cross_state", "local_state", "route"))


# A run a symbol and year.
def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = lambda c: fn.round(fn.avg(fn.when(c, 1.0).otherwise(0.0)), 9)
    held = features(spark, sf_dir).filter("y IS NOT NULL AND f2 IS NOT NULL").groupBy("symbol", fn.date_trunc("year", "ts").alias("ts"))
    runs = held.agg(rate(fn.col("f2") * fn.col("y") < 0).alias("auc"), rate(fn.col("y") > 0).alias("pos_rate"), fn.count("f3").alias("n_features"))
    return runs.withColumns({"run_id": fn.year("ts").cast("string"), "jaccard": fn.col("auc"), "changed": fn.expr(f"coalesce((auc > 0.7) <> (lag(auc) OVER ({KEY}) > 0.7), FALSE)")})


LIMITS = decisions.Limits(jaccard=0.72, collapse=0.95, changes=2, more_features=2)
_YEARS = "SELECT symbol, year(ts) AS yr, round(avg(CASE WHEN f2 * y < 0 THEN 1.0 ELSE 0.0 END), 9) AS auc, round(avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END), 9) AS pos_rate, count(f3) AS nf FROM {feats} WHERE y IS NOT NULL AND f2 IS NOT NULL GROUP BY 1, 2"
_LAGS = "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY yr DESC) AS back, count(*) OVER (PARTITION BY symbol) AS n_runs, lag(auc) OVER (PARTITION BY symbol ORDER BY yr) AS a1, lag(nf) OVER (PARTITION BY symbol ORDER BY yr) AS nf1, lag(pos_rate, 2) OVER (PARTITION BY symbol ORDER BY yr) AS p2 FROM {years}"
_MOVES = "SELECT symbol AS s, count(*) FILTER (WHERE (auc > 0.7) <> (a1 > 0.7)) AS moves FROM {lags} WHERE back <= 5 GROUP BY symbol"
_LATEST = "SELECT * FROM {lags} JOIN {moves} ON symbol = s WHERE back = 1"
_RULE = lambda name, condition: f"SELECT symbol, n_runs, CAST(yr AS STRING) AS run_id, '{name}' AS rule, CASE WHEN n_runs >= 3 AND ({condition}) THEN 1 ELSE 0 END AS triggered FROM {{latest}}"
sql_op("dec_1_rules", " UNION ALL ".join(_RULE(*a) for a in (("feature_instability", "auc < 0.72 AND auc < a1 * 0.95"), ("route_instability", "moves >= 2"), ("feature_explosion_decline", "auc - a1 < -0.01 AND nf - nf1 > 2"), ("class_balance_drift", "abs(pos_rate - p2) > 0.1"))),
       {**F, "years": _YEARS, "lags": _LAGS, "moves": _MOVES, "latest": _LATEST}, by=lambda s, d: decisions.decisions(_yearly(s, d), ["symbol"], LIMITS).select("symbol", "n_runs", "run_id", "rule", fn.col("triggered").cast("int").alias("triggered")))


# Products over a panel that has the indicators' columns, in ten thousands: their last places depend on the order of adding.
_PRODUCTS = ("adx_x_vol", "cci_x_vol", "macd_x_vol", "macd_x_volume", "macd_x_ret")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = panels.weekly_bars(spark, sf_dir).withColumn("ret_5m", fn.expr(f"close / nullif(lag(close, 5) OVER ({KEY}), 0) - 1"))
    for group in ("FT-21", "FT-23", "FT-17"):
        bars = bars.transform(add_group, group)
    return interactions.with_interactions(bars).select("symbol", "ts", *((fn.col(c) / 10_000).alias(c) for c in _PRODUCTS))


def _products_sql() -> str:
    part = lambda group, c: f"(SELECT symbol, ts, {c} FROM {steps_sql(f'({panels.BARS_W})', panels.BAR_COLUMNS, *CHAINS[group])})"
    macd = f"(SELECT _r.symbol AS symbol, _r.ts AS ts, e12 - e26 AS macd FROM {ewm_sql(f'({panels.BARS_W})', {'e12': ('close', 12), 'e26': ('close', 26)})})"
    base = f"(SELECT symbol, ts, CAST(volume AS DOUBLE) AS v, close / nullif(lag(close, 5) OVER ({KEY}), 0) - 1 AS r FROM ({panels.BARS_W}))"
    cells = {"adx_x_vol": "adx_14 * v", "cci_x_vol": "cci_20 * v", "macd_x_vol": "macd * v", "macd_x_volume": "macd * v", "macd_x_ret": "macd * r"}
    shown = ", ".join(f"{R(f'({e}) / 10000')} + 0.0 AS {c}" for c, e in cells.items())
    return f"SELECT symbol, CAST(ts AS VARCHAR) AS ts, {shown} FROM {base} b JOIN {part('FT-23', 'adx_14')} a USING (symbol, ts) JOIN {part('FT-21', 'cci_20')} c USING (symbol, ts) JOIN {macd} m USING (symbol, ts)"


register("ft_60_indicators", lambda s, d: rounded(_products(s, d)), translated(_products_sql()))


# A ranking of features a symbol and year; those of few rows lack a signature, and those of another number of trades are another universe.
def _rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features(spark, sf_dir).unpivot(["symbol", "ts", "y"], ["f1", "f2", "f3", "f4"], "feature", "x").filter("x IS NOT NULL AND y IS NOT NULL")
    each = long.groupBy("symbol", fn.year("ts").alias("yr"), "feature").agg(fn.round(fn.coalesce(fn.abs(fn.corr("x", "y")), fn.lit(0.0)), 9).alias("importance"), fn.count("*").alias("n"))
    held = each.selectExpr("symbol", "CAST(yr AS STRING) AS run_id", "make_timestamp(yr, 1, 1, 0, 0, 0) AS ts", "feature", "importance", "CASE WHEN yr = 1996 THEN 'odd' ELSE 'whole' END AS universe", "CASE WHEN yr <> 1994 THEN 'v1' END AS data")
    return stability.usable(held, ["symbol"], ["data"]).filter("refused IS NULL")


_RANKS = "SELECT symbol, yr, feature, row_number() OVER (PARTITION BY symbol, yr ORDER BY importance DESC, feature) AS rk FROM (SELECT symbol, year(ts) AS yr, feature, round(coalesce(abs(corr(x, y)), 0.0), 9) AS importance FROM {long} WHERE x IS NOT NULL AND y IS NOT NULL AND year(ts) NOT IN (1994, 1996) GROUP BY 1, 2, 3) q"
_RUNS = "SELECT symbol AS s0, yr AS y1, lag(yr) OVER (PARTITION BY symbol ORDER BY yr) AS y0 FROM (SELECT DISTINCT symbol, yr FROM {ranks}) d"
_ALIKE = "SELECT symbol, y1, y0, count(*) FILTER (WHERE a.rk <= 2 AND b.rk <= 2) / (4.0 - count(*) FILTER (WHERE a.rk <= 2 AND b.rk <= 2)) AS overlap FROM {yearly} r JOIN {ranks} a ON a.symbol = s0 AND a.yr = y1 JOIN {ranks} b USING (symbol, feature) WHERE b.yr = y0 GROUP BY symbol, y1, y0"
_TAUS = "SELECT a.symbol AS s1, y1 AS t1, avg(CASE WHEN (a.rk - c.rk) * (b.rk - d.rk) > 0 THEN 1.0 ELSE -1.0 END) AS tau FROM {yearly} r JOIN {ranks} a ON a.symbol = s0 AND a.yr = y1 JOIN {ranks} b ON b.symbol = s0 AND b.yr = y0 AND b.feature = a.feature JOIN {ranks} c ON c.symbol = s0 AND c.yr = y1 AND c.feature > a.feature JOIN {ranks} d ON d.symbol = s0 AND d.yr = y0 AND d.feature = c.feature GROUP BY 1, 2"
S = {**L, "ranks": _RANKS, "yearly": _RUNS, "alike": _ALIKE, "taus": _TAUS}
sql_op("stb_1_pairs", f"SELECT symbol, CAST(y1 AS STRING) AS run_id, CAST(y0 AS STRING) AS previous_id, {R('overlap')} AS overlap, {R('tau')} AS tau FROM {{alike}} JOIN {{taus}} ON symbol = s1 AND y1 = t1", S, by=lambda s, d: stability.pairs(_rankings(s, d), ["symbol"], 2).select("symbol", "run_id", "previous_id", "overlap", "tau"))
sql_op("stb_1_summary", f"SELECT symbol, count(*) AS n_comparisons, {R('avg(overlap)')} AS mean_overlap, {R('stddev_pop(overlap)')} AS sd_overlap, {R('avg(tau)')} AS mean_tau, {R('stddev_pop(tau)')} AS sd_tau, CASE WHEN avg(overlap) >= 0.75 AND avg(tau) >= 0.65 THEN 'stable' WHEN avg(overlap) < 0.35 THEN 'diverged' ELSE 'drifting' END AS status FROM {{alike}} JOIN {{taus}} ON symbol = s1 AND y1 = t1 GROUP BY symbol", S, by=lambda s, d: stability.summary(stability.pairs(_rankings(s, d), ["symbol"], 2), ["symbol"]))


# Three classes of the label, and probabilities from the last return turned round.
def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    odds = fn.exp(3 * fn.greatest(fn.least(-fn.col("f1"), fn.lit(3.0)), fn.lit(-3.0)))
    rows = features(spark, sf_dir).filter("y IS NOT NULL AND f1 IS NOT NULL").withColumn("c", fn.when(fn.col("y") > 0.1, 2).when(fn.col("y") < -0.1, 0).otherwise(1))
    return evaluation.multiclass(rows.withColumn("p", fn.array(1 / odds, fn.lit(1.0), odds)).withColumn("p", fn.expr("transform(p, v -> v / (p[0] + p[1] + p[2]))")), "c", "p", ["symbol"])


_ODDS = "SELECT symbol, CASE WHEN y > 0.1 THEN 2 WHEN y < -0.1 THEN 0 ELSE 1 END AS c, exp(3 * greatest(least(-f1, 3.0), -3.0)) AS o FROM {feats} WHERE y IS NOT NULL AND f1 IS NOT NULL"
_CHOSEN = "SELECT symbol, c, CASE WHEN o > 1 THEN 2 WHEN o < 1 THEN 0 ELSE 0 END AS q, greatest(least(CASE c WHEN 0 THEN 1 / o WHEN 1 THEN 1.0 ELSE o END / (1 / o + 1 + o), 1 - 1e-8), 1e-8) AS own FROM {odds}"
_F1 = "SELECT symbol AS s, avg(f1) AS macro_f1 FROM (SELECT symbol, k, 2.0 * count(*) FILTER (WHERE c = k AND q = k) / (count(*) FILTER (WHERE c = k) + count(*) FILTER (WHERE q = k)) AS f1 FROM {chosen} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) z WHERE c = k OR q = k GROUP BY symbol, k) w GROUP BY symbol"
sql_op("ev_4_classes", f"SELECT symbol, count(*) AS n, {R('avg(-ln(own))')} AS cross_entropy, {R('avg(CASE WHEN c = q THEN 1.0 ELSE 0.0 END)')} AS accuracy, {R('max(macro_f1)')} AS macro_f1 FROM {{chosen}} JOIN {{ones}} ON symbol = s GROUP BY symbol", {**F, "odds": _ODDS, "chosen": _CHOSEN, "ones": _F1}, by=_classes)


# A run a symbol and month, purged by a number of days that goes with its weeks; its cohort is the year.
def _purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = panels.weekly_bars(spark, sf_dir).groupBy("symbol", fn.date_trunc("month", "ts").alias("at")).agg(fn.count("*").alias("n"), fn.sum("n_trades").alias("trades"))
    held = runs.selectExpr("symbol", "date_format(at, 'yyyy-MM') AS run_id", "at AS ts", "'35d' AS horizon", "concat(n * 9, 'd') AS purge", "CASE WHEN n < 5 THEN 'soon' ELSE '840h' END AS embargo", "CASE WHEN trades % 2 = 0 THEN '40d' END AS lookback", "year(at) AS cohort", "n AS fingerprint", "CAST(trades % 2 AS INT) AS folds", "least(trades / 50, 1.0D) AS score")
    return run_rules.violations(held, ["symbol"])


_MONTHS = "SELECT symbol, date_trunc('month', ts) AS mon, count(*) AS n, CAST(sum(n_trades) AS BIGINT) AS trades FROM {bars_w} GROUP BY 1, 2"
_BEFORE = "SELECT *, substr(CAST(mon AS STRING), 1, 7) AS run_id, lag(n) OVER w AS n0, lag(trades) OVER w AS t0, year(lag(mon) OVER w) = year(mon) AS same FROM {months} WINDOW w AS (PARTITION BY symbol ORDER BY mon)"
_BROKEN = {"purge_below_horizon": ("n * 9 < 35", "critical"), "purge_below_lookback": ("trades % 2 = 0 AND n * 9 < 40", "critical"), "duration_unreadable": ("n < 5", "critical"), "fingerprint_changed": ("same AND n <> n0", "critical"), "folds_changed": ("same AND trades % 2 <> t0 % 2", "warning"), "suspicious_score": ("least(trades / 50.0, 1.0) >= 0.95", "warning")}
sql_op("qa_17_rules", " UNION ALL ".join(f"SELECT symbol, run_id, '{k}' AS rule, '{v}' AS severity FROM {{before}} WHERE {e}" for k, (e, v) in _BROKEN.items()), {"months": _MONTHS, "before": _BEFORE}, by=_purged)
