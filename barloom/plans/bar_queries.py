"""Scans, schema rules, joins, aggregates, sorts and set operations over bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as fn

from barloom.operators import label_checks, panel
from barloom.plans.registry import doubled, register, rounded, sql_op
from barloom.sources import bars, panels
from barloom.sources.scratch import fresh_folder

R = "round({} + 3e-8, 6)".format
NY = "from_utc_timestamp(CAST(ts AS TIMESTAMP), 'America/New_York')"
TS = "CAST(ts AS STRING) AS ts"
ALL = f"symbol, {TS}, {', '.join(f'{R(c)} AS {c}' for c in ('open', 'high', 'low', 'close', 'vwap'))}, volume, n_trades"
KEY = "PARTITION BY symbol ORDER BY ts"


# Scans and sinks: bars are written in the hive layout and read back.
def _written(spark: SparkSession, df: DataFrame, interval: str, by_date: bool) -> str:
    root = fresh_folder(spark, "bars")
    bars.write_bars(df, root, interval, by_date=by_date)
    return root


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written(spark, panels.weekly_bars(spark, sf_dir), "1w", False)
    return bars.scan_bars(spark, root, ["1", "2", "3", "5", "8"], "1w").select(*panels.BAR_COLUMNS)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.load_report(panels.hourly_bars(spark, sf_dir), spark.sql(_ASKED))


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "csv")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.select("event_id", "event_type", "value").write.option("header", True).csv(root)
    return bars.scan_csv(spark, root, "event_id long, event_type string, value double").groupBy(fn.col("event_type")).agg(fn.count("*").alias("n"), fn.sum("value").alias("total"))


def _by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = spark.read.parquet(_written(spark, panels.hourly_bars(spark, sf_dir), "1h", True))
    return back.groupBy(fn.col("symbol").cast("string").alias("symbol"), fn.col("date").cast("string").alias("date")).agg(fn.count("*").alias("n"), fn.sum("close").alias("sum_close"))


def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = panels.weekly_bars(spark, sf_dir).select("symbol", "ts", fn.col("close").alias("close_f"), fn.col("volume").alias("volume_i"), fn.col("volume") * 10_000_000)
    small = bars.narrowed(df.toDF("symbol", "ts", "close_f", "volume_i", "volume_l"))
    root = fresh_folder(spark, "narrow")
    small.write.parquet(root)
    back = spark.read.parquet(root)
    kinds = dict(back.dtypes)
    return back.select("symbol", "ts", fn.round(fn.col("close_f").cast("double"), 3).alias("close_f"), "volume_i", fn.lit(",".join(kinds[c] for c in ("close_f", "volume_i", "volume_l"))).alias("kinds"))


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guard says of bars, of none, and of bars without a close."""
    df, said = panels.weekly_bars(spark, sf_dir), []
    for name, given in (("bars", df), ("none", df.limit(0)), ("no_close", df.drop("close"))):
        try:
            bars.checked(given)
            said.append((name, "writable"))
        except ValueError as e:
            said.append((name, str(e)))
    return df.agg(fn.count("*").alias("n_rows")).crossJoin(spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{a}', '{b.replace(chr(39), '')}')" for a, b in said) + " AS t(what, said)"))


def _versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, labels = fresh_folder(spark, "labels"), panels.weekly_bars(spark, sf_dir).select("symbol", "ts", fn.expr(f"lead(close, 5) OVER ({KEY}) / close - 1 AS fwd_ret_25m"))
    bars.write_labels(labels, root, "v1", {"horizons": "25m", "interval": "5m"})
    bars.write_labels(labels.filter("symbol < '2'"), root, "v2", {"horizons": "25m", "interval": "5m"})
    back = spark.read.parquet(f"{root}/labels").groupBy("symbol", "label_version").agg(fn.count("*").alias("n_rows"), fn.count("fwd_ret_25m").alias("n_labels"), fn.min("ts").alias("first_ts"), fn.max("ts").alias("last_ts"))
    return back.select(fn.col("symbol").cast("string").alias("symbol"), fn.col("label_version").cast("string").alias("label_version"), "n_rows", "n_labels", "first_ts", "last_ts").join(spark.read.parquet(f"{root}/versions").select("label_version", "horizons"), "label_version")


def _rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are made for some symbols, then for all that are left; a rerun finds nothing to do and old label columns give way."""
    root, df = fresh_folder(spark, "rerun"), panels.weekly_bars(spark, sf_dir).withColumn("y_old", fn.lit(1))
    label = lambda d: bars.without_targets(d).withColumn("y_up", fn.expr(f"CASE WHEN lead(close, 5) OVER ({KEY}) > close THEN 1 WHEN lead(close, 5) OVER ({KEY}) IS NOT NULL THEN 0 END"))
    for part in (df.filter("symbol < '2'"), df, df):
        left = bars.not_done(part, root)
        if not left.isEmpty():
            bars.write_bars(label(left), root, "1w", by_date=False)
    return spark.read.parquet(root).groupBy(fn.col("symbol").cast("string").alias("symbol")).agg(fn.count("*").alias("n"), fn.sum("y_up").alias("n_up"))


sql_op("src_1", f"SELECT {ALL} FROM {{bars_w}} WHERE symbol IN ('1', '2', '3', '5', '8')", by=_scan)
sql_op("src_2", f"SELECT {ALL} FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM {{bars_w}} WHERE ts IS NOT NULL) t WHERE rn <= 20", by=lambda s, d: bars.load_panel(panels.weekly_bars(s, d), 20).select(*panels.BAR_COLUMNS))
_ASKED = "SELECT 'view' AS symbol UNION ALL SELECT 'click' UNION ALL SELECT 'purchase' UNION ALL SELECT 'missing' UNION ALL SELECT 'login'"
sql_op("src_3", "SELECT a.symbol, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'file_not_found' WHEN n = 0 THEN 'empty_dataframe' ELSE 'loaded' END AS status FROM {asked} a LEFT JOIN (SELECT symbol, count(*) AS n FROM {bars_h} GROUP BY symbol) c ON a.symbol = c.symbol", {"asked": _ASKED}, by=_report)
sql_op("src_4", "SELECT symbol, count(*) AS n_bars FROM {bars_w} GROUP BY symbol")
sql_op("src_5", "SELECT c_mktsegment AS raw, replace(replace(upper(c_mktsegment), '/', '.'), '-', '.') AS symbol, count(*) AS n FROM {customer} WHERE upper(c_mktsegment) NOT IN ('MACHINERY') GROUP BY 1, 2")
_EPOCH = "SELECT event_id, CAST(floor(unix_timestamp(ts)) AS BIGINT) * CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 1000000000 END AS raw FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM {events}) q"
sql_op("src_6", """SELECT event_id, raw, s AS epoch_s, CASE WHEN s BETWEEN 0 AND 4102444800 THEN 1 ELSE 0 END AS in_range FROM (
SELECT event_id, raw, CAST(floor(CASE WHEN abs(raw) >= 1e18 THEN raw / 1e9 WHEN abs(raw) >= 1e15 THEN raw / 1e6 WHEN abs(raw) >= 1e12 THEN raw / 1e3 ELSE raw / 1.0 END) AS BIGINT) AS s FROM {epochs}) q""", {"epochs": _EPOCH})
sql_op("src_7", f"SELECT event_type, count(*) AS n, {R('sum(value)')} AS total FROM {{events}} GROUP BY event_type", by=_csv)
sql_op("snk_1", f"SELECT symbol, CAST(CAST({NY} AS DATE) AS STRING) AS date, count(*) AS n, {R('sum(close)')} AS sum_close FROM {{bars_h}} GROUP BY 1, 2", by=_by_date)
sql_op("snk_2", f"SELECT symbol, {TS}, {R('round(CAST(CAST(close AS FLOAT) AS DOUBLE), 3)')} AS close_f, volume AS volume_i, 'float,int,bigint' AS kinds FROM {{bars_w}}", by=_narrow)
sql_op("snk_3", "SELECT n_rows, what, said FROM (SELECT count(*) AS n_rows FROM {bars_w}) n CROSS JOIN (SELECT 'bars' AS what, 'writable' AS said UNION ALL SELECT 'none', 'no rows to write' UNION ALL SELECT 'no_close', 'missing columns: [close]') w", by=_guarded)
sql_op("snk_4", f"SELECT symbol, label_version, n_rows, n_labels, CAST(first_ts AS STRING) AS first_ts, CAST(last_ts AS STRING) AS last_ts, '25m' AS horizons FROM (SELECT symbol, count(*) AS n_rows, greatest(count(*) - 5, 0) AS n_labels, min(ts) AS first_ts, max(ts) AS last_ts FROM {{bars_w}} GROUP BY symbol) b JOIN (SELECT 'v1' AS label_version UNION ALL SELECT 'v2') v ON label_version = 'v1' OR symbol < '2'", by=_versioned)
sql_op("snk_5", f"SELECT symbol, count(*) AS n, CAST(sum(CASE WHEN later > close THEN 1 WHEN later IS NOT NULL THEN 0 END) AS BIGINT) AS n_up FROM (SELECT symbol, close, lead(close, 5) OVER ({KEY}) AS later FROM {{bars_w}}) q GROUP BY symbol", by=_rerun)

# Schema rules and filters.
sql_op("prj_1", f"SELECT symbol, {TS}, {R('coalesce(vwap, CASE WHEN volume > 0 THEN (open + high + low + close) / 4 END)')} AS vwap, volume, n_trades, false AS adjusted, '1w' AS interval, 'driver' AS source, false AS is_ext_hours, {R('close * volume')} AS dollar_volume FROM {{bars_w}}")
_FRACTION = "SELECT event_id, event_type AS symbol, ts, value * 10 / (1 + event_id % 4) AS v FROM {events}"
sql_op("prj_2", f"SELECT event_id, {R('v')} AS volume, CASE WHEN abs(v - round(v)) < 1e-6 THEN 'good' ELSE 'quarantine' END AS bucket, CASE WHEN abs(v - round(v)) <= 0.05 THEN CAST(round(v) AS BIGINT) END AS coerced, CAST(floor(v) AS BIGINT) AS volume_int, {R('v - floor(v)')} AS volume_adj FROM {{fractions}}", {"fractions": _FRACTION})
sql_op("prj_3", f"SELECT {ALL} FROM (SELECT *, hour({NY}) * 60 + minute({NY}) AS m, row_number() OVER (PARTITION BY symbol, ts ORDER BY close) AS rn FROM {{bars_h}}) t WHERE rn = 1 AND m >= 570 AND m < 960 AND m % 60 = 0")
sql_op("prj_4", f"SELECT symbol, {TS}, NOT (hour({NY}) * 60 + minute({NY}) BETWEEN 585 AND 960) AS is_ext_hours FROM {{bars_h}}")
_SESSIONS = f"SELECT DISTINCT CAST(ts AS DATE) AS d, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '9' HOUR AS open_at, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '16' HOUR AS close_at FROM {{bars_h}}"
sql_op("prj_5", f"SELECT symbol, CAST(b.ts AS STRING) AS ts, {R('close')} AS close FROM {{bars_h}} b JOIN {{sessions}} s ON CAST(b.ts AS TIMESTAMP) - INTERVAL '1' HOUR >= s.open_at AND b.ts <= s.close_at AND CAST(b.ts AS DATE) = s.d", {"sessions": _SESSIONS})
_FEATS = f"SELECT symbol, ts, close, volume, close / nullif(lag(close) OVER ({KEY}), 0) - 1 AS f1, close / nullif(lag(close, 5) OVER ({KEY}), 0) - 1 AS f2, volume / nullif(avg(volume) OVER ({KEY} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS f3, (high - low) / nullif(close, 0) AS f4, lead(close, 5) OVER ({KEY}) / close - 1 AS y FROM {{bars_w}}"
F = {"feats": _FEATS}
# Every fifth week's returns are infinite here, every seventh's no numbers.
_BROKEN = "SELECT symbol, ts, CASE WHEN w % 5 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE y END AS y, CASE WHEN w % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE f1 END AS f1, CASE WHEN w % 7 = 0 THEN -CAST('Infinity' AS DOUBLE) ELSE f2 END AS f2, f3, f4 FROM (SELECT *, CAST(floor(unix_timestamp(CAST(ts AS TIMESTAMP)) / 604800.0) AS BIGINT) AS w FROM {feats}) q"


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = spark.sql(doubled(_BROKEN), feats=spark.sql(doubled(_FEATS), bars_w=panels.weekly_bars(spark, sf_dir)))
    return panel.usable_rows(broken, ["f1", "f2", "f3", "f4"], "y").select("symbol", "ts", "y", "f1", "f2")


sql_op("prj_6", f"SELECT symbol, {TS}, {R('y')} AS y, {R('g1')} AS f1, {R('g2')} AS f2 FROM (SELECT *, CASE WHEN isfinite(f1) THEN f1 END AS g1, CASE WHEN isfinite(f2) THEN f2 END AS g2 FROM {{broken}}) c WHERE isfinite(y) AND (g1 IS NULL)::INT + (g2 IS NULL)::INT + (f3 IS NULL)::INT + (f4 IS NULL)::INT <= 2", {**F, "broken": _BROKEN}, by=_usable)
_LONG = " UNION ALL ".join(f"SELECT symbol, ts, '{f}' AS feature, {f} AS x, y FROM {{feats}}" for f in ("f1", "f2", "f3", "f4"))
L = {**F, "long": _LONG}
sql_op("prj_7", "SELECT feature, count(x) AS n_values FROM {long} WHERE feature NOT LIKE 'y%' GROUP BY feature HAVING count(x) > 0", L)
sql_op("prj_8", f"SELECT feature, {R('avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_ratio FROM {{long}} GROUP BY feature HAVING avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) <= 0.3", L)
sql_op("prj_11", "SELECT symbol, count(*) FILTER (WHERE close <= 0 OR open <= 0) AS bad_price, count(*) FILTER (WHERE high < low) AS bad_range, count(*) FILTER (WHERE high < open OR high < close) AS bad_high, count(*) FILTER (WHERE low > open OR low > close) AS bad_low, count(*) FILTER (WHERE volume < 0) AS bad_volume, count(*) - count(DISTINCT ts) AS dup_ts FROM {bars_w} GROUP BY symbol")

# Joins.
def _asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = panels.hourly_bars(spark, sf_dir)
    slow = base.withColumn("rn", fn.expr(f"row_number() OVER ({KEY})")).filter("rn % 6 = 0").select("symbol", "ts", fn.col("close").alias("slow_close"), (fn.col("ts").cast("timestamp") + fn.expr("INTERVAL 30 MINUTES")).alias("avail"))
    joined = panel.asof_join(base.select("symbol", "ts"), slow, ["slow_close", "avail"], delay_minutes=30)
    fresh = fn.col("ts").cast("timestamp") - fn.col("avail") <= fn.expr("INTERVAL 12 HOURS")
    return joined.select("symbol", "ts", fn.when(fresh, fn.col("slow_close")).alias("slow_close"), "avail")


def _old_and_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two labels, each made from bars of its own."""
    label = lambda more: panels.weekly_bars(spark, sf_dir).selectExpr("symbol", "ts", f"CASE WHEN lead(close, 5) OVER ({KEY}) > close * {more} THEN 1 ELSE 0 END AS y")
    found = label_checks.label_changes(label("1D"), label("1.01D"), ["symbol", "ts"], "y", "symbol", 0)
    return found.select("symbol", fn.col("n_both").alias("n"), "n_diff", "match_rate")


_SLOW = "SELECT symbol, ts, close AS slow_close, CAST(ts AS TIMESTAMP) + INTERVAL '30' MINUTE AS avail FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM {bars_h}) q WHERE rn % 6 = 0"
_TAGGED = "SELECT symbol, avail AS at_ts, 0 AS side, slow_close, avail FROM {slow} UNION ALL SELECT symbol, CAST(ts AS TIMESTAMP), 1, NULL, NULL FROM {bars_h}"
_FILLED = "SELECT symbol, at_ts, side, last_value(slow_close) IGNORE NULLS OVER (PARTITION BY symbol ORDER BY at_ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v, last_value(avail) IGNORE NULLS OVER (PARTITION BY symbol ORDER BY at_ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS avail FROM {tagged}"
sql_op("jn_1", f"SELECT symbol, CAST(at_ts AS STRING) AS ts, CASE WHEN at_ts - avail <= INTERVAL '12' HOUR THEN {R('v')} END AS slow_close, CAST(avail AS STRING) AS avail FROM {{filled}} WHERE side = 1", {"slow": _SLOW, "tagged": _TAGGED, "filled": _FILLED}, by=_asof)
sql_op("jn_2", f"SELECT b.symbol, CAST(b.ts AS STRING) AS ts, {R('b.close')} AS close, {R('s.slow_close')} AS slow_close FROM {{bars_h}} b LEFT JOIN {{slow}} s ON b.symbol = s.symbol AND b.ts = s.ts", {"slow": _SLOW})
_OLDNEW = f"SELECT symbol, ts, CASE WHEN lead(close, 5) OVER ({KEY}) > close THEN 1 ELSE 0 END AS old_label, CASE WHEN lead(close, 5) OVER ({KEY}) > close * 1.01 THEN 1 ELSE 0 END AS new_label FROM {{bars_w}}"
sql_op("jn_3", f"SELECT o.symbol, count(*) AS n, CAST(sum(CASE WHEN o.old_label = n.new_label THEN 0 ELSE 1 END) AS BIGINT) AS n_diff, {R('avg(CASE WHEN o.old_label = n.new_label THEN 1.0 ELSE 0.0 END)')} AS match_rate FROM {{labels2}} o JOIN {{labels2}} n ON o.symbol = n.symbol AND o.ts = n.ts GROUP BY o.symbol", {"labels2": _OLDNEW}, by=_old_and_new)
sql_op("jn_4", f"SELECT n_name, count(*) AS n_suppliers, {R('sum(s_acctbal)')} AS acctbal FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey GROUP BY n_name")
sql_op("jn_5", "SELECT s.symbol, CAST(t.ts AS STRING) AS ts FROM (SELECT DISTINCT symbol FROM {bars_h}) s CROSS JOIN (SELECT DISTINCT ts FROM {bars_h}) t")
sql_op("jn_6", f"SELECT symbol, {TS}, {R('close - avg(close) OVER (PARTITION BY ts)')} AS dev, count(*) OVER (PARTITION BY ts) AS n_symbols FROM {{bars_h}}")
sql_op("jn_7", f"SELECT symbol, {TS} FROM {{bars_h}} b WHERE EXISTS (SELECT 1 FROM (SELECT ts AS k FROM {{bars_h}} GROUP BY ts HAVING count(*) >= 5) g WHERE g.k = b.ts)")
sql_op("jn_8", "SELECT s_suppkey FROM {supplier} WHERE NOT EXISTS (SELECT 1 FROM {lineitem} WHERE l_suppkey = s_suppkey AND l_quantity > 49)")

# Aggregates.
_DAY = "SELECT symbol, CAST(ts AS DATE) AS d, count(*) AS n FROM {bars_h} GROUP BY 1, 2"
D = {"days": _DAY}
_OHLC = f"min_by(open, ts) AS open, max(high) AS high, min(low) AS low, max_by(close, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume"
_DAILY = f"SELECT symbol, date_trunc('day', ts) AS ts, {_OHLC}, avg(vwap) AS vwap, min_by(n_trades, ts) AS first_trades FROM {{bars_h}} GROUP BY 1, 2"
_SHOW = f"symbol, {TS}, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, {R('close')} AS close, volume"
sql_op("ag_1", f"SELECT {_SHOW}, first_trades FROM {{daily}}", {"daily": _DAILY})
register("ag_2", lambda s, d: rounded(panel.resampled(panels.ticks_to_bars(panels.hourly_ticks(s, d), "minute"), 15)), f"""SELECT symbol, CAST(time_bucket(INTERVAL 15 MINUTE, ts) AS VARCHAR) AS ts, round(first(open ORDER BY ts) + 3e-8, 6) AS open, round(max(high) + 3e-8, 6) AS high,
  round(min(low) + 3e-8, 6) AS low, round(last(close ORDER BY ts) + 3e-8, 6) AS close, CAST(sum(volume) AS BIGINT) AS volume, round(avg(vwap) + 3e-8, 6) AS vwap_mean, count(*) AS n_bars FROM ({panels.BARS_M}) GROUP BY symbol, time_bucket(INTERVAL 15 MINUTE, ts)""")
sql_op("ag_3", f"SELECT {_SHOW} FROM (SELECT symbol, date_trunc('day', ts) AS ts, {_OHLC} FROM (SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY close) AS rn FROM {{bars_h}}) q WHERE rn = 1 GROUP BY 1, 2) z")
sql_op("ag_4", f"SELECT {ALL} FROM {{bars_w}}")
sql_op("ag_5", f"SELECT symbol, count(*) AS n_days, {R('avg(CASE WHEN n >= 20 THEN 1.0 ELSE 0.0 END)')} AS full_share FROM {{days}} GROUP BY symbol", D)
sql_op("ag_6", f"SELECT symbol, count(*) AS sessions, CAST(min(d) AS STRING) AS first_date, CAST(max(d) AS STRING) AS last_date, {R('avg(CASE WHEN n BETWEEN 20 AND 24 THEN 1.0 ELSE 0.0 END)')} AS complete_all, {R('avg(CASE WHEN rn <= 20 THEN CASE WHEN n BETWEEN 20 AND 24 THEN 1.0 ELSE 0.0 END END)')} AS complete_last20, {R('avg(n)')} AS bars_per_day FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY d DESC) AS rn FROM {{days}}) q GROUP BY symbol", D)
# The nearest of the counts, not one between them.
sql_op("ag_7", f"SELECT symbol, {R('avg(n)')} AS mean_bars, {R('percentile_disc(0.1) WITHIN GROUP (ORDER BY n)')} AS p10, {R('percentile_disc(0.9) WITHIN GROUP (ORDER BY n)')} AS p90 FROM {{days}} GROUP BY symbol", D)
sql_op("ag_8", f"SELECT q.symbol, max(expected) AS expected, {R('avg(CASE WHEN n >= expected - 2 THEN 1.0 ELSE 0.0 END)')} AS complete FROM {{days}} q JOIN (SELECT symbol, least(greatest(n, 10), 24) AS expected FROM (SELECT symbol, n, row_number() OVER (PARTITION BY symbol ORDER BY count(*) DESC, n DESC) AS rn FROM {{days}} GROUP BY symbol, n) m WHERE rn = 1) e ON q.symbol = e.symbol GROUP BY q.symbol", D)
sql_op("ag_9", "SELECT CASE WHEN abs(v - round(v)) < 1e-6 THEN 'whole' WHEN abs(v - floor(v) - 0.5) < 0.02 THEN 'half' WHEN abs(v - floor(v) - 1.0 / 3) < 0.02 OR abs(v - floor(v) - 2.0 / 3) < 0.02 THEN 'third' WHEN abs(v - floor(v) - 0.25) < 0.02 OR abs(v - floor(v) - 0.75) < 0.02 THEN 'quarter' ELSE 'other' END AS bucket, count(*) AS n FROM {fractions} GROUP BY 1", {"fractions": _FRACTION})
sql_op("ag_10", "SELECT CAST(ts AS STRING) AS ts, count(*) AS n, count(DISTINCT symbol) AS n_symbols FROM {bars_w} GROUP BY ts HAVING count(*) >= 10")
sql_op("ag_11", f"SELECT CAST(ts AS STRING) AS ts, {R('percentile(f1, 0.01)')} AS lo, {R('percentile(f1, 0.99)')} AS hi, {R('avg(f1)')} AS mean, {R('stddev_samp(f1)')} AS sd FROM {{feats}} WHERE f1 IS NOT NULL GROUP BY ts", F)
sql_op("ag_12", f"SELECT feature, count(*) AS samples, count(DISTINCT ts) AS n_ts, {R('count(*) / (1.0 * count(DISTINCT ts))')} AS per_ts, {R('avg(x)')} AS mean, {R('stddev_pop(x)')} AS sd, {R('min(x)')} AS lo, {R('max(x)')} AS hi FROM {{long}} GROUP BY feature", L)
_LAB = "SELECT 'up' AS target, symbol, ts, CASE WHEN y > 0 THEN 1.0 WHEN y IS NOT NULL THEN 0.0 END AS label FROM {feats} UNION ALL SELECT 'big', symbol, ts, CASE WHEN y > 0.5 THEN 1.0 WHEN y IS NOT NULL THEN 0.0 END FROM {feats} UNION ALL SELECT 'ret', symbol, ts, y FROM {feats} UNION ALL SELECT 'flat', symbol, ts, 0 * y FROM {feats}"
B = {**F, "labelled": _LAB}
sql_op("ag_13", f"SELECT target, count(label) AS n, count(DISTINCT label) AS n_values, {R('stddev_samp(label)')} AS sd, CASE WHEN count(label) < 100 THEN 'few' WHEN count(DISTINCT label) = 1 THEN 'single' WHEN stddev_samp(label) < 1e-6 THEN 'flat' ELSE 'ok' END AS screen FROM {{labelled}} GROUP BY target", B)
sql_op("ag_14", "SELECT target, min(n) AS smallest, CASE WHEN min(n) >= 5 THEN 1 ELSE 0 END AS cv_ok FROM (SELECT target, label, count(*) AS n FROM {labelled} WHERE label IS NOT NULL AND target <> 'ret' GROUP BY target, label) q GROUP BY target", B)
sql_op("ag_15", "SELECT target, CASE WHEN count(DISTINCT label) <= 2 AND min(label) >= 0 AND max(label) <= 1 THEN 'binary' WHEN count(DISTINCT label) <= 10 AND max(abs(label - floor(label))) = 0 THEN 'multiclass' ELSE 'regression' END AS task FROM {labelled} WHERE label IS NOT NULL GROUP BY target", B)
# A group of zeros of both signs has one label, 0.0.
sql_op("ag_16", f"SELECT target, label + 0.0 AS label, n, {R('1.0 * sum(n) OVER (PARTITION BY target) / (count(*) OVER (PARTITION BY target) * n)')} AS weight, CAST(dense_rank() OVER (PARTITION BY target ORDER BY label) - 1 AS INT) AS code FROM (SELECT target, label, count(*) AS n FROM {{labelled}} WHERE label IS NOT NULL AND target <> 'ret' GROUP BY target, label) q", B)
