"""Metadata of real columns: the names are those of a panel with features and labels, its values are counted, rules run over the names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.portable import apply_steps, steps_sql
from barloom.operators import features, metadata, targets
from barloom.plans.registry import register, rounded, translated
from barloom.sources import panels

GROUPS = ("FT-9", "FT-16", "FT-21", "FT-27", "FT-29", "FT-37", "FT-57", "FT-59")
H = 6  # bars, half an hour of five-minute bars
LABELS = ({"y_will_peak_30m_0.5": "y_will_peak", "y_first_touch_30m_0.5": "y_first_touch"}, {"fwd_ret_30m": "fwd_ret_6", "fwd_ret_2h": "fwd_ret_24"}, {"ret_ord_30m": "ret_ord"}, {"mfe_30m": "mfe"})
CHAINS = (targets.barrier(H), targets.forward_returns((H, 24)), targets.ordinal(H), targets.excursions(H))
TARGETS = [n for names in LABELS for n in names]


def labelled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars with the groups' features and named labels, as a builder makes them."""
    df = reduce(lambda d, g: d.transform(features.add_group, g), GROUPS, panels.weekly_bars(spark, sf_dir))
    for names, chain in zip(LABELS, CHAINS, strict=True):
        made = apply_steps(df, *chain)
        df = made.select(*(F.col(f"`{c}`") for c in df.columns), *(F.col(own).alias(name) for name, own in names.items()))
    return df


def feature_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = labelled_panel(spark, sf_dir)
    return metadata.feature_meta(metadata.names_of(panel, [c for c in metadata.numeric_columns(panel) if c not in panels.BAR_COLUMNS], "feature"))


def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.target_meta(metadata.names_of(labelled_panel(spark, sf_dir), TARGETS, "target"))


def _literal(spark: SparkSession, schema: str, *rows: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({schema})")


def patterns(spark: SparkSession) -> DataFrame:
    return _literal(spark, "pattern", "('^zigzag')", "('_corr')")


def registry(spark: SparkSession) -> DataFrame:
    return _literal(spark, "family, rejected, horizons", "('^(fwd_ret|mfe|tth|y_)', true, array(0))", "('^(rsi|cci)_', false, array(1, 3, 5, 12, 24, 60))", "('^(ret|returns|mom)_', false, array(1, 3, 6, 12))")


# The same panel in SQL: one chain of select lists, every column counted.
_COLUMNS = [c for g in GROUPS for c in features.shown(g)]
_FEATURE_STEPS = [s for g in GROUPS for s in features.CHAINS[g]]
_RENAMED = {n: own for names in LABELS for n, own in names.items()}


def _sql_panel() -> str:
    inner, held = f"({panels.BARS_W})", list(panels.BAR_COLUMNS)
    for group in GROUPS:
        inner = steps_sql(inner, held, *features.CHAINS[group])
        held += [c for c in features.shown(group) if c not in held]
        inner = f"(SELECT {', '.join(held)} FROM {inner})"
    for names, chain in zip(LABELS, CHAINS, strict=True):
        inner = steps_sql(inner, held, *chain)
        inner = f"(SELECT {', '.join(held)}, {', '.join(f'{own} AS \"{n}\"' for n, own in names.items())} FROM {inner})"
        held += [f'"{n}"' for n in names]
    return inner


def _sql_names(column: str, names: list[str]) -> str:
    counted = " UNION ALL ".join(f"SELECT '{n}' AS {column}, count(\"{n}\") AS n_values, count(\"{n}\") / count(*)::DOUBLE AS filled FROM p" for n in names)
    return f"WITH p AS MATERIALIZED (SELECT * FROM {_sql_panel()}), names AS ({counted})"


_AMOUNT = "regexp_extract({0}, '_([0-9]+)([mhd])(_|$)', {1})"
_MINUTES = "CASE WHEN regexp_matches({0}, '_[0-9]+[mhd](_|$)') THEN CAST(" + _AMOUNT.format("{0}", 1) + " AS DOUBLE) * CASE " + _AMOUNT.format("{0}", 2) + " WHEN 'm' THEN 1 WHEN 'h' THEN 60 ELSE 1440 END END"
_F = f"""{_sql_names("feature", [*_COLUMNS, *TARGETS])}, f AS (SELECT feature, n_values, filled,
  CASE WHEN regexp_matches(feature, '{metadata.CALENDAR}') THEN 0.0 ELSE coalesce({_MINUTES.format("feature")}, CAST(nullif(regexp_extract(feature, '_([0-9]+)$', 1), '') AS DOUBLE) * 5, 1440.0) END AS lookback_min,
  regexp_matches(feature, '{metadata.LABELS}') AS is_target, regexp_matches(feature, '{metadata.AHEAD}') AS looks_ahead, regexp_matches(feature, '{metadata.REPAINTED}') AS repaints FROM names)"""
_T = f"""(SELECT target, {_MINUTES.format("target")} AS horizon_min, CASE WHEN target LIKE 'y#_will%' ESCAPE '#' THEN 'binary' WHEN regexp_matches(target, '^(y_first_touch|ret_ord)') THEN 'multiclass' ELSE 'regression' END AS task
  FROM (VALUES {", ".join(f"('{t}')" for t in TARGETS)}) v(target)) t"""
_T_COUNTED = _sql_names("target", TARGETS)


def _ask(spark: SparkSession) -> DataFrame:
    return _literal(spark, "asked", "('fwd_ret_30m')", "('fwd_ret_2h_x')", "('Ret_Ord_30m_SYM')", "('y_will_fly')")


def _targets_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and what they tell, from the schema alone."""
    held = set(labelled_panel(spark, sf_dir).columns)
    return metadata.target_meta(_literal(spark, "target", *(f"('{t}')" for t in TARGETS if t in held)))


register("prj_12", lambda s, d: rounded(target_names(s, d).select("target", "n_values", "filled", "horizon_min", "task")), f"{_T_COUNTED} SELECT target, n_values, round(filled + 3e-8, 6) AS filled, round(horizon_min + 3e-8, 6) AS horizon_min, task FROM names JOIN {_T} USING (target)")
register("prj_12_resolved", lambda s, d: metadata.resolved(_ask(s), target_names(s, d).filter("n_values > 0")), f"{_T_COUNTED} SELECT asked, n.target FROM (VALUES ('fwd_ret_30m', 'fwd_ret_30m'), ('fwd_ret_2h_x', 'fwd_ret_2h'), ('Ret_Ord_30m_SYM', 'ret_ord_30m'), ('y_will_fly', NULL)) a(asked, meant) LEFT JOIN names n ON n.target = meant AND n.n_values > 0")
register("prj_13", lambda s, d: metadata.excluded(feature_names(s, d).filter("n_values > 0"), _targets_only(s, d), patterns(s)), f"""{_F} SELECT target, feature, CASE WHEN is_target THEN 'other_target' WHEN looks_ahead THEN 'looks_ahead' WHEN feature LIKE 'zigzag%' OR contains(feature, '_corr') THEN 'pattern'
  WHEN lookback_min = horizon_min AND starts_with(feature, 'ret') THEN 'overlap' ELSE 'kept' END AS reason FROM f, {_T} WHERE n_values > 0""")
register("prj_14", lambda s, d: metadata.registered(feature_names(s, d).filter("n_values > 0"), registry(s), H), f"""{_F} SELECT feature, family, CASE family WHEN '^(fwd_ret|mfe|tth|y_)' THEN 'rejected' WHEN '^(rsi|cci)_' THEN 'wrong_horizon' WHEN '^(ret|returns|mom)_' THEN 'allowed' ELSE 'unregistered' END AS rule, lag_bars
  FROM (SELECT feature, CAST(ceil(lookback_min / 5) AS BIGINT) AS lag_bars, CASE WHEN regexp_matches(feature, '^(fwd_ret|mfe|tth|y_)') THEN '^(fwd_ret|mfe|tth|y_)' WHEN regexp_matches(feature, '^(ret|returns|mom)_') THEN '^(ret|returns|mom)_' WHEN regexp_matches(feature, '^(rsi|cci)_') THEN '^(rsi|cci)_' END AS family FROM f WHERE n_values > 0) q""")
register("prj_15", lambda s, d: metadata.conditional(feature_names(s, d).filter("n_values > 0"), _targets_only(s, d)), f"{_F} SELECT target, feature, CASE WHEN lookback_min > 4 * horizon_min THEN 'lookback' WHEN repaints AND regexp_matches(target, 'peak|valley|swing') THEN 'repaint' ELSE 'ok' END AS reason FROM f, {_T} WHERE n_values > 0 AND NOT is_target")
register("prj_16", lambda s, d: rounded(feature_names(s, d).select("feature", "n_values", "filled", "lookback_min")), f"{_F} SELECT feature, n_values, round(filled + 3e-8, 6) AS filled, lookback_min FROM f")
register("prj_17", lambda s, d: rounded(metadata.capped_lookback(feature_names(s, d).filter("n_values > 0"), _targets_only(s, d))), f"""{_F}, h AS (SELECT max(lookback_min) FILTER (lookback_min <= 240) AS safe_lookback, count(*) FILTER (lookback_min <= 240) AS n_safe, count(*) FILTER (lookback_min > 240) AS n_quarantined FROM f WHERE n_values > 0 AND NOT is_target)
SELECT target, safe_lookback, n_safe, n_quarantined, safe_lookback + horizon_min AS required_gap FROM h, {_T}""")
register("prj_18", lambda s, d: rounded(metadata.effective_lookback(feature_names(s, d).filter("n_values > 0"))), f"{_F} SELECT feature, lookback_min + 30 AS effective_lookback FROM f WHERE n_values > 0")
register("prj_19", lambda s, d: rounded(metadata.purge_and_embargo(target_names(s, d).filter("n_values > 0"))), f"{_T_COUNTED} SELECT target, horizon_min + 25.0 AS purge_min, horizon_min + 25.0 AS embargo_min FROM names JOIN {_T} USING (target) WHERE n_values > 0")
register("tg_17", lambda s, d: target_names(s, d).select("target", "n_values", "task", "objective", "metric"), f"{_T_COUNTED} SELECT target, n_values, task, CASE task WHEN 'binary' THEN 'logloss' WHEN 'multiclass' THEN 'multi_logloss' ELSE 'rmse' END AS objective, CASE task WHEN 'binary' THEN 'auc' WHEN 'multiclass' THEN 'macro_f1' ELSE 'r2' END AS metric FROM names JOIN {_T} USING (target)")


def _doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of the same columns: the daily sums of events and of hourly bars, joined."""
    bars, events = panels.hourly_bars(spark, sf_dir), panels.hourly_ticks(spark, sf_dir)
    day = F.date_trunc("day", "ts").alias("day")
    left = bars.groupBy("symbol", day).agg(F.sum("n_trades").alias("n_x"), F.max("high").alias("high_x"), F.max("close").alias("last_x"))
    right = events.groupBy("symbol", day).agg(F.count("*").alias("n_y"), F.max("price").alias("high_y"), F.max("price").alias("last_y"))
    return left.join(right, ["symbol", "day"])


register("prj_9", lambda s, d: metadata.duplicate_columns(_doubled(s, d), [("n_x", "n_y"), ("high_x", "high_y"), ("last_x", "last_y")]), f"""WITH b AS (SELECT symbol, date_trunc('day', ts) AS day, sum(n_trades) AS n, max(high) AS high, max(close) AS last FROM ({panels.BARS_H}) GROUP BY 1, 2),
e AS (SELECT event_type AS symbol, date_trunc('day', ts) AS day, count(*) AS n, max(value) AS high FROM events GROUP BY 1, 2), j AS (SELECT b.n AS n_x, e.n AS n_y, b.high AS hx, e.high AS hy, b.last AS lx FROM b JOIN e USING (symbol, day)),
c AS (SELECT 'n_x' AS a, 'n_y' AS b, count(*) FILTER (n_x IS DISTINCT FROM n_y) AS n_conflicts FROM j UNION ALL SELECT 'high_x', 'high_y', count(*) FILTER (hx IS DISTINCT FROM hy) FROM j UNION ALL SELECT 'last_x', 'last_y', count(*) FILTER (lx IS DISTINCT FROM hy) FROM j)
SELECT a, b, n_conflicts, CASE WHEN n_conflicts = 0 THEN 'identical' ELSE 'conflict' END AS verdict FROM c""")
_REQUIRED, _OPTIONAL = ["ts", "close", "volume", "adjusted"], ["ret_x_mom", "vol_x_ret"]
register("prj_10", lambda s, d: metadata.schema_violations(panels.weekly_bars(s, d), _REQUIRED, _OPTIONAL, strict=True), translated(f"""WITH b AS (SELECT * FROM ({panels.BARS_W})) SELECT 'ts' AS column, 'present' AS status, count(ts) AS n_values FROM b UNION ALL SELECT 'close', 'present', count(close) FROM b UNION ALL SELECT 'volume', 'present', count(volume) FROM b
UNION ALL SELECT 'adjusted', 'missing', 0 UNION ALL SELECT 'ret_x_mom', 'optional_missing', 0 UNION ALL SELECT 'vol_x_ret', 'optional_missing', 0 UNION ALL SELECT column_name, 'unexpected', 0 FROM (VALUES ('symbol'), ('open'), ('high'), ('low'), ('vwap'), ('n_trades')) v(column_name)"""))
