"""What the names of features and targets tell: horizons, tasks, lookbacks, and what may be used with what.

Names come as DataFrames of one column, feature or target, taken from the schema of a panel; everything here is a row a name or a pair of names.
Minutes are minutes of clock time; a number in a name without a unit counts bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed beginnings of label names; names that need the bars after their own; names that are repainted once later bars are known.
LABELS = r"^(y_|fwd_ret|tth|hit_|ret_ord|ret_zscore|mfe|mdd|p_up|p_down|time_in_profit|flipcount|excess_ret)"
AHEAD = r"^(ichimoku_chikou|fractal_|ret_oc_same_day)"
REPAINTED = r"(zigzag|fractal|swing|peak|valley|psar)"
#: Names of a moment, which look back at nothing.
CALENDAR = r"^(hour_|wd_|month_|quarter|day_|year|is_|trading_day|weekly_|monthly_|quarterly_|intraday_|holiday)"
UNKNOWN_MINUTES = 1440
#: Minutes beyond which a lookback is quarantined; lookbacks over a horizon that a feature may have.
CAP_MINUTES, MOST_HORIZONS = 240, 4
#: Fixed suffixes that joins leave behind a target's name.
JOINED = r"(_x|_y|_SYM)$"


def numeric_columns(panel: DataFrame, ids: tuple[str, ...] = ("symbol", "ts", "interval", "date")) -> list[str]:
    """The panel's columns of numbers that aren't ids."""
    numbers = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in panel.dtypes if c not in ids and (t in numbers or t.startswith("decimal"))]


def names_of(panel: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A row for each column: its name, the number of rows with a value, and their share; one pass over the panel."""
    counted = panel.agg(F.count("*").alias("rows"), *(F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)))
    listed = F.array(*(F.struct(F.lit(c).alias(name), F.col(f"n{i}").alias("n_values")) for i, c in enumerate(columns)))
    return counted.select("rows", F.explode(listed).alias("x")).select(f"x.{name}", "x.n_values", F.try_divide("x.n_values", "rows").alias("filled"))


def minutes_in(name: Column, interval_minutes: float) -> Column:
    """The first amount of time in a name, in minutes: 15m, 2h, 1d; null without one."""
    number, unit = F.regexp_extract(name, "_([0-9]+)([mhd])(?:_|$)", 1), F.regexp_extract(name, "_([0-9]+)([mhd])(?:_|$)", 2)
    return F.when(unit != "", number.cast("double") * F.when(unit == "m", 1).when(unit == "h", 60).otherwise(1440)).cast("double")


def lookback_minutes(name: Column, interval_minutes: float) -> Column:
    """How far a feature looks back: none for names of a moment, its amount of time, its last number of bars, else UNKNOWN_MINUTES."""
    bars = F.regexp_extract(name, "_([0-9]+)$", 1)
    found = F.coalesce(minutes_in(name, interval_minutes), F.when(bars != "", bars.cast("double") * interval_minutes))
    return F.when(name.rlike(CALENDAR), 0.0).otherwise(F.coalesce(found, F.lit(float(UNKNOWN_MINUTES))))


def feature_meta(names: DataFrame, interval_minutes: float = 5.0) -> DataFrame:
    """names(feature, ...) with lookback_min, is_target, looks_ahead and repaints."""
    f = F.col("feature")
    return names.withColumns({"lookback_min": lookback_minutes(f, interval_minutes), "is_target": f.rlike(LABELS), "looks_ahead": f.rlike(AHEAD), "repaints": f.rlike(REPAINTED)})


def target_meta(names: DataFrame, interval_minutes: float = 5.0) -> DataFrame:
    """names(target, ...) with horizon_min, task, objective and metric."""
    t = F.col("target")
    task = F.when(t.rlike("^(y_will|hit_[0-9])"), "binary").when(t.rlike("^(y_first_touch|hit_asym|hit_direction|ret_ord)"), "multiclass").otherwise("regression")
    typed = names.withColumns({"horizon_min": minutes_in(t, interval_minutes), "task": task})
    pick = lambda a, b, c: F.when(F.col("task") == "binary", a).when(F.col("task") == "multiclass", b).otherwise(c)
    return typed.withColumns({"objective": pick("logloss", "multi_logloss", "rmse"), "metric": pick("auc", "macro_f1", "r2")})


def resolved(asked: DataFrame, targets: DataFrame) -> DataFrame:
    """asked(asked) with the target that is meant: the name itself, or the only one that is like it but for case and what joins leave behind."""
    plain = lambda c: F.lower(F.regexp_replace(c, JOINED, ""))
    like = targets.groupBy(plain(F.col("target")).alias("plain")).agg(F.count("*").alias("n"), F.min("target").alias("like"))
    exact = asked.join(targets.select(F.col("target").alias("exact")), F.col("asked") == F.col("exact"), "left")
    both = exact.withColumn("plain", plain(F.col("asked"))).join(like, "plain", "left")
    return both.select("asked", F.coalesce("exact", F.when(F.col("n") == 1, F.col("like"))).alias("target"))


def excluded(features: DataFrame, targets: DataFrame, patterns: DataFrame) -> DataFrame:
    """target, feature, reason for each pair: other_target, looks_ahead, pattern (one of patterns(pattern) matches), overlap (a return over the
    target's own horizon), or kept."""
    hit = features.join(patterns, F.expr("feature rlike pattern"), "left_semi").select(F.col("feature").alias("hit"))
    marked = features.join(hit, F.col("feature") == F.col("hit"), "left")
    both = marked.crossJoin(targets.select("target", "horizon_min"))  # two lists of names
    reason = F.when(F.col("is_target"), "other_target").when(F.col("looks_ahead"), "looks_ahead").when(F.col("hit").isNotNull(), "pattern").when((F.col("lookback_min") == F.col("horizon_min")) & F.col("feature").rlike("^ret"), "overlap").otherwise("kept")
    return both.select("target", "feature", reason.alias("reason"))


def registered(features: DataFrame, registry: DataFrame, horizon_bars: int, interval_minutes: float = 5.0) -> DataFrame:
    """feature, rule against registry(family, rejected, horizons): the first family by name whose pattern matches decides: rejected, allowed at
    this horizon, wrong_horizon; without a family unregistered. lag_bars is what the name's lookback comes to."""
    met = features.join(registry, F.expr("feature rlike family"), "left").groupBy("feature", "lookback_min").agg(F.min(F.struct("family", "rejected", "horizons")).alias("r"))
    rule = F.when(F.col("r.family").isNull(), "unregistered").when(F.col("r.rejected"), "rejected").when(F.array_contains("r.horizons", horizon_bars), "allowed").otherwise("wrong_horizon")
    return met.select("feature", "r.family", rule.alias("rule"), F.ceil(F.col("lookback_min") / interval_minutes).cast("long").alias("lag_bars"))


def conditional(features: DataFrame, targets: DataFrame, most_horizons: float = MOST_HORIZONS) -> DataFrame:
    """target, feature, reason: lookback beyond so many horizons, repaint of a peak or valley target, or ok."""
    both = features.filter(~F.col("is_target")).crossJoin(targets.select("target", "horizon_min"))  # two lists of names
    reason = F.when(F.col("lookback_min") > most_horizons * F.col("horizon_min"), "lookback").when(F.col("repaints") & F.col("target").rlike("peak|valley|swing"), "repaint").otherwise("ok")
    return both.select("target", "feature", reason.alias("reason"))


def capped_lookback(features: DataFrame, targets: DataFrame, cap: float = CAP_MINUTES) -> DataFrame:
    """target, safe_lookback, n_safe, n_quarantined, required_gap: the longest lookback within the cap, and that plus the target's horizon."""
    held = features.filter(~F.col("is_target")).agg(F.max(F.when(F.col("lookback_min") <= cap, F.col("lookback_min"))).alias("safe_lookback"), F.count_if(F.col("lookback_min") <= cap).alias("n_safe"), F.count_if(F.col("lookback_min") > cap).alias("n_quarantined"))
    return targets.crossJoin(held).select("target", "safe_lookback", "n_safe", "n_quarantined", (F.col("safe_lookback") + F.col("horizon_min")).alias("required_gap"))


def effective_lookback(features: DataFrame, embargo_minutes: float = 30.0) -> DataFrame:
    """feature, effective_lookback: the lookback and the embargo after it."""
    return features.select("feature", (F.col("lookback_min") + embargo_minutes).alias("effective_lookback"))


def purge_and_embargo(targets: DataFrame, interval_minutes: float = 5.0, buffer_bars: int = 5) -> DataFrame:
    """target, purge_min, embargo_min: either is the horizon and a buffer of bars; lookbacks are past and need none."""
    both = F.col("horizon_min") + buffer_bars * interval_minutes
    return targets.select("target", both.alias("purge_min"), both.alias("embargo_min"))


def duplicate_columns(panel: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """a, b, n_conflicts, verdict of pairs of columns: one pass; identical ones can be one, conflicting ones are an error."""
    counted = panel.agg(*(F.count_if(~F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"n{i}") for i, (a, b) in enumerate(pairs)))
    listed = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{i}").alias("n_conflicts")) for i, (a, b) in enumerate(pairs)))
    return counted.select(F.explode(listed).alias("x")).select("x.*", F.when(F.col("x.n_conflicts") == 0, "identical").otherwise("conflict").alias("verdict"))


def schema_violations(panel: DataFrame, required: list[str], optional: list[str] = (), strict: bool = False) -> DataFrame:
    """column, status, n_values: required columns that are missing or without a value, optional ones (with _x_ in their names, if none are given)
    that are missing, and in strict mode columns that nobody named."""
    held = {c.lower() for c in panel.columns}
    there = [c for c in required if c.lower() in held]
    status = [(c, "missing") for c in required if c.lower() not in held] + [(c, "optional_missing") for c in optional if c.lower() not in held]
    if strict:
        status += [(c, "unexpected") for c in panel.columns if c not in required and c not in optional and "_x_" not in c]
    counted = names_of(panel, there, "column").select("column", F.when(F.col("n_values") == 0, "empty").otherwise("present").alias("status"), "n_values") if there else None
    gone = panel.sparkSession.range(1).select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), F.lit(0).cast("long").alias("n_values")) for c, s in status))).alias("x")).select("x.*") if status else None
    return counted if gone is None else gone if counted is None else counted.union(gone)
