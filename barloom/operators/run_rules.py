"""Rules that a run has to keep, by itself and against the run before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNITS = {"d": 1440.0, "h": 60.0, "m": 1.0, "s": 1 / 60}
#: Spark alone would read 2d as the double 2.
_NUMBER = r"^\s*[-+]?\d+(\.\d+)?([eE][-+]?\d+)?\s*$"
_DURATION = r"^\s*(\d+(\.\d+)?[dhms]\s*)+$"


def duration_minutes(text: Column) -> Column:
    """Minutes of a number of them, or of a text such as 85.0m, 1h30m or 2d; null where it can't be read."""
    parts = [F.aggregate(F.regexp_extract_all(text, F.lit(rf"(\d+(?:\.\d+)?){u}"), F.lit(1)), F.lit(0.0), lambda a, x: a + x.cast("double")) * k for u, k in _UNITS.items()]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.when(text.rlike(_NUMBER), text.try_cast("double")).when(text.rlike(_DURATION), total)


def violations(runs: DataFrame, series: list[str], suspicious: float = 0.95) -> DataFrame:
    """runs(*series, run_id, ts, horizon, purge, embargo, lookback, cohort, fingerprint, folds, score) to a row a broken rule: *series, run_id, rule, severity.

    The first four are numbers of minutes or texts (duration_minutes); a rule whose values are null is kept. critical: purge or embargo below the horizon,
    purge below the lookback, a duration that can't be read, and data of another fingerprint than the run before had in the same cohort. warning: other
    folds than that run, and a score of `suspicious` or more. Runs of a series follow by ts, then id."""
    w = Window.partitionBy(*series).orderBy("ts", "run_id")
    m = {c: duration_minutes(F.col(c).cast("string")) for c in ("horizon", "purge", "embargo", "lookback")}
    unread = F.lit(False)
    for c, v in m.items():
        unread = unread | (F.col(c).isNotNull() & v.isNull())
    same = F.col("cohort") == F.lag("cohort").over(w)
    rules = {
        "purge_below_horizon": (m["purge"] < m["horizon"], "critical"), "embargo_below_horizon": (m["embargo"] < m["horizon"], "critical"), "purge_below_lookback": (m["purge"] < m["lookback"], "critical"),
        "duration_unreadable": (unread, "critical"), "fingerprint_changed": (same & (F.col("fingerprint") != F.lag("fingerprint").over(w)), "critical"), "folds_changed": (same & (F.col("folds") != F.lag("folds").over(w)), "warning"),
        "suspicious_score": ((F.col("score") >= suspicious) & ~F.isnan(F.col("score").cast("double")), "warning"),
    }
    told = F.array_compact(F.array(*(F.when(broken, F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))) for name, (broken, severity) in rules.items())))
    return runs.withColumn("_told", told).select(*series, "run_id", F.inline("_told"))
