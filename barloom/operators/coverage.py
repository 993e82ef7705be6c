"""What bars a symbol has and whether they can be true: frames of a given length, sessions, sanity of prices and volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _seconds(c: str):
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def by_timeframe(bars: DataFrame, minutes: int, base: int = 5, tie: str = "n_trades") -> DataFrame:
    """bars of `minutes` each, with n_bars (how many were merged) and resampled: a symbol's bars are merged only if two of them are `base` minutes apart or less;
    others, and all bars if `minutes` is the base, are kept as they are. Of bars of one time the first in the order of `tie` counts.

    A symbol is decided on in the window that also finds its repeated times, and all symbols are merged by one aggregate, where bars that stay are groups of one.
    Rows without symbol or ts have no place."""
    own = Window.partitionBy("symbol")
    first = bars.dropna(subset=["symbol", "ts"]).withColumn("_k", F.row_number().over(Window.partitionBy("symbol", "ts").orderBy(F.col(tie).asc_nulls_last(), "open", "high", "low", "close", "volume"))).filter("_k = 1")
    step = first.withColumn("_s", _seconds("ts") - F.lag(_seconds("ts")).over(own.orderBy("ts")))
    merge = F.coalesce(F.min("_s").over(own) <= 60 * base, F.lit(False)) & F.lit(minutes != base)
    width = 60 * minutes
    at = F.when(F.col("resampled"), F.timestamp_seconds(F.floor(_seconds("ts") / width) * width)).otherwise(F.col("ts").cast("timestamp"))
    return step.withColumn("resampled", merge).groupBy("symbol", at.alias("at"), "resampled").agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"), F.count("*").alias("n_bars")).withColumnRenamed("at", "ts")


def step_report(bars: DataFrame, minutes: int, tolerance: float = 0.1) -> DataFrame:
    """A row a symbol: n_steps within a day, n_wrong (those that aren't a whole multiple of `minutes`), n_holes (multiples beyond one) and the first wrong time. A
    caller that asserts refuses symbols with n_wrong."""
    gap = (_seconds("ts") - F.lag(_seconds("ts")).over(Window.partitionBy("symbol").orderBy("ts"))) / 60
    steps = bars.select("symbol", "ts", gap.alias("gap"))
    inside, off = F.col("gap") < 1440, F.abs(F.col("gap") - F.round(F.col("gap") / minutes) * minutes) > tolerance
    wrong = inside & (off | (F.col("gap") < minutes - tolerance))
    return steps.groupBy("symbol").agg(F.count_if(inside).alias("n_steps"), F.count_if(wrong).alias("n_wrong"), F.count_if(inside & ~wrong & (F.col("gap") > minutes + tolerance)).alias("n_holes"), F.min(F.when(wrong, F.col("ts"))).alias("first_wrong"))


def session_coverage(bars: DataFrame, normal: int = 78, early: int = 54, tolerance: int = 2, recent: int = 20, zone: str = "America/New_York") -> DataFrame:
    """A row a symbol: sessions (days in the zone), first_date, last_date, pct_complete and avg_bars over all of them, recent_sessions and pct_recent over the last
    `recent`. A session is complete with as many bars as a normal day or one that closes early, give or take the tolerance; n_early counts the latter."""
    date = F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone))
    days = bars.dropna(subset=["ts"]).groupBy("symbol", date.alias("date")).agg(F.count("*").alias("n"))
    near = lambda size: F.col("n").between(size - tolerance, size + tolerance)
    placed = days.withColumn("back", F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("date").desc())))
    late, complete = F.col("back") <= recent, (near(normal) | near(early)).cast("int")
    return placed.groupBy("symbol").agg(
        F.count("*").alias("sessions"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), (100 * F.avg(complete)).alias("pct_complete"), F.avg("n").alias("avg_bars"),
        F.count_if(~near(normal) & near(early)).alias("n_early"), F.count_if(late).alias("recent_sessions"), (100 * F.avg(F.when(late, complete))).alias("pct_recent"))


def sanity(bars: DataFrame, minutes: int, most_missing: float = 0.05) -> DataFrame:
    """A row a symbol: n rows; how many have a price that isn't positive, a high below low, open or close, a low above open or close, a negative volume, a null
    among all these; n_repeated (rows beyond the first of a time); missing (share of the bars of `minutes` from the first time to the last that aren't there); and
    sane: none of these, and less than most_missing. Rows of one time are counted together before they meet in a symbol."""
    prices = ["open", "high", "low", "close"]
    any_of = lambda f: F.exists(F.array(*prices), f)
    checks = {
        "n_price": any_of(lambda p: p <= 0), "n_high": (F.col("high") < F.greatest("low", "open", "close")), "n_low": (F.col("low") > F.least("open", "close")),
        "n_volume": F.col("volume") < 0, "n_null": F.exists(F.array(*prices, F.col("volume").cast("double")), lambda v: v.isNull()),
    }
    times = bars.groupBy("symbol", "ts").agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in checks.items()))
    by = times.groupBy("symbol").agg(F.sum("n").alias("n"), *(F.sum(k).alias(k) for k in checks), F.sum(F.when(F.col("ts").isNotNull(), F.col("n") - 1).otherwise(F.col("n"))).alias("n_repeated"), F.count("ts").alias("_t"), F.min("ts").alias("_a"), F.max("ts").alias("_z"))
    asked = F.floor((_seconds("_z") - _seconds("_a")) / (60 * minutes)) + 1
    missing = F.greatest(F.lit(0.0), 1 - F.col("_t") / asked)
    clean = sum((F.col(k) for k in (*checks, "n_repeated")), F.lit(0)) == 0
    return by.withColumn("missing", missing).withColumn("sane", clean & F.coalesce(F.col("missing") < most_missing, F.lit(False))).drop("_t", "_a", "_z")
