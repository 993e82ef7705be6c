"""Trends of series of runs: a weighted line, its spread, an exponentially weighted mean, alerts, and breaks of the level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400.0


def _days(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) / (1e6 * DAY)


def trends(runs: DataFrame, series: list[str], value: str, half_life_days: float, now: Column, min_runs: int = 3, steep: float = -0.001, far: float = 2.0) -> DataFrame:
    """A row a series: n_runs, status, slope (a day), intercept (at the first run), estimate (at now), residual_sd, ewma, last, alerts.

    Runs weigh 0.5 ^ (age / half life) by their age at now, and the line is a weighted least-squares one; sums are all that is kept of a series, so
    it may be of any length. ewma follows the runs in order with alpha = 1 - 0.5 ^ (1 / half life). status: `first_run` or `insufficient_runs` below
    min_runs, `no_variance` where the values don't differ, else `ok`; figures are null unless ok. Alerts: `negative_slope` below `steep` a day,
    `unexpected_deviation` where the last value is more than `far` residual deviations from the estimate. Runs without a value or a time don't count.
    """
    alpha = 1 - 0.5 ** (1 / half_life_days)
    order = Window.partitionBy(*series).orderBy("ts")
    held = runs.filter(F.col(value).isNotNull() & ~F.isnan(value) & F.col("ts").isNotNull())
    place = held.withColumn("v", F.col(value).cast("double")).withColumn("first_day", F.min(_days("ts")).over(Window.partitionBy(*series))).withColumn("nth", F.row_number().over(order)).withColumn("back", F.row_number().over(Window.partitionBy(*series).orderBy(F.desc("ts"))) - 1)
    x, w = _days("ts") - F.col("first_day"), F.pow(F.lit(0.5), (F.unix_micros(now) / (1e6 * DAY) - _days("ts")) / half_life_days)
    each = place.withColumn("x", x).withColumn("w", w)
    share = F.when(F.col("nth") == 1, F.pow(F.lit(1 - alpha), F.col("back"))).otherwise(alpha * F.pow(F.lit(1 - alpha), F.col("back")))
    total = {"sw": F.col("w"), "sx": F.col("w") * F.col("x"), "sy": F.col("w") * F.col("v"), "sxx": F.col("w") * F.col("x") * F.col("x"), "sxy": F.col("w") * F.col("x") * F.col("v"), "syy": F.col("w") * F.col("v") * F.col("v"), "ewma": share * F.col("v")}
    sums = each.groupBy(*series).agg(F.count("*").alias("n_runs"), F.stddev_pop("v").alias("sd"), F.first("first_day").alias("first_day"), F.max_by("v", "ts").alias("last"), *(F.sum(e).alias(c) for c, e in total.items()))
    status = F.when(F.col("n_runs") == 1, "first_run").when(F.col("n_runs") < min_runs, "insufficient_runs").when(F.col("sd") < 1e-10, "no_variance").otherwise("ok")
    if min_runs <= 1:
        status = F.when(F.col("sd") < 1e-10, "no_variance").otherwise("ok")
    ok = lambda c: F.when(F.col("status") == "ok", c)
    slope = F.coalesce(F.try_divide(F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx")), F.lit(0.0))
    fit = sums.withColumn("status", status).withColumn("slope", ok(slope)).withColumn("intercept", ok((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("sw")))
    rest = F.greatest((F.col("syy") - F.col("intercept") * F.col("sy") - F.col("slope") * F.col("sxy")) / F.col("sw"), F.lit(0.0))
    fit = fit.withColumn("estimate", F.col("intercept") + F.col("slope") * (F.unix_micros(now) / (1e6 * DAY) - F.col("first_day"))).withColumn("residual_sd", F.sqrt(rest + 1e-12))
    raised = F.array_compact(F.array(F.when(F.col("slope") < steep, "negative_slope"), F.when(F.abs(F.col("last") - F.col("estimate")) > far * F.col("residual_sd"), "unexpected_deviation")))
    return fit.select(*series, "n_runs", "status", "slope", "intercept", "estimate", "residual_sd", ok(F.col("ewma")).alias("ewma"), "last", F.array_join(raised, ",").alias("alerts"))


def breaks(runs: DataFrame, series: list[str], value: str, least_runs: int = 3, least_gain: float = 10.0, rounds: int = 4) -> DataFrame:
    """A row for each break of a series' level: round, nth (the first run behind it), ts, before and after (the means of the pieces beside it), gain.

    Each round looks at every cut of every piece, from prefix sums of the values, and cuts a piece where that lowers the squared error the most, if
    both sides keep least_runs and the gain is least_gain times the error left a run. A round is two windows over a series' runs; up to
    2 ^ rounds - 1 breaks of a series are found. Equal gains are cut first come. Runs without a value or a time don't count.
    """
    held = runs.filter(F.col(value).isNotNull() & ~F.isnan(value) & F.col("ts").isNotNull())
    order = Window.partitionBy(*series).orderBy("ts")
    placed = held.select(*series, "ts", F.col(value).cast("double").alias("v")).withColumn("nth", F.row_number().over(order))
    placed = placed.withColumn("v", F.col("v") - F.first("v").over(order)).withColumn("base", F.lit(0.0)).withColumn("piece", F.lit(1).cast("long"))
    first = held.select(*series, F.col(value).cast("double").alias("base_value"), F.row_number().over(order).alias("r")).filter("r = 1").drop("r")
    found = None
    for k in range(1, rounds + 1):
        own = Window.partitionBy(*series, "piece")
        run = own.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
        n, m = F.count("*").over(own), F.count("*").over(run)
        s, t = F.sum("v").over(own), F.sum("v").over(run)
        sq = F.sum(F.col("v") * F.col("v")).over(own)
        cut = placed.select("*", n.alias("n"), m.alias("m"), s.alias("s"), t.alias("t"), (sq - s * s / n).alias("sse"))
        inside = (F.col("m") >= least_runs) & (F.col("n") - F.col("m") >= least_runs)
        cut = cut.withColumn("drop", F.when(inside, F.col("t") * F.col("t") / F.col("m") + F.pow(F.col("s") - F.col("t"), 2) / (F.col("n") - F.col("m")) - F.col("s") * F.col("s") / F.col("n")))
        left = (F.col("sse") - F.col("drop")) / (F.col("n") - 2)
        gain = F.when(F.col("drop") > 1e-12, F.col("drop") / F.greatest(left, F.lit(1e-12)))
        best = cut.withColumn("gain", gain).filter(F.col("gain") >= least_gain).groupBy(*series, "piece").agg(F.max(F.struct(F.round("gain", 9).alias("g"), (-F.col("nth")).alias("back"), "ts", "gain", (F.col("t") / F.col("m")).alias("before"), ((F.col("s") - F.col("t")) / (F.col("n") - F.col("m"))).alias("after"))).alias("b"))
        best = best.select(*series, "piece", (-F.col("b.back")).alias("cut_at"), F.col("b.ts").alias("cut_ts"), "b.before", "b.after", "b.gain")
        rows = best.select(*series, F.lit(k).alias("round"), F.col("cut_at").alias("nth"), F.col("cut_ts").alias("ts"), "before", "after", "gain")
        found = rows if found is None else found.union(rows)
        side = F.coalesce((F.col("nth") >= F.col("cut_at")).cast("long"), F.lit(0))
        placed = placed.join(best.select(*series, "piece", "cut_at"), [*series, "piece"], "left").withColumn("piece", F.col("piece") * 2 + side).drop("cut_at")
    shifted = found.join(first, series)
    return shifted.select(*series, "round", "nth", "ts", (F.col("before") + F.col("base_value")).alias("before"), (F.col("after") + F.col("base_value")).alias("after"), "gain")


def changes(runs: DataFrame, series: list[str], signature: str) -> DataFrame:
    """A row for each run whose signature differs from that of the run before it in its series: nth, ts, previous, signature. Null ones are no change."""
    order = Window.partitionBy(*series).orderBy("ts")
    held = runs.withColumn("nth", F.row_number().over(order)).withColumn("previous", F.lag(signature).over(order))
    return held.filter((F.col("nth") > 1) & F.col(signature).isNotNull() & ~F.col(signature).eqNullSafe(F.col("previous"))).select(*series, "nth", "ts", "previous", F.col(signature).alias("signature"))
