"""What is wrong with the columns of a frame before a model sees them: all columns in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Beginnings of the names of targets that are probabilities.
PROBABILITIES = ("will_peak", "will_valley", "mdd", "mfe")


def _facts(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """A row a column: name, kind, n, n_missing (null or NaN), n_inf, missing (their share), lo and hi of the values that aren't missing, finite_lo, finite_hi, mean and sd
    (population) of the finite ones."""
    def one(c: str, kind: str) -> Column:
        x = F.col(c).cast("double")
        here = x.isNotNull() & ~F.isnan(x)
        endless = here & (F.abs(x) == float("inf"))
        finite, held = F.when(here & ~endless, x), F.when(here, x)
        missing = F.count_if(~here)
        return F.struct(
            F.lit(c).alias("name"), F.lit(kind).alias("kind"), F.count("*").alias("n"), missing.alias("n_missing"), F.count_if(endless).alias("n_inf"), F.try_divide(missing, F.count("*")).alias("missing"),
            F.min(held).alias("lo"), F.max(held).alias("hi"), F.min(finite).alias("finite_lo"), F.max(finite).alias("finite_hi"), F.avg(finite).alias("mean"), F.stddev_pop(finite).alias("sd"))

    return df.agg(F.array(*(one(c, k) for c, k in kinds.items())).alias("f")).select(F.inline("f"))


def column_report(df: DataFrame, features: Sequence[str] = (), targets: Sequence[str] = (), predictions: Sequence[str] = (), warn_missing: float = 0.1, most_missing: float = 0.5, most_return: float = 2.0) -> DataFrame:
    """_facts() with constant (one value among those that aren't missing), valid, and problems, a sorted list out of: empty, missing (more than warn_missing), mostly_missing
    (a target, more than most_missing), constant (features and targets), infinite, extreme (a forward return's prediction above most_return either way at its largest),
    outside_unit (a probability's prediction below 0 or above 1). Empty columns and targets that are mostly missing or constant aren't valid."""
    kinds = dict.fromkeys(features, "feature") | dict.fromkeys(targets, "target") | dict.fromkeys(predictions, "prediction")
    target, prediction = F.col("kind") == "target", F.col("kind") == "prediction"
    chance = F.lit(False)
    for p in PROBABILITIES:
        chance = chance | F.startswith("name", F.lit(p))
    tests = {
        "empty": F.col("n") == 0, "mostly_missing": target & (F.col("missing") > most_missing), "missing": (F.col("missing") > warn_missing) & ~(target & (F.col("missing") > most_missing)),
        "constant": F.col("constant") & ~prediction, "infinite": F.col("n_inf") > 0, "extreme": prediction & F.startswith("name", F.lit("fwd_ret_")) & (F.abs("finite_hi") > most_return),
        "outside_unit": prediction & chance & ((F.col("finite_lo") < 0) | (F.col("finite_hi") > 1)),
    }
    problems = F.array_sort(F.array_compact(F.array(*(F.when(c, name) for name, c in tests.items()))))
    made = _facts(df, kinds).withColumn("constant", F.coalesce(F.col("lo") == F.col("hi"), F.lit(False))).withColumn("problems", problems)
    return made.withColumn("valid", (F.col("n") > 0) & ~(target & F.arrays_overlap("problems", F.array(F.lit("mostly_missing"), F.lit("constant")))))


def panel_stats(df: DataFrame, features: Sequence[str], target: str, ts: str = "ts") -> DataFrame:
    """A row a feature and the target: name, kind, mean, sd (population), lo and hi of its finite values; and of the panel: n, n_times, per_time, first_ts, last_ts. Two
    aggregates of one row each: the columns', and that of the counts of every time."""
    columns = _facts(df, dict.fromkeys(features, "feature") | {target: "target"}).select("name", "kind", "mean", "sd", F.col("finite_lo").alias("lo"), F.col("finite_hi").alias("hi"))
    times = df.groupBy(ts).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.count(ts).alias("n_times"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return columns.join(F.broadcast(times.withColumn("per_time", F.try_divide("n", "n_times"))), F.lit(True))  # one row
