"""Labels against features and against their own earlier version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.portable import correlation

CALENDAR = ("hour", "day_of_week", "day_of_month", "month", "year", "is_weekend", "is_holiday", "quarter", "week_of_year")


def near_copies(df: DataFrame, features: Sequence[str], label: str, binary: bool, near: float = 1e-4, least_match: float = 0.999, least_corr: float = 0.99, calendar: Sequence[str] = CALENDAR) -> DataFrame:
    """A row a feature: n rows with a label, match and match_flipped (shares of them within `near` of the label, or of one less it; a null feature doesn't
    match), corr, calendar, and leak. A binary label is leaked by a share of least_match or more either way, any other by an absolute correlation of
    least_corr or more; features whose names hold a calendar word are never leaks. One scan for all features; without labelled rows the shares are null."""
    y, held = F.col(label).cast("double"), df.filter(F.col(label).isNotNull())
    share = lambda x, to: F.avg(F.coalesce(F.abs(x - to) < near, F.lit(False)).cast("int"))
    facts = [F.struct(F.lit(f).alias("feature"), F.count("*").alias("n"), share(F.col(f), y).alias("match"), share(F.col(f), 1 - y).alias("match_flipped"), correlation(f, label).alias("corr")) for f in features]
    rows = held.agg(F.array(*facts).alias("f")).select(F.inline("f"))
    exempt = F.lit(False)
    for word in calendar:
        exempt = exempt | F.lower("feature").contains(word)
    copied = (F.greatest("match", "match_flipped") >= least_match) if binary else (F.abs("corr") >= least_corr)
    return rows.withColumn("calendar", exempt).withColumn("leak", F.coalesce(copied & ~exempt, F.lit(False)))


def label_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], label: str, group: str, examples: int = 10) -> DataFrame:
    """Two versions of a label to a row a group: n_old, n_new (rows of either), only_old, only_new, n_both (rows with a value in both), n_diff, match_rate (null
    where n_both is 0), mean, sd, min, max and count of either version's values over shared keys, and the first differing rows in the order of their keys.

    keys name a row, group is one of them; both versions hold one row a key. Keys meet once, each side reduced to keys and label; a null key meets nothing."""
    side = lambda df, name: df.select(*keys, F.col(label).cast("double").alias(name), F.lit(1).alias(f"has_{name}"))
    rows = side(old, "old").join(side(new, "new"), list(keys), "full")
    shared = F.col("has_old").isNotNull() & F.col("has_new").isNotNull()
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    differs = both & (F.col("old") != F.col("new"))
    stats = [f(F.when(shared, F.col(c))).alias(f"{c}_{n}") for c in ("old", "new") for n, f in (("count", F.count), ("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("max", F.max))]
    counts = rows.groupBy(group).agg(F.count("has_old").alias("n_old"), F.count("has_new").alias("n_new"), F.count_if(F.col("has_new").isNull()).alias("only_old"), F.count_if(F.col("has_old").isNull()).alias("only_new"), F.count_if(both).alias("n_both"), F.count_if(differs).alias("n_diff"), *stats)
    shown = [k for k in keys if k != group]
    # the first rows of a group by number, so that no list of all differences is made
    from_start = rows.filter(differs).selectExpr(group, *shown, "old", "new", f"row_number() OVER (PARTITION BY {group} ORDER BY {', '.join([*shown, 'old', 'new'])}) AS _at").filter(F.col("_at") <= examples)
    listed = from_start.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*shown, "old", "new"))).alias("examples"))
    rate = F.try_divide(F.col("n_both") - F.col("n_diff"), F.col("n_both"))
    return counts.join(listed, group, "left").withColumn("match_rate", rate)
