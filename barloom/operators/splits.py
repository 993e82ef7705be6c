"""Splits of a panel into training and validation rows that any engine repeats: by groups of time, and by a hash of the rows' keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_splits(df: DataFrame, folds: int = 5, purge: int = 17, ts: str = "ts") -> DataFrame:
    """The rows of every split, with test_fold, part (train or val) and purged, the number of groups taken off the training ones' end.

    The groups are the different times; the r-th of them, from 0, is validated in fold r mod folds. Training rows are those of the other groups, but for the
    last `purge` positions of them; where that would leave none, a tenth of the training groups goes, at least one. A fold whose training rows are all
    purged has no rows at all, and rows without a time have no place. Only the table of times is numbered in one place; a row's parts follow from its
    group's number and the number of groups, so no fold is joined."""
    order = Window.orderBy(ts)
    times = df.select(ts).dropna().distinct().select(F.col(ts), (F.row_number().over(order) - 1).alias("_r"), F.count("*").over(Window.partitionBy()).alias("_g"))
    fold, g = F.col("test_fold"), F.col("_g")
    validated = F.when(fold < g, F.floor((g - 1 - fold) / folds) + 1).otherwise(0)
    n_train = g - validated
    last = g - 1 - F.when((g - 1) % folds == fold, 1).otherwise(0)
    taken = F.when(n_train > purge, F.lit(purge)).otherwise(F.greatest(F.lit(1), F.floor(n_train / 10))).cast("int")
    held = df.join(times, ts).withColumn("test_fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).withColumns({"purged": taken, "_last": last - taken})
    own = F.col("_r") % folds == fold
    # a group before the cut that is not the fold's own: group 0, or group 1 where group 0 is
    first = F.when(fold == 0, 1).otherwise(0)
    part = F.when(own, "val").when(F.col("_r") <= F.col("_last"), "train")
    return held.withColumn("part", part).filter(F.col("part").isNotNull() & (first <= F.col("_last")) & (validated > 0)).drop("_r", "_g", "_last")


def hashed(keys: Sequence[str], seed: int) -> Column:
    """A number from 0 to 1, exclusive, out of the first 32 bits of an MD5 of the seed and the keys; a null key is an empty one."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def hash_split(df: DataFrame, keys: Sequence[str], parts: Mapping[str, float], seed: int = 42) -> DataFrame:
    """df with `part`: rows fall by a hash of their keys, so equal keys stay together, and neither order nor partitioning matters. parts: names and shares,
    which add up to 1 (the last one takes what is left). No shuffle."""
    if not parts or abs(sum(parts.values()) - 1) > 1e-9 or min(parts.values()) < 0:
        raise ValueError(f"shares must be positive and add up to 1: {dict(parts)}")
    names, at, bound = list(parts), hashed(keys, seed), 0.0
    part = F.lit(names[-1])
    steps = []
    for name in names[:-1]:
        bound += parts[name]
        steps.append((bound, name))
    for bound, name in reversed(steps):
        part = F.when(at < bound, name).otherwise(part)
    return df.withColumn("part", part)
