"""Cross-sections of a panel: as-of alignment, scaling by time, purged folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(base: DataFrame, slow: DataFrame, columns: list[str], delay_minutes: float = 0.0, max_staleness_minutes: float | None = None) -> DataFrame:
    """base with the latest values of slow that are available at its time: a value counts from its own ts plus the delay on, inclusively; older
    than the cap it is NULL. One union and one window over a symbol, so no pair of rows is ever formed, and rows of base stay as many."""
    ts = F.col("ts").cast("timestamp")
    left = base.select(ts.alias("_at"), F.lit(1).alias("_side"), "symbol", F.lit(None).cast("timestamp").alias("_avail"), F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("_row"), *(F.lit(None).cast(slow.schema[c].dataType).alias(c) for c in columns))
    right = slow.select((ts + F.make_dt_interval(mins=F.lit(delay_minutes).cast("int"))).alias("_at"), F.lit(0).alias("_side"), "symbol", *columns).withColumn("_avail", F.col("_at"))
    both = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy("symbol").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(F.col("_side") == 0, F.struct("_avail", *columns)), ignorenulls=True).over(w)
    found = both.withColumn("_held", held).where(F.col("_side") == 1)
    fresh = F.lit(True) if max_staleness_minutes is None else (F.unix_timestamp("_at") - F.unix_timestamp("_held._avail")) <= max_staleness_minutes * 60
    return found.select("_row.*", *(F.when(fresh, F.col(f"_held.{c}")).alias(c) for c in columns))


def resampled(bars: DataFrame, minutes: int) -> DataFrame:
    """Finer bars to bars of so many minutes, cut at whole multiples since the epoch: first open, highest high, lowest low, last close, volume, the mean of
    their vwaps and how many there were. Counts combine before the one shuffle."""
    width = 60 * minutes
    start = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / width) * width)
    return bars.groupBy("symbol", start.alias("at")).agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"), F.avg("vwap").alias("vwap_mean"), F.count("*").alias("n_bars")).withColumnRenamed("at", "ts")


def finite(x: str) -> Column:
    """x, null where it is no number or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.col(x))


def usable_rows(df: DataFrame, features: list[str], label: str, most_missing: float = 0.5) -> DataFrame:
    """df with features and label made finite, without rows that lack the label or more than this share of the features."""
    clean = df.withColumns({c: finite(c) for c in [*features, label]})
    missing = sum((F.col(c).isNull().cast("int") for c in features), F.lit(0))
    return clean.filter(F.col(label).isNotNull() & (missing <= most_missing * len(features)))


def zscore(x: str, least: int = 10) -> Column:
    """x against its cross-section; untouched where that has fewer than `least` values."""
    w = Window.partitionBy("ts")
    sd = F.stddev_pop(x).over(w)
    return F.when(F.count(x).over(w) >= least, (F.col(x) - F.avg(x).over(w)) / F.when(sd == 0, 1.0).otherwise(sd)).otherwise(F.col(x))


def rank_normalised(x: str) -> Column:
    """Rank within the cross-section, ties averaged, over its size."""
    w = Window.partitionBy("ts")
    return F.when(F.col(x).isNotNull(), (F.rank().over(w.orderBy(F.col(x).asc_nulls_last())) + (F.count("*").over(Window.partitionBy("ts", x)) - 1) / 2) / F.count(x).over(w))


def capped(df: DataFrame, per_ts: int) -> DataFrame:
    """At most so many rows a time, chosen by a hash of time and symbol."""
    order = Window.partitionBy("ts").orderBy(F.md5(F.concat(F.col("ts").cast("string"), "symbol")))
    return df.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") <= per_ts).drop("_pick")


def purged_folds(df: DataFrame, folds: int, purge: str) -> tuple[DataFrame, DataFrame]:
    """df with its contiguous fold, and (test_fold, cutoff): train on rows with ts <= cutoff. Rows are numbered by counts of each time, so only
    the table of times, one row each, is sorted in one place; all rows of a time are in one fold."""
    times = df.groupBy("ts").agg(F.count("*").alias("n"))
    order = Window.orderBy("ts")
    placed = times.select("ts", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    fold = placed.select("ts", F.floor(F.col("before") * folds / F.col("total")).cast("int").alias("fold"))
    cuts = fold.groupBy("fold").agg(F.min("ts").alias("start")).select(F.col("fold").alias("test_fold"), (F.col("start") - F.expr(f"INTERVAL {purge}")).alias("cutoff"))
    return df.join(fold, "ts"), cuts


def purged_rows(df: DataFrame, folds: int, purge: str) -> tuple[DataFrame, DataFrame]:
    """As purged_folds(), with folds of equal numbers of rows: a time that straddles two folds is cut between its symbols in order of name. A row's
    number is the count of rows before its time and its place within it."""
    times = df.groupBy("ts").agg(F.count("*").alias("n"))
    order = Window.orderBy("ts")
    placed = times.select("ts", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    place = F.row_number().over(Window.partitionBy("ts").orderBy("symbol")) - 1
    rows = df.join(placed, "ts").withColumn("fold", F.floor((F.col("before") + place) * folds / F.col("total")).cast("int")).drop("before", "total")
    cuts = rows.groupBy("fold").agg(F.min("ts").alias("start")).select(F.col("fold").alias("test_fold"), (F.col("start") - F.expr(f"INTERVAL {purge}")).alias("cutoff"))
    return rows, cuts


def sequences(features: list[str], length: int) -> Column:
    """The last `length` rows of a symbol as an array of arrays; NULL unless all of them are there and hold every feature."""
    w = Window.partitionBy("symbol").orderBy("ts").rowsBetween(-(length - 1), 0)
    rows = F.collect_list(F.array(*features)).over(w)
    return F.when((F.size(rows) == length) & F.forall(rows, lambda r: F.forall(r, lambda v: v.isNotNull())), rows)
