"""Evaluation of scores and predictions: exact ranks and quantiles without one task for all rows, AUC, fingerprints, recomputed labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.portable import correlation
from barloom.sources.scratch import fresh_folder

#: Buckets of a series' values, and the share of rows on either side of a quantile that are looked at exactly.
BUCKETS = 64
BRACKET = 1e-4
#: A bracket of more rows is bracketed again before its values are put in order.
MOST_ORDERED = 1_000_000


def _staged(df: DataFrame) -> DataFrame:
    """The same rows, written once and read again, so that what made them isn't run by every pass."""
    spark = df.sparkSession
    folder = fresh_folder(spark, "column")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def exact_quantile(df: DataFrame, x: Column, p: float) -> float | None:
    """The interpolated quantile of all values; null values don't count. The column is staged once."""
    return _quantile(_staged(df.select(x.cast("double").alias("x")).filter(F.col("x").isNotNull())), p)


def _quantile(held: DataFrame, p: float) -> float | None:
    """Of x, which has no nulls: an approximate quantile brackets the rank, and the bracket is bracketed again until few enough rows lie in it, or one value. Rows below are
    only counted; the different values of the last bracket alone are put in order."""
    found = held.agg(_around(p), F.count("*").alias("n")).first()
    total = found["n"]
    if not total:
        return None
    (low, high), place = found["b"], p * (total - 1)
    wanted = [int(place), min(int(place) + 1, total - 1)]
    while True:
        near = F.col("x").between(low, high)
        seen = held.agg(F.count_if(F.col("x") < low).alias("below"), F.count_if(near).alias("inside"), F.max(F.when(F.col("x") < low, F.col("x"))).alias("l"), F.min(F.when(F.col("x") > high, F.col("x"))).alias("h")).first()
        below, inside = seen["below"], seen["inside"]
        if below > wanted[0] or below + inside <= wanted[1]:  # a rank beside the bracket: its nearest neighbours on either side come in
            low, high = low if seen["l"] is None else seen["l"], high if seen["h"] is None else seen["h"]
            continue
        if inside > MOST_ORDERED and low < high:
            at = [(w - below) / inside for w in wanted]
            inner = held.filter(near).agg(_around(*at)).first()["b"]
            if inner[0] > low or inner[-1] < high:
                low, high = inner[0], inner[-1]
                continue
        counts = held.filter(near).groupBy("x").agg(F.count("*").alias("n"))
        ranked = counts.withColumn("end", F.lit(below) + F.sum("n").over(Window.orderBy("x"))).withColumn("start", F.col("end") - F.col("n"))
        hit = ranked.filter(" OR ".join(f"(start <= {k} AND {k} < end)" for k in wanted)).collect()  # two values at most
        values = {k: r["x"] for r in hit for k in wanted if r["start"] <= k < r["end"]}
        return values[wanted[0]] + (values[wanted[1]] - values[wanted[0]]) * (place - wanted[0])


def _around(*ps: float) -> Column:
    return F.percentile_approx("x", F.array(F.lit(max(0.0, min(ps) - BRACKET)), F.lit(min(1.0, max(ps) + BRACKET))), 100_000).alias("b")


def exact_quantiles(df: DataFrame, columns: list[str], ps: list[float]) -> dict[tuple[str, float], float | None]:
    """The interpolated quantiles of all values of many columns, in three scans of the staged columns whatever the number of columns and quantiles; nulls don't count.

    One scan brackets every quantile approximately, one counts the values below each bracket, and one counts the different values inside, which alone
    are put in order, a bracket at a time. A quantile whose rank lies beside its bracket after all, or with too many rows in it, is found as by exact_quantile()."""
    held = _staged(df.select(*(F.col(c).cast("double").alias(c) for c in columns)))
    edges = F.array(*(F.lit(e) for p in ps for e in (max(0.0, p - BRACKET), min(1.0, p + BRACKET))))
    row = held.agg(*(F.percentile_approx(c, edges, 100_000).alias(f"b{i}") for i, c in enumerate(columns)), *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns))).first()
    asked = [(i, c, k, p, row[f"b{i}"][2 * k], row[f"b{i}"][2 * k + 1]) for i, c in enumerate(columns) if row[f"n{i}"] for k, p in enumerate(ps)]
    out: dict[tuple[str, float], float | None] = {(c, p): None for c in columns for p in ps}
    if not asked:
        return out
    below = held.agg(*(F.count_if(F.col(c) < low).alias(f"l{i}_{k}") for i, c, k, _, low, _ in asked), *(F.count_if(F.col(c).between(low, high)).alias(f"m{i}_{k}") for i, c, k, _, low, high in asked)).first()
    few = [a for a in asked if below[f"m{a[0]}_{a[2]}"] <= MOST_ORDERED]  # the others are bracketed again below
    inside = F.array_compact(F.array(*(F.when(F.col(c).between(low, high), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), F.col(c).alias("x"))) for i, c, k, _, low, high in few), F.lit(None).cast("struct<i:int,k:int,x:double>")))
    counts = held.select(F.explode(inside).alias("v")).groupBy("v.i", "v.k", "v.x").agg(F.count("*").alias("n"))
    wanted = {(i, k): p * (row[f"n{i}"] - 1) for i, _, k, p, _, _ in asked}
    ranked = counts.withColumn("end", F.sum("n").over(Window.partitionBy("i", "k").orderBy("x")))
    place = lambda at: F.element_at(F.create_map(*(F.lit(x) for (i, k), w in wanted.items() for x in (f"{i},{k}", at(w, i, k)))), F.concat_ws(",", "i", "k"))
    first = place(lambda w, i, k: int(w) - below[f"l{i}_{k}"])
    second = place(lambda w, i, k: min(int(w) + 1, row[f"n{i}"] - 1) - below[f"l{i}_{k}"])
    holds = lambda c: (F.col("end") - F.col("n") <= c) & (c < F.col("end"))
    found: dict[tuple[int, int, int], float] = {}
    for r in ranked.withColumn("first", holds(first)).withColumn("second", holds(second)).filter("first OR second").collect():  # two values a quantile at most
        found |= {(r["i"], r["k"], w): r["x"] for w, on in ((0, r["first"]), (1, r["second"])) if on}
    for i, c, k, p, _, _ in asked:
        if (i, k, 0) in found and (i, k, 1) in found:
            low, high = found[i, k, 0], found[i, k, 1]
            out[c, p] = low + (high - low) * (wanted[i, k] - int(wanted[i, k]))
        else:
            out[c, p] = _quantile(held.select(F.col(c).alias("x")).filter("x IS NOT NULL"), p)
    return out


def fences(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """df and inside: are all of these columns within `reach` interquartile ranges of their quartiles? A null value is no outlier, a column without
    values has none."""
    q = exact_quantiles(df, columns, [0.25, 0.75])
    out = F.lit(True)
    for c in columns:
        low, high = q[c, 0.25], q[c, 0.75]
        if low is not None:
            out = out & F.coalesce(F.col(c).between(low - reach * (high - low), high + reach * (high - low)), F.lit(True))
    return df.withColumn("inside", out)


def without_extremes(df: DataFrame, label: str, sigmas: float = 5.0, least_kept: float = 0.8) -> DataFrame:
    """df without rows whose label is more than `sigmas` standard deviations from its mean, if more than least_kept of the labelled rows stay; else df.
    Rows without a label stay. Two scans of the label."""
    a = df.agg(F.avg(label).alias("m"), F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
    if not a["n"]:
        return df
    near = F.abs(F.col(label) - a["m"]) <= sigmas * a["s"]
    stay = df.agg(F.count_if(near)).first()[0]
    return df.filter(near | F.col(label).isNull()) if stay > least_kept * a["n"] else df


def auc(df: DataFrame, by: str, x: str, positive: Column) -> DataFrame:
    """by, auc, n: the share of pairs of a positive and a negative row that x orders rightly, ties half. Values are dealt into BUCKETS near-equal
    buckets of each series; counts before a bucket and within it add up to exact ranks, so no task holds a series."""
    counts = df.select(by, F.col(x).alias("x"), positive.cast("int").alias("pos")).filter("x IS NOT NULL AND pos IS NOT NULL").groupBy(by, "x").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))
    bounds = counts.groupBy(F.col(by).alias("series_of_bounds")).agg(F.percentile_approx("x", F.array(*(F.lit(i / BUCKETS) for i in range(1, BUCKETS))), 10_000).alias("bounds"))
    dealt = counts.join(bounds, F.col(by) == F.col("series_of_bounds")).select(by, "x", "n", "pos", F.size(F.filter("bounds", lambda b: b < F.col("x"))).alias("bucket"))
    order = Window.partitionBy(by, "bucket").orderBy("x")
    inner = dealt.withColumn("neg", F.col("n") - F.col("pos")).withColumn("before", F.sum("neg").over(order) - F.col("neg"))
    parts = inner.groupBy(by, "bucket").agg(F.sum(F.col("pos") * (F.col("before") + F.col("neg") / 2)).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    placed = parts.withColumn("lower", F.sum("neg").over(Window.partitionBy(by).orderBy("bucket")) - F.col("neg"))  # BUCKETS rows a series
    return placed.groupBy(by).agg(F.try_divide(F.sum(F.col("won") + F.col("pos") * F.col("lower")), F.sum("pos") * F.sum("neg")).alias("auc"), (F.sum("pos") + F.sum("neg")).alias("n"))


def fingerprint(*columns: Column) -> Column:
    """An aggregate over all rows that any changed, added or missing row changes, in whatever order they come: a sum of 32-bit numbers of md5."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(20,0)")).cast("string")


def time_to_hit_by_array(bars: DataFrame, up: float, h: int) -> DataFrame:
    """symbol, ts, hit: the first of the next h closes that is `up` above this one, out of an array of them: another way than by leads."""
    ahead = Window.partitionBy("symbol").orderBy("ts").rowsBetween(1, h)
    path = bars.select("symbol", "ts", "close", F.collect_list("close").over(ahead).alias("path"))
    place = F.array_position(F.transform("path", lambda c: c >= F.col("close") * (1 + up)), F.lit(True))
    return path.select("symbol", "ts", F.when(place > 0, place.cast("int")).alias("hit"))


def mismatches(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Rows and mismatches of each symbol between two computations of one label; rows that one of them lacks are mismatches."""
    both = left.select(*keys, F.col(a).alias("a"), F.lit(1).alias("l")).join(right.select(*keys, F.col(b).alias("b"), F.lit(1).alias("r")), keys, "full")
    apart = F.col("l").isNull() | F.col("r").isNull() | ~F.col("a").eqNullSafe(F.col("b"))
    return both.groupBy("symbol").agg(F.count("*").alias("n"), F.count_if(apart).alias("mismatches"))


def correlations(df: DataFrame, features: list[str]) -> DataFrame:
    """fa, fb, corr of every pair of columns, in one pass over rows as wide as they are."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    found = df.agg(*(correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    listed = F.array(*(F.struct(F.lit(a).alias("fa"), F.lit(b).alias("fb"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)))
    return found.select(F.explode(listed).alias("x")).select("x.*")


def pruned(correlated: DataFrame, most: float = 0.95) -> DataFrame:
    """feature, kept: features in order of name; one goes if it correlates beyond `most` with one kept before it. Pairs are a few names' worth."""
    pairs = correlated.filter(F.abs("corr") > most).select("fa", "fb").collect()
    gone: set[str] = set()
    for a, b in sorted(map(tuple, pairs)):
        if a not in gone:
            gone.add(b)
    names = correlated.select(F.col("fa").alias("feature")).union(correlated.select("fb")).distinct()
    return names.withColumn("kept", ~F.col("feature").isin(sorted(gone)) if gone else F.lit(True))


def multiclass(df: DataFrame, label: str, probabilities: str, by: list[str], eps: float = 1e-8) -> DataFrame:
    """df(*by, label, probabilities) to a row a group: n, cross_entropy, accuracy, macro_f1. probabilities is an array with one number a class, label a class from 0 on.

    Numbers are cut off at eps and 1 - eps and then add up to one. The predicted class is the first of the largest; macro_f1 is the mean over classes that are labels or predictions. Rows
    without a label or probabilities don't count; a label without a number has the probability eps. Rows are counted by group, label and prediction before they meet."""
    cut = F.transform(F.col(probabilities), lambda p: F.greatest(F.lit(eps), F.least(F.coalesce(p, F.lit(0.0)), F.lit(1 - eps))))
    held = df.filter(F.col(label).isNotNull() & (F.size(probabilities) > 0)).select(*by, F.col(label).cast("int").alias("y"), cut.alias("p"))
    told = held.select(*by, "y", (F.array_position("p", F.array_max("p")) - 1).cast("int").alias("q"), (F.coalesce(F.get("p", "y"), F.lit(eps)) / F.aggregate("p", F.lit(0.0), lambda a, x: a + x)).alias("own"))
    cells = told.groupBy(*by, "y", "q").agg(F.count("*").alias("n"), F.sum(-F.log("own")).alias("loss"))
    sides = F.array(F.struct(F.col("y").alias("k"), F.lit(True).alias("real")), F.struct(F.col("q").alias("k"), F.lit(False).alias("real")))
    classes = cells.select(*by, "n", F.when(F.col("y") == F.col("q"), F.col("n")).otherwise(0).alias("hit"), F.inline(sides)).groupBy(*by, "k").agg(F.sum("n").alias("both"), F.sum(F.when(F.col("real"), F.col("hit")).otherwise(0)).alias("tp"))
    f1 = classes.groupBy(*by).agg(F.avg(2 * F.col("tp") / F.col("both")).alias("macro_f1"))
    whole = cells.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum("loss") / F.sum("n")).alias("cross_entropy"), (F.sum(F.when(F.col("y") == F.col("q"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    left, right = whole.alias("w"), f1.alias("f")
    on = F.lit(True)
    for c in by:
        on = on & F.col(f"w.{c}").eqNullSafe(F.col(f"f.{c}"))
    return left.join(right, on).select("w.*", "f.macro_f1")
