"""Windows of a panel as samples for sequence models, and a table that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("symbol", "ts")


def _number(x: Column) -> Column:
    """Is x there and finite?"""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def windows(df: DataFrame, features: list[str], label: str, length: int, stride: int = 1, before: bool = False, max_gap_minutes: float | None = None) -> DataFrame:
    """symbol, ts, x, y, gap_minutes: a sample for every stride-th row of a symbol that has a whole window.

    Rows whose features aren't all finite go first, so a window is of `length` clean rows that follow each other. It ends with the sample's own row,
    or, with before, with the row before it; y is the label of the sample's row either way, and samples without a finite one go. Rows are counted from
    the first whole window on, so a dropped sample moves no other. gap_minutes is the largest time between neighbours in the window (the sample's row
    included): beyond max_gap_minutes the sample goes. Symbols never mix; one shuffle and one sort by symbol. A symbol with fewer rows gives none.
    """
    if label in features:
        raise ValueError(f"the label {label} is among the features")
    if length < 1 or stride < 1:
        raise ValueError("length and stride are at least 1")
    whole = F.lit(True)
    for f in features:
        whole = whole & _number(F.col(f).cast("double"))
    order = Window.partitionBy("symbol").orderBy("ts")
    clean = df.filter(whole).select(*KEY, F.array(*(F.col(f).cast("double") for f in features)).alias("row"), F.col(label).cast("double").alias("y"))
    back = int(before)
    reach = order.rowsBetween(-(length - 1 + back), -back)
    placed = clean.withColumn("place", F.row_number().over(order) - length - back)
    placed = placed.withColumn("step", (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(order).cast("timestamp"))) / 6e7)
    steps = order.rowsBetween(-(length - 2 + back), 0)
    gap = F.max("step").over(steps) if length + back > 1 else F.lit(0.0)
    made = placed.withColumn("x", F.collect_list("row").over(reach)).withColumn("gap_minutes", gap)
    kept = made.filter((F.col("place") >= 0) & (F.col("place") % stride == 0) & _number(F.col("y")))
    if max_gap_minutes is not None:
        kept = kept.filter(F.col("gap_minutes") <= max_gap_minutes)
    return kept.select(*KEY, "x", "y", "gap_minutes")


def with_codes(samples: DataFrame) -> DataFrame:
    """samples and symbol_code, a symbol's place in the order of names from 0: the panel's form, one table for all symbols."""
    names = samples.select("symbol").distinct()
    return samples.join(names.select("symbol", (F.row_number().over(Window.orderBy("symbol")) - 1).alias("symbol_code")), "symbol")  # a row a symbol


def checks(samples: DataFrame, length: int, width: int) -> DataFrame:
    """check, broken, n: how many samples break each rule. Shapes, missing and infinite values, labels, repeated keys; no samples break none."""
    bad_row = lambda r: r.isNull() | (F.size(r) != width)
    inside = lambda test: F.exists("x", lambda r: F.exists(r, test))
    rules = {
        "length": F.col("x").isNull() | (F.size("x") != length), "width": F.exists("x", bad_row), "missing": inside(lambda v: v.isNull() | F.isnan(v)),
        "infinite": inside(lambda v: F.abs(v) == float("inf")), "label": ~_number(F.col("y")),
    }
    count = lambda c: F.coalesce(F.count_if(F.coalesce(c, F.lit(False))), F.lit(0))
    row = samples.agg(F.count("*").alias("n"), *(count(c).alias(k) for k, c in rules.items()))
    repeated = samples.groupBy(*KEY).agg(F.count("*").alias("m")).agg(F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).alias("repeated"))
    return row.crossJoin(repeated).unpivot(["n"], [*rules, "repeated"], "check", "broken").select("check", "broken", "n")  # one row each
