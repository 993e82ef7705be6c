"""Symbols: their spelling, those left out, an audit of both, and seeded batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalised(symbol: Column) -> Column:
    """Without outer white space, in upper case, share classes after a point: brk/b, BRK-B and BRK.B are BRK.B. An empty symbol is null."""
    return F.nullif(F.translate(F.upper(F.trim(symbol)), "/-", ".."), F.lit(""))


def universe(symbols: DataFrame, blocked: Sequence[str] = (), aliases: Mapping[str, str] | None = None) -> DataFrame:
    """symbols(symbol) to a row a different spelling: symbol, clean, stored, n, and status, one of blacklisted, missing, changed, kept.

    clean is the normalised name, stored the name of its folder where aliases (clean to stored) give another; blocked holds clean names, as they stand.
    blocked and aliases are small lists of the caller's."""
    found = symbols.groupBy("symbol").agg(F.count("*").alias("n")).withColumn("clean", normalised(F.col("symbol")))
    stored = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)), F.col("clean")), F.col("clean")) if aliases else F.col("clean")
    status = F.when(F.col("clean").isNull(), "missing").when(F.col("clean").isin(*blocked), "blacklisted").when(F.col("clean") != F.col("symbol"), "changed").otherwise("kept")
    return found.select("symbol", "clean", stored.alias("stored"), "n", status.alias("status"))


def audit(found: DataFrame) -> DataFrame:
    """universe()'s rows counted: a row a status, with n_symbols and n_rows."""
    return found.groupBy("status").agg(F.count("*").alias("n_symbols"), F.sum("n").alias("n_rows"))


def batch(symbols: DataFrame, size: int | None, seed: int) -> DataFrame:
    """`size` different symbols, the same for the same seed and symbols whatever their order and partitioning: those first by hash of name and seed, then by
    name. All of them if size is None or as large as their number; nulls are none. Sorted by hash, each task keeps `size` of its own before they meet."""
    each = symbols.filter("symbol IS NOT NULL").select("symbol").distinct()
    if size is None:
        return each
    if size < 0:
        raise ValueError("size is negative")
    return each.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "symbol"))).orderBy("_h", "symbol").limit(size).drop("_h")
