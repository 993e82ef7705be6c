"""Bar panels out of trades and events: one row for each symbol and bar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAR_COLUMNS = ("symbol", "ts", "open", "high", "low", "close", "volume", "vwap", "n_trades")


def ticks_to_bars(ticks: DataFrame, every: str | None = None) -> DataFrame:
    """ticks(symbol, ts, price, size, tie) to bars. every: a calendar unit as of date_trunc. tie orders ticks of one instant, the price those of one
    tie; one shuffle, with partial aggregates before it."""
    key = F.struct("at", "tie", "price")
    held = ticks.withColumn("at", F.col("ts")).withColumn("ts", F.date_trunc(every, "ts").cast(ticks.schema["ts"].dataType) if every else F.col("ts"))
    return held.groupBy("symbol", "ts").agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum("size").cast("long").alias("volume"), F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"), F.count("*").alias("n_trades"))


def weekly_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).select(
        F.col("s_nationkey").cast("string").alias("symbol"), F.col("l_shipdate").alias("ts"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("size"), F.struct("l_orderkey", "l_linenumber").alias("tie"))


def hourly_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("size"), F.struct("event_id").alias("tie"))


def weekly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_bars(weekly_ticks(spark, sf_dir), "week")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_bars(hourly_ticks(spark, sf_dir), "hour")


_BARS = """SELECT symbol, date_trunc('{unit}', tick) AS ts, first(price ORDER BY tick, t1, t2) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY tick, t1, t2) AS close, CAST(sum(size) AS BIGINT) AS volume, sum(price * size) / nullif(sum(size), 0) AS vwap, count(*) AS n_trades
FROM ({ticks}) GROUP BY 1, 2"""
TICKS_W = "SELECT CAST(s_nationkey AS VARCHAR) AS symbol, l_shipdate AS tick, l_extendedprice / l_quantity AS price, l_quantity AS size, l_orderkey AS t1, l_linenumber AS t2 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
TICKS_H = "SELECT event_type AS symbol, ts AS tick, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, event_id AS t1, 0 AS t2 FROM events"
#: The panels in SQL, for the same tables.
BARS_W = _BARS.format(unit="week", ticks=TICKS_W)
BARS_H = _BARS.format(unit="hour", ticks=TICKS_H)
BARS_M = _BARS.format(unit="minute", ticks=TICKS_H)


def settled(sql: str) -> str:
    """The panels' SQL with ticks of one instant and tie ordered by their price too, as ticks_to_bars has them."""
    return sql.replace("ORDER BY tick, t1, t2)", "ORDER BY tick, t1, t2, price)")
