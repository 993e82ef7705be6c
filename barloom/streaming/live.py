"""Live bars, ring buffers, cross-sectional snapshots and sessions on Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: A buffer is ready when it is full and its newest row no older than this.
TTL_SECONDS = 300.0


def live_bars(ticks: DataFrame, every: str = "1 hour", late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """ticks(symbol, ts, price, size, tie) to bars by event time; rows later than the watermark are dropped. slide gives overlapping windows."""
    span = F.window("ts", every, slide) if slide else F.window("ts", every)
    key = F.struct("ts", "tie")
    bars = ticks.withWatermark("ts", late).groupBy("symbol", span.alias("span")).agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum("size").cast("long").alias("volume"), F.count("*").alias("n_trades"))
    return bars.select("symbol", F.col("span.start").alias("ts"), "open", "high", "low", "close", "volume", "n_trades")


def sessions(ticks: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Runs of ticks of a symbol without a pause of `gap`."""
    found = ticks.withWatermark("ts", late).groupBy("symbol", F.session_window("ts", gap).alias("span")).agg(F.count("*").alias("n"), F.sum("size").cast("long").alias("volume"))
    return found.select("symbol", F.col("span.start").alias("start"), F.col("span.end").alias("end"), "n", "volume")


def ring_buffer(ticks: DataFrame, length: int = 8, ttl_seconds: float = TTL_SECONDS, late: str = "1 hour") -> DataFrame:
    """The last `length` finite prices of each symbol after each batch, and whether they make a full and recent sequence. State is one list of
    `length` numbers a symbol; once the watermark is `ttl_seconds` past its newest row the buffer is dropped and reported empty."""

    def push(key: tuple, blocks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"symbol": [key[0]], "prices": [[]], "ready": [False], "last_at": [None]})
            return
        rows = [tuple(r) for r in (state.get[0] if state.exists else [])]
        newest = 0.0
        for pdf in blocks:
            held = pdf[pd.to_numeric(pdf["price"], errors="coerce").abs() < float("inf")]
            newest = max(newest, float(pdf["at"].max()))
            rows = sorted([*rows, *zip(held["at"].tolist(), held["tie"].tolist(), held["price"].tolist(), strict=True)])[-length:]
        state.update(([list(map(float, r)) for r in rows],))
        kept = rows[-1][0] if rows else newest
        state.setTimeoutTimestamp(max(int((kept + ttl_seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        ready = len(rows) == length and newest - rows[-1][0] <= ttl_seconds
        yield pd.DataFrame({"symbol": [key[0]], "prices": [[r[2] for r in rows]], "ready": [ready], "last_at": [rows[-1][0] if rows else None]})

    held = ticks.withWatermark("ts", late).select("symbol", "ts", F.col("ts").cast("timestamp").cast("double").alias("at"), "price", F.col("tie.event_id").cast("double").alias("tie"))
    return held.groupBy("symbol").applyInPandasWithState(push, "symbol string, prices array<double>, ready boolean, last_at double", "rows array<array<double>>", "update", GroupStateTimeout.EventTimeTimeout)


def ksigma_snapshot(bars: DataFrame, k: float = 2.33) -> DataFrame:
    """The cross-section of a batch's latest bar, winsorised at k sigma and scaled."""
    latest = bars.join(bars.agg(F.max("ts").alias("ts")), "ts")
    stats = latest.agg(F.avg("close").alias("m"), F.stddev_samp("close").alias("s"))
    held = latest.withColumn("stats", stats.select(F.struct("m", "s")).scalar())
    clipped = F.greatest(F.least(F.col("close"), F.col("stats.m") + k * F.col("stats.s")), F.col("stats.m") - k * F.col("stats.s"))
    return held.select("symbol", "ts", ((clipped - F.col("stats.m")) / (F.col("stats.s") + 1e-8)).alias("z"))


def replayed(spark: SparkSession, sf_dir: str, folder: str, parts: int = 4) -> DataFrame:
    """The events table as a stream of ticks in order of time: it is cut into parts at even times, each written after the one before it, and read a
    part a trigger. The last part holds rows of the first once more at ten times their price, which come too late for any watermark."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = (r.timestamp() for r in events.agg(F.min("ts"), F.max("ts")).first())
    at, root = F.col("ts").cast("double"), f"{folder}/ticks-{uuid.uuid4().hex}"
    edges = [low + (high - low) * k / parts for k in range(parts)] + [high + 1]
    for a, b in zip(edges, edges[1:], strict=False):
        events.filter((at >= a) & (at < b)).coalesce(1).write.mode("append").parquet(root)
    events.filter(at < low + (high - low) / 10).withColumn("value", F.col("value") * 10).coalesce(1).write.mode("append").parquet(root)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(root)
    return source.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("size"), F.struct("event_id").alias("tie"))


def drained(stream: DataFrame, folder: str, mode: str = "append", each: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> DataFrame:
    """All rows that the stream gives for what is there now, each batch put through `each`, written by foreachBatch and read again with its number.
    A batch that is run again replaces what it wrote."""
    name = f"{folder}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{name}/out/number={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{name}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{name}/out")
