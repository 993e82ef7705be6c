"""Streams replayed over the events table in order of time, late rows behind. Windows are given once they are final: the watermark is one hour behind the
newest row, so what ends later than that stays in the state, and the late rows change nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.registry import NUDGE, register, rounded, translated
from barloom.sources import panels
from barloom.sources.scratch import scratch_dir
from barloom.streaming import live


def str_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    bars = live.drained(live.live_bars(live.replayed(spark, sf_dir, folder), "1 hour", "1 hour"), folder)
    return rounded(bars.select("symbol", "ts", "open", "high", "low", "close", "volume", "n_trades"))


def str_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest report of each symbol's buffer; those that the watermark has left behind are empty."""
    folder = scratch_dir(spark)
    reports = live.drained(live.ring_buffer(live.replayed(spark, sf_dir, folder)), folder, "update")
    newest = reports.groupBy("symbol").agg(F.max_by(F.struct("ready", "prices"), "number").alias("r"))
    return rounded(newest.select("symbol", "r.ready", F.size("r.prices").alias("n"), F.try_element_at("r.prices", F.lit(-1)).alias("last_price")))


def str_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch's cross-section of its latest final bar, scaled within the batch; here the last batch that had any."""
    folder = scratch_dir(spark)
    scaled = live.drained(live.live_bars(live.replayed(spark, sf_dir, folder), "1 hour", "1 hour"), folder, each=live.ksigma_snapshot)
    return rounded(scaled.join(scaled.agg(F.max("ts").alias("ts")), "ts").select("symbol", "ts", "z"))


def str_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    return rounded(live.drained(live.sessions(live.replayed(spark, sf_dir, folder), "1 hour", "1 hour"), folder).select("symbol", F.col("start").alias("ts"), "n", "volume"))


_R = f"round(%s + {NUDGE}, 6)"
_FINAL = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
_BARS = f"SELECT * FROM ({panels.BARS_H}) WHERE ts + INTERVAL 1 HOUR <= {_FINAL}"
register("str_1", str_1, translated("SELECT symbol, CAST(ts AS VARCHAR) AS ts, " + ", ".join(f"{_R % c} AS {c}" for c in ("open", "high", "low", "close")) + f", volume, n_trades FROM ({_BARS})"))
register("str_2", str_2, translated(f"SELECT event_type AS symbol, false AS ready, 0 AS n, CAST(NULL AS DOUBLE) AS last_price FROM events GROUP BY event_type HAVING max(ts) <= (SELECT max(ts) - INTERVAL 3900 SECOND FROM events) UNION ALL SELECT symbol, true, 8, {_R % 'value'} FROM (SELECT event_type AS symbol, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn, max(ts) OVER (PARTITION BY event_type) AS last FROM events) q WHERE rn = 1 AND last > (SELECT max(ts) - INTERVAL 3900 SECOND FROM events)"))
register("str_3", str_3, translated(f"WITH b AS ({_BARS}), l AS (SELECT * FROM b WHERE ts = (SELECT max(ts) FROM b)), s AS (SELECT avg(close) AS m, stddev_samp(close) AS s FROM l) SELECT symbol, CAST(ts AS VARCHAR) AS ts, {_R % '((greatest(least(close, m + 2.33 * s), m - 2.33 * s) - m) / (s + 1e-8))'} AS z FROM l, s"))
register("str_4", str_4, translated(f"WITH t AS ({panels.TICKS_H}), g AS (SELECT symbol, tick, size, CASE WHEN tick - lag(tick) OVER (PARTITION BY symbol ORDER BY tick, t1) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM t), i AS (SELECT symbol, tick, size, sum(new) OVER (PARTITION BY symbol ORDER BY tick ROWS UNBOUNDED PRECEDING) AS island FROM g) SELECT symbol, CAST(min(tick) AS VARCHAR) AS ts, count(*) AS n, CAST(sum(size) AS BIGINT) AS volume FROM i GROUP BY symbol, island HAVING max(tick) + INTERVAL 1 HOUR <= {_FINAL}"))
