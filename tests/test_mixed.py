from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from barloom.sources import mixed, symbols, times

DAY = datetime.datetime(2024, 1, 2, 9, 30)


def test_files_of_different_types(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    bar = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/interval=5m/symbol={name}")
    bar("007", [(DAY, 1.5, 10, 3.5)], "ts timestamp, close double, volume bigint, extra double")
    bar("A", [(1704187800, 2, 10.4), (None, 3, float("nan"))], "ts bigint, close bigint, volume double")
    bar("B", [("2024-01-02T09:30:00", "4.5", 7), ("soon", "none", None)], "ts string, close string, volume int")
    bar("C", [(1704187800000, 2, 11.5)], "ts bigint, close bigint, volume double")
    assert mixed.physical_kinds(spark, root).select("kind").distinct().count() == 3
    made = mixed.scan_mixed(spark, root)
    assert made.columns == ["ts", "open", "high", "low", "close", "volume", "vwap", "n_trades", "symbol", "interval", "volume_raw"]
    found = sorted(((r["symbol"], r["ts"], r["close"], r["volume"], r["open"], r["interval"]) for r in made.collect()), key=str)
    assert found == sorted([("007", DAY, 1.5, 10, None, "5m"), ("A", DAY, 2.0, 10, None, "5m"), ("A", None, 3.0, None, None, "5m"), ("B", DAY, 4.5, 7, None, "5m"), ("B", None, None, None, None, "5m"), ("C", DAY, 2.0, 12, None, "5m")], key=str)
    assert [r["close"] for r in mixed.scan_mixed(spark, root, ["007"], "5m").collect()] == [1.5]
    assert mixed.scan_mixed(spark, root, interval="1h").collect() == []
    report = {r["symbol"]: (r["n"], r["n_rounded"], r["n_half"], r["n_other"]) for r in mixed.rounding_report(made).collect()}
    assert report == {"007": (1, 0, 0, 0), "A": (2, 1, 0, 1), "B": (2, 0, 0, 0), "C": (1, 1, 1, 0)}


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        mixed.scan_mixed(spark, str(tmp_path))


def test_volume_policies(spark):
    given = spark.createDataFrame([(10.0,), (10.04,), (None,), (float("inf"),)], "volume_raw double")
    assert [r["volume"] for r in mixed.volume_policy(given, "coerce").collect()] == [10, 10, None, None]
    assert [(r["volume"], r["volume_adj"] and round(r["volume_adj"], 6)) for r in mixed.volume_policy(given, "separate").collect()] == [(10, 0.0), (10, 0.04), (None, None), (None, None)]
    assert [(r["volume"], r["quarantined"]) for r in mixed.volume_policy(given, "quarantine").collect()] == [(10, False), (None, True), (None, False), (None, False)]
    assert [r["volume"] for r in mixed.volume_policy(given.filter("volume_raw = 10"), "strict").collect()] == [10]
    for policy, rows in (("strict", given), ("coerce", given.withColumn("volume_raw", F.col("volume_raw") + 0.3))):
        with pytest.raises(Exception, match="fractional volume"):
            mixed.volume_policy(rows, policy).collect()
    with pytest.raises(ValueError):
        mixed.volume_policy(given, "round")


@pytest.mark.parametrize(("kind", "value", "expected"), [
    ("bigint", 1704187800, DAY), ("bigint", 1704187800000, DAY), ("bigint", 1704187800000000, DAY), ("bigint", 1704187800000000000, DAY), ("double", 1704187800.5, DAY.replace(microsecond=500000)), ("double", float("nan"), None),
    ("int", 1704187800, DAY), ("bigint", -5, None), ("bigint", 99999999999, None), ("string", "1704187800000", DAY), ("string", " 2024-01-02 09:30:00 ", DAY), ("string", "2024-01-02T10:30:00+01:00", DAY),
    ("string", "2024/01/02 09:30:00", DAY), ("string", "20240102", DAY.replace(hour=0, minute=0)), ("string", "2024-01-02", DAY.replace(hour=0, minute=0)), ("string", "2024-01-02 09:30:00.25", DAY.replace(microsecond=250000)), ("string", "2024-01-02 09:30:00.250", DAY.replace(microsecond=250000)),
    ("string", "2024-13-02", None), ("string", "", None), ("string", None, None), ("string", "1969-12-31", None), ("string", "2100-01-01", None), ("date", datetime.date(2024, 1, 2), DAY.replace(hour=0, minute=0)), ("timestamp", DAY, DAY),
])
def test_times(spark, kind, value, expected):
    df = spark.createDataFrame([(value,)], f"t {kind}")
    assert df.select(times.as_time("t", df.schema["t"].dataType)).first()[0] == expected


def test_symbols(spark):
    given = spark.createDataFrame([(s,) for s in ("brk/b", "BRK-B", "BRK.B", "AAPL", "AAPL", " msft ", "BAD", "", None)], "symbol string")
    found = symbols.universe(given, ["BAD"], {"BRK.B": "BRK-B"})
    assert {r["symbol"]: (r["clean"], r["stored"], r["n"], r["status"]) for r in found.collect()} == {
        "brk/b": ("BRK.B", "BRK-B", 1, "changed"), "BRK-B": ("BRK.B", "BRK-B", 1, "changed"), "BRK.B": ("BRK.B", "BRK-B", 1, "kept"), "AAPL": ("AAPL", "AAPL", 2, "kept"),
        " msft ": ("MSFT", "MSFT", 1, "changed"), "BAD": ("BAD", "BAD", 1, "blacklisted"), "": (None, None, 1, "missing"), None: (None, None, 1, "missing")}
    assert {r["status"]: (r["n_symbols"], r["n_rows"]) for r in symbols.audit(found).collect()} == {"changed": (3, 3), "kept": (2, 3), "blacklisted": (1, 1), "missing": (2, 2)}
    assert symbols.universe(given.limit(0)).collect() == []


def test_batches(spark):
    given = spark.createDataFrame([(f"S{i % 50}",) for i in range(200)] + [(None,)], "symbol string")
    take = lambda df, size, seed: sorted(r["symbol"] for r in symbols.batch(df, size, seed).collect())
    assert take(given, 7, 1) == take(given.repartition(9).orderBy("symbol"), 7, 1) and len(take(given, 7, 1)) == 7
    assert take(given, 7, 1) != take(given, 7, 2) and set(take(given, 7, 1)) < set(take(given, 8, 1))
    assert len(take(given, None, 1)) == len(take(given, 500, 1)) == 50 and take(given, 0, 1) == []
    with pytest.raises(ValueError):
        symbols.batch(given, -1, 1)
