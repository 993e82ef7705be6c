"""Ticks of one instant, order and line: their price settles which is a bar's first and last, in the queries and in their SQL."""

from __future__ import annotations

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__  # noqa: F401  registers the queries
from barloom.plans import registry
from barloom.sources import panels
from compare import database, same


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory) -> str:
    """The small tables with a second tick beside each, at another price, in many row groups that are read apart."""
    folder, at = tmp_path_factory.mktemp("tied"), "/root/testdata/sf0.001"
    con = duckdb.connect()
    twice = con.execute(f"SELECT * FROM (SELECT * FROM '{at}/lineitem.parquet' UNION ALL SELECT * REPLACE (l_extendedprice * 3 AS l_extendedprice) FROM '{at}/lineitem.parquet') ORDER BY md5(concat(l_orderkey, l_linenumber, l_extendedprice))").to_arrow_table()
    pq.write_table(twice, f"{folder}/lineitem.parquet", row_group_size=500)
    for t in ("supplier", "events"):
        con.execute(f"COPY (SELECT * FROM '{at}/{t}.parquet') TO '{folder}/{t}.parquet' (FORMAT parquet)")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield str(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bars_of_tied_ticks_know_no_order(spark):
    rows = [("a", 1, 5.0, 2.0, 7), ("a", 1, 3.0, 1.0, 7), ("a", 1, 4.0, 1.0, 7)]
    made = [panels.ticks_to_bars(spark.createDataFrame(r, "symbol string, ts int, price double, size double, tie int").coalesce(1)).select("open", "close").first() for r in (rows, rows[::-1], [rows[0], rows[2], rows[1]])]
    assert [tuple(r) for r in made] == [(3.0, 5.0)] * 3


@pytest.mark.parametrize("name", "csx_11 csx_13 csx_15 csx_6 ev_4_classes ft_2 ft_35 ft_36 ft_43 ft_46 ft_48 ft_52 ft_56 ft_60_indicators ag_16 ag_4 csx_1 csx_15_frame ft_28 ft_32 ft_33 ft_34 ft_47 ft_14 ft_17 ft_21 ft_5 ft_62".split())
def test_tied_ticks_give_the_rows_of_the_sql(spark, tied, name):
    same(spark, tied, registry.QUERIES[name], registry.SQL[name])


def test_large_numbers_round_by_their_value():
    """12341997.044287499 has no half in its seventh place; times a million it is the nearest double to one."""
    x = "(12341997.044287499::DOUBLE - 3e-08)"
    sql = registry.SQL["ft_43"]
    start = sql.index("CAST(round(CAST(CAST(CAST(volume_weighted_price")
    shown = sql[start : sql.index(" AS volume_weighted_price", start)].replace("volume_weighted_price", x)
    assert duckdb.connect().execute(f"SELECT {shown}").fetchone()[0] == 12341997.044287


def test_labels_have_one_zero(spark, tmp_path):
    """Of prices that only fall, every label of ag_16's flat target is a negative zero."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT 0::BIGINT AS l_orderkey, 0::BIGINT AS l_suppkey, k::INT AS l_linenumber, 1.0::DOUBLE AS l_quantity, (100 - k)::DOUBLE AS l_extendedprice, TIMESTAMP '2000-01-03' + k * INTERVAL 7 DAY AS l_shipdate FROM range(20) t(k)) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT 0::BIGINT AS s_suppkey, 1 AS s_nationkey) TO '{tmp_path}/supplier.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.001/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    mine = [(r["target"], repr(r["label"]), r["n"]) for r in registry.QUERIES["ag_16"](spark, str(tmp_path)).collect()]
    theirs = [(t, repr(x), n) for t, x, n, *_ in database(str(tmp_path)).execute(registry.SQL["ag_16"]).fetchall()]
    assert sorted(mine) == sorted(theirs) == [(t, "0.0", 15) for t in ("big", "flat", "up")]
