from __future__ import annotations

import datetime

import pytest

from barloom.operators import sequences

START = datetime.datetime(2024, 1, 1)
SCHEMA = "symbol string, ts timestamp, f double, g double, y double"


def expected(rows, length, stride, before):
    out = {}
    for symbol in {r[0] for r in rows}:
        finite = lambda v: v is not None and v == v and abs(v) != float("inf")
        clean = sorted((r for r in rows if r[0] == symbol and finite(r[2]) and finite(r[3])), key=lambda r: r[1])
        for end in range(length - 1 + before, len(clean), stride):
            if finite(clean[end][4]):
                out[symbol, clean[end][1]] = ([[r[2], r[3]] for r in clean[end - length + 1 - before : end + 1 - before]], clean[end][4])
    return out


def rows_of(odd):
    rows = [(s, START + datetime.timedelta(minutes=5 * i), float(i), i * 0.5, i / 10) for s in ("A", "B") for i in range(23)]
    for place, column, value in odd:
        rows[place] = (*rows[place][:column], value, *rows[place][column + 1 :])
    return rows


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("stride", [1, 3])
def test_windows_equal_slices(spark, before, stride):
    rows = [*rows_of([(4, 2, None), (5, 3, float("inf")), (30, 2, float("nan")), (12, 4, None), (35, 4, float("nan"))]), ("C", START, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = sequences.windows(df, ["f", "g"], "y", 4, stride, before)
    found = {(r["symbol"], r["ts"]): ([list(x) for x in r["x"]], r["y"]) for r in made.collect()}
    assert found == expected(rows, 4, stride, before) and len(found) > 5
    assert {r["check"]: r["broken"] for r in sequences.checks(made, 4, 2).collect()} == dict.fromkeys(("length", "width", "missing", "infinite", "label", "repeated"), 0)


def test_gaps_codes_and_refusals(spark):
    rows = rows_of([])
    del rows[10:12]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["gap_minutes"] for r in sequences.windows(df, ["f"], "y", 3).collect()} == {5.0, 15.0}
    steady = sequences.windows(df, ["f"], "y", 3, max_gap_minutes=5.0)
    assert steady.filter("symbol = 'A'").count() == 17 and steady.filter("symbol = 'B'").count() == 21
    assert {(r["symbol"], r["symbol_code"]) for r in sequences.with_codes(steady).collect()} == {("A", 0), ("B", 1)}
    assert sequences.windows(df.limit(0), ["f"], "y", 3).collect() == [] and sequences.windows(df, ["f"], "y", 1).count() == len(rows)
    assert {r["n"] for r in sequences.checks(steady.limit(0), 3, 1).collect()} == {0}
    for wrong in ({"label": "f"}, {"length": 0}, {"stride": 0}):
        with pytest.raises(ValueError):
            sequences.windows(df, **{"features": ["f"], "label": "y", "length": 3, **wrong})


def test_checks_count_planted_breaks(spark):
    inf, nan = float("inf"), float("nan")
    bad = [("A", 1, [[1.0, 2.0]] * 3, 1.0), ("A", 1, [[1.0, 2.0]] * 3, 1.0), ("A", 2, [[1.0, 2.0]] * 2, 1.0), ("A", 3, [[1.0], [1.0, 2.0], [1.0, 2.0]], 1.0), ("A", 4, [[1.0, None], [nan, 1.0], [1.0, 2.0]], 1.0), ("A", 5, [[inf, 1.0]] * 3, nan), ("B", 1, None, None)]
    df = spark.createDataFrame(bad, "symbol string, ts int, x array<array<double>>, y double")
    assert {r["check"]: (r["broken"], r["n"]) for r in sequences.checks(df, 3, 2).collect()} == {"length": (2, 7), "width": (1, 7), "missing": (1, 7), "infinite": (1, 7), "label": (2, 7), "repeated": (1, 7)}
