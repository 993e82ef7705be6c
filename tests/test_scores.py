"""Verdicts on scores, splits, gates, lagged runs and coverage of bars, by hand or against plain Python."""

from __future__ import annotations

import datetime
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.functions.portable import correlation
from barloom.operators import coverage, drift, gating, label_checks, leak_scores, segments, splits, validation

DAY = datetime.datetime(2024, 1, 2)
BARS = "symbol string, ts timestamp, open double, high double, low double, close double, volume long, n_trades long"


def bar(symbol, minutes, price=10.0, tie=1, volume=1):
    return (symbol, None if minutes is None else DAY + datetime.timedelta(minutes=minutes), price, price + 1, price - 1, price, volume, tie)


def test_timeframes(spark):
    """Five-minute bars are merged, half-hourly ones aren't; of a repeated time the first in order of trades counts; one bar alone stays."""
    rows = [bar("A", m, 10.0 + m) for m in (0, 5, 10, 15, 40)] + [bar("A", 5, 99.0, 2)] + [bar("B", m) for m in (0, 30, 60)] + [bar("C", 7), bar("D", None), (None, DAY, *bar("x", 0)[2:])]
    df = spark.createDataFrame(rows, BARS)
    found = {(r["symbol"], r["ts"]): (r["open"], r["high"], r["low"], r["close"], r["volume"], r["n_bars"], r["resampled"]) for r in coverage.by_timeframe(df, 15).collect()}
    at = lambda m: DAY + datetime.timedelta(minutes=m)
    assert {k: v for k, v in found.items() if k[0] == "A"} == {("A", at(0)): (10.0, 21.0, 9.0, 20.0, 3, 3, True), ("A", at(15)): (25.0, 26.0, 24.0, 25.0, 1, 1, True), ("A", at(30)): (50.0, 51.0, 49.0, 50.0, 1, 1, True)}
    assert sorted(k for k in found if k[0] != "A") == [("B", at(0)), ("B", at(30)), ("B", at(60)), ("C", at(7))]
    assert {r["n_bars"] for r in coverage.by_timeframe(df, 5).collect()} == {1} and coverage.by_timeframe(df.limit(0), 15).collect() == []


def test_steps(spark):
    rows = [bar("A", m) for m in (0, 15, 45, 50, 50 + 1440)] + [bar("B", 0)]
    found = {r["symbol"]: tuple(r)[1:] for r in coverage.step_report(spark.createDataFrame(rows, BARS), 15).collect()}
    assert found == {"A": (3, 1, 1, DAY + datetime.timedelta(minutes=50)), "B": (0, 0, 0, None)}


def test_sessions(spark):
    """Three days of New York: a whole one, one that closes early, a broken one."""
    days = [(0, 78), (1, 54), (2, 40)]
    rows = [bar("A", 900 + 1440 * d + 5 * m) for d, n in days for m in range(n)]
    r = coverage.session_coverage(spark.createDataFrame([*rows, bar("B", None)], BARS), recent=2).collect()
    assert len(r) == 1 and (r[0]["sessions"], r[0]["n_early"], r[0]["recent_sessions"], r[0]["pct_recent"]) == (3, 1, 2, 50.0)
    assert r[0]["pct_complete"] == pytest.approx(200 / 3) and r[0]["avg_bars"] == pytest.approx(172 / 3) and r[0]["first_date"] == DAY.date()


def test_sanity(spark):
    good = [bar("G", 60 * k) for k in range(30)]
    bad = [bar("B", 0), bar("B", 0), bar("B", 180), bar("B", 60, -5.0), ("B", DAY + datetime.timedelta(hours=2), 10.0, 9.0, 9.5, None, -1, 1)]
    found = {r["symbol"]: r for r in coverage.sanity(spark.createDataFrame([*good, *bad, bar("H", 0), bar("H", 240), bar("N", None)], BARS), 60).collect()}
    assert found["G"]["sane"] and found["G"]["missing"] == 0 and not found["H"]["sane"] and found["H"]["missing"] == pytest.approx(0.6)
    b = found["B"]
    assert (b["n"], b["n_price"], b["n_high"], b["n_low"], b["n_volume"], b["n_null"], b["n_repeated"], b["sane"]) == (5, 1, 1, 0, 1, 1, 1, False)
    assert found["N"]["n_repeated"] == 1 and not found["N"]["sane"]


@pytest.mark.parametrize(("groups", "folds", "purge"), [(40, 5, 17), (12, 5, 17), (3, 5, 17), (7, 3, 2), (2, 2, 0), (1, 2, 5), (30, 4, 22)])
def test_group_splits(spark, groups, folds, purge):
    """Each fold's training groups are listed, and the last of them taken off, as one would by hand."""
    rows = [(f"S{s}", k) for k in range(groups) for s in range(1 + k % 3)] + [("S0", None)]
    want = set()
    for f in range(folds):
        own, other = [g for g in range(groups) if g % folds == f], [g for g in range(groups) if g % folds != f]
        if not own or not other:
            continue
        taken = purge if len(other) > purge else max(1, len(other) // 10)
        left = [g for g in other if g <= max(other) - taken]
        if left:
            want |= {(f, s, k, part, taken) for part, kept in (("train", left), ("val", own)) for s, k in rows if k is not None and k in kept}
    found = splits.group_splits(spark.createDataFrame(rows, "symbol string, ts int"), folds, purge)
    assert {(r["test_fold"], r["symbol"], r["ts"], r["part"], r["purged"]) for r in found.collect()} == want


def test_hash_split(spark):
    df = spark.range(20000).withColumn("k", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id")))
    parts = {"train": 0.6, "val": 0.0, "test": 0.4}
    found = {r["part"]: r["n"] for r in splits.hash_split(df, ["id", "k"], parts).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert set(found) == {"train", "test"} and abs(found["train"] / 20000 - 0.6) < 0.02
    pick = lambda d, seed: {r["id"] for r in splits.hash_split(d, ["id"], parts, seed).filter("part = 'train'").collect()}
    assert pick(df, 1) == pick(df.repartition(7, "k"), 1) != pick(df, 2)
    with pytest.raises(ValueError):
        splits.hash_split(df, ["id"], {"train": 0.5, "test": 0.4})


def test_lag_frame(spark):
    """Against plain Python: a whole segment, one too short, one too short once incomplete rows go, one without any value of a feature, one without a key."""
    series = {
        ("a", 1): [(k, k / 10, None if k in (2, 5) else float(k * k % 7), float(k)) for k in range(10)], ("a", 2): [(k, 0.5, 1.0, 1.0) for k in range(7)],
        ("b", 1): [(k, None if k == 4 else 0.5, 1.0, 1.0) for k in range(9)], ("b", 2): [(k, 0.5, None, 1.0) for k in range(12)], (None, 1): [(k, 0.5, 1.0, 1.0) for k in range(12)],
    }
    df = spark.createDataFrame([(*g, *r) for g, rs in series.items() for r in rs], "cohort string, segment int, ts int, auc double, f double, g double")
    found = segments.lag_frame(df, ["f", "g"], "auc", ["cohort", "segment"]).collect()
    rows = series["a", 1]
    middle = statistics.median(r[2] for r in rows if r[2] is not None)
    f = [middle if r[2] is None else r[2] for r in rows]
    want = {(k, rows[k][1], f[k], f[k - 1], f[k] - f[k - 1], float(k), float(k - 1), 1.0) for k in range(1, 10)}
    assert {(r["ts"], r["auc"], r["f"], r["f_lag1"], r["d_f"], r["g"], r["g_lag1"], r["d_g"]) for r in found} == want and {(r["cohort"], r["segment"]) for r in found} == {("a", 1)}
    assert segments.lag_frame(df.limit(0), ["f", "g"], "auc", ["cohort", "segment"]).collect() == []


def test_medians(spark):
    values = {"a": [3.0, 1.0, 2.0], "b": [4.0, 1.0, 1.0, 2.0], "c": [5.0, None], "d": [None]}
    found = segments.medians(spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, x double"), ["k"], ["x"]).collect()
    assert {r["k"]: r["x"] for r in found} == {"a": 2.0, "b": 1.5, "c": 5.0}


def test_gates(spark):
    df = spark.createDataFrame([(2.0, 0.9, 0.1, 0.0), (2.0, 0.9, 0.9, 0.5), (-2.0, 0.1, 0.9, 0.81), (2.0, None, None, None), (None, 0.9, 0.9, 0.9), (1.0, 0.7, 0.7, 0.8)], "p double, peak double, valley double, fall double")
    rules = [gating.Rule("peak", 0.5), gating.Rule("valley", 1.2), gating.blocked("fall")]
    made = df.withColumn("q", gating.gated("p", rules, 0.7))
    assert [r["q"] for r in made.collect()] == [1.0, pytest.approx(1.2), 0.0, 2.0, None, 1.0]
    found = {r["name"]: r for r in gating.gating_summary(made, ["q"], ["fall"]).collect()}
    assert (found["q"]["n"], found["q"]["n_marked"], found["fall"]["n"], found["fall"]["n_marked"]) == (5, 1, 5, 3) and found["fall"]["sd"] == pytest.approx(statistics.pstdev([0.0, 0.5, 0.81, 0.9, 0.8]))
    assert [tuple(r)[2:] for r in gating.gating_summary(made.limit(0), ["q"], ["fall"]).collect()] == [(0, None, None, 0)] * 2


def test_leak_status(spark):
    nan = float("nan")
    cases = [  # target, task, auc, composite, importance, models' scores, status, flags
        ("fwd_ret_5", "regression", 0.55, 0.1, 0.1, {}, "HIGH_SCORE", 1), ("up", "regression", 0.55, 0.1, 0.1, {}, "OK", 0), ("up", "regression", 0.05, 0.6, 0.8, {}, "SUSPICIOUS", 2),
        ("up", "binary", 0.55, 0.6, 0.8, {}, "INCONSISTENT", 1), ("up", "binary", 0.95, 0.9, 0.1, {"a": 0.95, "b": 0.91, "c": 0.99}, "SUSPICIOUS", 2), ("up", "binary", 0.8, 0.4, 0.1, {"a": 0.95, "b": 0.91, "c": nan, "d": None}, "OK", 0),
        ("up", "multiclass", None, 0.9, 0.9, {"a": 1.0, "b": 1.0, "c": 1.0}, "HIGH_SCORE", 1), ("up", "other", 0.93, None, None, None, "HIGH_SCORE", 1), (None, None, 0.5, 0.5, 0.5, {}, "OK", 0), ("up", "binary", nan, 0.1, 0.1, {}, "OK", 0),
    ]
    df = spark.createDataFrame([(i, *c[:6]) for i, c in enumerate(cases)], "i int, target string, task string, auc double, composite double, mean_importance double, model_scores map<string,double>")
    assert {r["i"]: (r["status"], r["n_flags"]) for r in leak_scores.leak_status(df).collect()} == {i: c[6:] for i, c in enumerate(cases)}


def test_composite_suspicion_and_gate(spark):
    df = spark.createDataFrame([("regression", -0.3, 0.1, 0.4, 3), ("regression", -0.9, 0.0, 0.4, 9), ("binary", 0.8, 0.2, 0.1, 1), ("binary", None, 0.2, 0.1, 1)], "task string, auc double, sd double, mean_importance double, n_models int")
    want = [(0.25 / 1.1 + 0.25 * 0.4 * (1 - 0.3 * 0.67)) * 1.06, (0.25 + 0.25 * 0.4 * 0.5) * 1.1, (0.4 + 0.25 / 1.2 + 0.25 * 0.1 * 1.8) * 1.02, None]
    assert [r[0] for r in df.select(leak_scores.composite()).collect()] == [w if w is None else pytest.approx(w) for w in want]
    cases = [(1.0, 0.97, 0.6, 1.0, "train_score"), (0.9, 0.6, 0.1, 0.0, "train_cv_gap"), (1.0, 0.5, 0.45, 0.0, "train_score"), (0.8, None, None, 0.0, "none"), (None, None, 0.55, 0.3, "none"), (0.9, 0.8, 0.45, 0.4, "none"), (0.9, 0.5, None, 0.0, "train_cv_gap")]
    made = spark.createDataFrame([(*c[:3], None, 5) for c in cases], "train double, cv double, top_share double, val double, n_features int")
    found = made.select(leak_scores.suspicion(), leak_scores.skip_reason(), leak_scores.skip_reason(most_features=5)).collect()
    assert [r[0] for r in found] == [pytest.approx(c[3]) for c in cases] and [r[1] for r in found] == [c[4] for c in cases]
    assert [r[2] for r in found] == [c[4] if c[4] != "none" else "n_features" for c in cases]


def test_correlation_without_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (4.0, None, 5.0), (None, 3.0, None)], "x double, y double, c double")
    r = df.select(correlation("x", "y"), correlation("x", "c"), correlation("c", "y")).first()
    assert tuple(r) == (pytest.approx(-1.0), None, None)
    found = {r["feature"]: (r["corr"], r["leak"]) for r in label_checks.near_copies(df, ["x", "c"], "y", binary=False).collect()}
    assert found["c"] == (None, False) and found["x"] == (pytest.approx(-1.0), True)


def test_metric_drift(spark):
    """Baselines by signature, limits of plain and critical metrics, absolute ones for a baseline of 0, values that aren't there."""
    nan = float("nan")
    rows = [("A", f"r{k}", k, sig, auc, pos) for k, (sig, auc, pos) in enumerate([("s", 0.5, 0.0), ("t", 9.0, 9.0), ("s", 0.52, 0.005), (None, 0.1, 0.1), ("s", 0.56, 0.005), ("s", nan, 0.0052), ("s", 0.1, None)])]
    df = spark.createDataFrame([*rows, ("B", "x", 0, "s", 1.0, 1.0)], "symbol string, run_id string, ts int, sig string, auc double, pos double")
    found = {(r["run_id"], r["metric"]): (r["baseline_id"], r["tier"], r["rel_delta"] is None) for r in drift.metric_drift(df, ["symbol"], ["sig"], ["auc", "pos"], {"pos"}).collect()}
    assert found == {("r2", "auc"): ("r0", "OK", False), ("r2", "pos"): ("r0", "WARN", True), ("r4", "auc"): ("r2", "WARN", False), ("r4", "pos"): ("r2", "OK", False), ("r5", "pos"): ("r4", "ALERT", False)}
    assert drift.metric_drift(df.limit(0), ["symbol"], ["sig"], ["auc"]).collect() == []


def test_reproducibility(spark):
    """Against plain Python: features that come and go, ties, scores that are missing, a run without spread."""
    runs = {"a": (0.5, {"f": 3.0, "g": 2.0, "h": 1.0}), "b": (0.504, {"f": 3.0, "g": 2.5, "h": 1.0}), "c": (0.6, {"f": 1.0, "k": 2.0, "h": 2.0}), "d": (None, {"f": 1.0, "k": 1.0, "h": 1.0}), "e": (0.6, {"f": 1.0})}
    rows = [("S", n, k, s, f, i) for k, (n, (s, imp)) in enumerate(runs.items()) for f, i in imp.items()]
    df = spark.createDataFrame([*rows, ("S", "a", 0, 0.5, None, 9.0), ("T", "z", 0, 0.1, "f", None)], "symbol string, run_id string, ts int, score double, feature string, importance double")

    def ranks(values):
        return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]

    def best(imp):
        return set(sorted(imp, key=lambda f: (-imp[f], f))[:2])

    want, names = {("S", "a"): (None, None, None, "no_previous_run"), ("T", "z"): (None, None, None, "no_previous_run")}, list(runs)
    for old, now in zip(names, names[1:], strict=False):
        (s0, i0), (s1, i1) = runs[old], runs[now]
        every = sorted(i0 | i1)
        p, q = ranks([i1.get(f, 0) for f in every]), ranks([i0.get(f, 0) for f in every])
        corr = statistics.correlation(p, q) if len(set(p)) > 1 and len(set(q)) > 1 else None
        delta, overlap = None if s0 is None or s1 is None else abs(s1 - s0), len(best(i0) & best(i1)) / len(best(i0) | best(i1))
        bad = lambda d, o, c: (delta is not None and delta > d) or overlap < o or (corr is not None and corr < c)  # noqa: B023, E731
        want["S", now] = (delta, overlap, corr, "unstable" if bad(0.01, 0.7, 0.7) else "borderline" if bad(0.007, 0.77, 0.77) else "stable")
    found = {(r["symbol"], r["run_id"]): (r["delta_score"], r["overlap"], r["corr"], r["status"]) for r in drift.reproducibility(df, ["symbol"], 2).collect()}
    assert found.keys() == want.keys() and want["S", "b"][3] == "stable"
    for key, values in want.items():
        assert found[key][3] == values[3] and [v is None for v in found[key]] == [v is None for v in values]
        assert [v for v in found[key][:3] if v is not None] == pytest.approx([v for v in values[:3] if v is not None])
    assert drift.reproducibility(df.limit(0), ["symbol"]).collect() == []


def test_column_report(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 5.0, 1.0, 0.5, 1.9, 0.0), (nan, 5.0, None, 0.5, -9.0, 1.0), (inf, None, nan, 0.5, 2.1, 1.1), (None, 5.0, None, 0.5, 0.0, 0.5)]
    df = spark.createDataFrame(rows, "a double, b double, y double, z double, fwd_ret_5 double, will_peak double")
    found = {r["name"]: (r["problems"], r["valid"], r["n_missing"], r["n_inf"]) for r in validation.column_report(df, ["a", "b"], ["y", "z"], ["fwd_ret_5", "will_peak"]).collect()}
    assert found == {"a": (["infinite", "missing"], True, 2, 1), "b": (["constant", "missing"], True, 1, 0), "y": (["constant", "mostly_missing"], False, 3, 0), "z": (["constant"], False, 0, 0), "fwd_ret_5": (["extreme"], True, 0, 0), "will_peak": (["outside_unit"], True, 0, 0)}
    assert [(r["problems"], r["valid"]) for r in validation.column_report(df.limit(0), ["a"], ["y"]).collect()] == [(["empty"], False)] * 2


def test_panel_stats(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, float("nan"), None), (2, 3.0, 4.0)], "ts int, a double, y double")
    found = {r["name"]: tuple(r)[1:] for r in validation.panel_stats(df, ["a"], "y").collect()}
    assert found == {"a": ("feature", 2.0, 1.0, 1.0, 3.0, 3, 2, 1, 2, 1.5), "y": ("target", 3.0, 1.0, 2.0, 4.0, 3, 2, 1, 2, 1.5)}
    assert {r["n_times"] for r in validation.panel_stats(df.limit(0), ["a"], "y").collect()} == {0}
