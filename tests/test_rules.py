"""Routes, decisions, intervals, copies and changes of labels, against plain Python or by hand."""

from __future__ import annotations

import datetime
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators import decisions, intervals, label_checks, routes

DAY = datetime.datetime(2024, 1, 2)
SCORES = "target string, symbol string, auc double"


def test_summary(spark):
    rows = [("t", "A", 0.7), ("t", "B", 0.5), ("t", "C", 0.6), ("t", "C", 0.2), ("t", "D", None), ("none", "A", None), (None, "A", 0.9)]
    found = {r["target"]: r.asDict() for r in routes.target_summary(spark.createDataFrame(rows, SCORES)).collect()}
    t = found["t"]
    assert (t["n_symbols"], t["median"], t["lo"], t["hi"], t["winners"]) == (3, 0.6, 0.5, 0.7, ["A", "C"]) and t["mean"] == pytest.approx(0.6) and t["iqr"] == pytest.approx(0.1) and t["frac_good"] == pytest.approx(2 / 3)
    assert (found["none"]["n_symbols"], found["none"]["frac_good"], found["none"]["winners"], found["none"]["mean"]) == (0, 0.0, [], None) and len(found) == 2


def test_target_routes(spark):
    cases = {  # target: its own score, its symbols' scores, route, reason
        "failed_good": (None, [0.7, 0.4], "SYMBOL_SPECIFIC", "cross_failed"), "failed_bad": (None, [0.4], "BLOCKED", "no_viable_route"), "failed_alone": (None, [], "BLOCKED", "no_viable_route"),
        "leak": (0.9, [0.7], "BLOCKED", "suspicious"), "leak_symbol": (0.7, [0.7, 0.95], "BLOCKED", "suspicious_symbol"), "strong": (0.65, [0.6, 0.5], "CROSS_SECTIONAL", "strong"),
        "weak": (0.6, [0.6, 0.1, 0.1], "SYMBOL_SPECIFIC", "weak_but_good_symbols"), "few": (0.7, [0.8, 0.1, 0.1], "BOTH", "concentrated"), "alone": (0.7, [], "CROSS_SECTIONAL", "default"), "poor": (0.5, [0.5], "CROSS_SECTIONAL", "default"),
    }
    cross = spark.createDataFrame([(t, c[0]) for t, c in cases.items() if t != "failed_bad"], "target string, auc double")
    scores = spark.createDataFrame([(t, f"S{i}", a) for t, c in cases.items() for i, a in enumerate(c[1])], SCORES)
    found = {r["target"]: (r["route"], r["reason"]) for r in routes.target_routes(cross, scores).collect()}
    assert found == {t: c[2:] for t, c in cases.items()}
    assert routes.target_routes(cross.limit(0), scores.limit(0)).collect() == []


def test_candidates(spark):
    cross = spark.createDataFrame([("a", 0.6), ("b", 0.7), (None, 0.1)], "target string, auc double")
    scores = spark.createDataFrame([("a", "X", 0.5), ("c", "X", 0.4)], SCORES)
    found = {(r["target"], r["symbol"], r["level"], r["mode"]) for r in routes.candidates(cross, scores).collect()}
    assert found == {("a", None, "cross_sectional", "both"), ("a", "X", "symbol", "both"), ("b", None, "cross_sectional", "cross_sectional_only"), ("c", "X", "symbol", "symbol_only"), (None, None, "cross_sectional", "cross_sectional_only")}


def test_horizons(spark):
    names = {"fwd_ret_10m": (10, "short"), "y_will_peak_60m_0.8": (60, "medium"), "fwd_ret_4h": (240, "long"), "fwd_ret_5d": (7200, "very_long"), "fwd_ret_1d": (1440, "very_long"), "y": (None, "default"), "10max": (None, "default"), None: (None, "default")}
    df = spark.createDataFrame([(n,) for n in names], "t string").withColumn("m", routes.horizon_minutes(F.col("t")))
    assert {r["t"]: (r["m"], r["tier"]) for r in df.withColumn("tier", routes.horizon_tier(F.col("m"))).collect()} == names


FACTS = "score double, rows long, stability string, leak string, task string"


@pytest.mark.parametrize("both", ["BOTH", "CROSS_SECTIONAL"])
def test_symbol_routes(spark, both):
    b, big = "BINARY_CLASSIFICATION", 60_000
    sides = {"STRONG": (0.7, big, "STABLE", "SAFE", b), "WEAK": (0.59, big, "STABLE", "SAFE", b), "EXPERIMENTAL": (0.53, big, "UNKNOWN", "SAFE", b), "small": (0.9, 10, "STABLE", "SAFE", b), "leak": (0.9, big, "STABLE", "BLOCKED", b), "low": (0.4, big, "STABLE", "SAFE", b), "unstable": (0.9, big, "DIVERGED", "SAFE", b), "null": (None, None, None, None, None)}
    state = {k: k if k.isupper() else "DISALLOWED" for k in sides}
    cross = spark.createDataFrame([(f"{c}_y_10m", *f) for c, f in sides.items()] + [("lonely_5d", *sides["STRONG"])], f"target string, {FACTS}")
    local = spark.createDataFrame([(f"{c}_y_10m", s, *f) for c in sides for s, f in sides.items()] + [("orphan", "STRONG", *sides["STRONG"])], f"target string, symbol string, {FACTS}")
    found = {(r["target"], r["symbol"]): r for r in routes.symbol_routes(cross, local, routes.RouteRules(both=both)).collect()}
    assert len(found) == len(sides) ** 2 + 2
    for c in sides:
        for s in sides:
            r, no_c, no_s = found[f"{c}_y_10m", s], state[c] == "DISALLOWED", state[s] == "DISALLOWED"
            assert (r["cross_state"], r["local_state"], r["tier"]) == (state[c], state[s], "short")
            assert r["route"] == ("BLOCKED" if no_c and no_s else "SYMBOL_SPECIFIC" if no_c else "CROSS_SECTIONAL" if no_s else "EXPERIMENTAL_ONLY" if "EXPERIMENTAL" in (c, s) else both)
    assert (found["lonely_5d", None]["route"], found["lonely_5d", None]["tier"], found["orphan", "STRONG"]["route"]) == ("CROSS_SECTIONAL", "very_long", "SYMBOL_SPECIFIC")


def test_tiers_of_tasks(spark):
    scale = {"classification": 0.6, "regression": -0.2, "regression/short": -0.1, "regression/very_long": -0.5}
    side = routes.SideRules(1, scale, scale, ("STABLE",))
    rules = routes.RouteRules(side, side, experimental_score=None)
    rows = [("a_10m", "S", -0.15, "REGRESSION", "DISALLOWED"), ("a_2h", "S", -0.15, "REGRESSION", "STRONG"), ("a_5d", "S", -0.45, "REGRESSION", "STRONG"), ("a_1h", "T", -0.45, "REGRESSION", "DISALLOWED"), ("a_10m", "C", 0.55, "BINARY_CLASSIFICATION", "DISALLOWED"), ("a_10m", "D", 0.65, "MULTICLASS_CLASSIFICATION", "STRONG")]
    local = spark.createDataFrame([(t, s, x, 5, "STABLE", None, k) for t, s, x, k, _ in rows], f"target string, symbol string, {FACTS}")
    found = {(r["target"], r["symbol"]): r["local_state"] for r in routes.symbol_routes(local.limit(0), local, rules).collect()}
    assert found == {(t, s): e for t, s, _, _, e in rows}


RUNS = "series string, run_id string, ts timestamp, jaccard double, entropy double, changed boolean, auc double, n_features int, pos_rate double"


def runs(name, *values):
    return [(name, f"{name}{i}", DAY + datetime.timedelta(days=i), *v) for i, v in enumerate(values)]


def test_decisions(spark):
    calm, rows = (0.9, 0.5, False, 0.7, 20, 0.5), []
    rows += runs("calm", *[calm] * 6) + runs("short", calm, (0.1, 9.0, True, 0.1, 90, 0.9)) + runs("jaccard", calm, calm, (0.3, *calm[1:])) + runs("slow", calm, (0.35, *calm[1:]), (0.3, *calm[1:]))
    rows += runs("entropy", calm, calm, (0.9, 1.6, *calm[2:])) + runs("gaps", (0.9, *calm[1:]), (0.3, *calm[1:]), (None, *calm[1:]))
    rows += runs("changes", calm, *[(0.9, None, k % 2 == 0, *calm[3:]) for k in range(5)]) + runs("entropy_first", *[(0.9, 0.1, True, *calm[3:])] * 5)
    rows += runs("explosion", calm, calm, (*calm[:3], 0.68, 31, 0.5)) + runs("better", calm, calm, (*calm[:3], 0.72, 31, 0.5)) + runs("balance", (*calm[:5], 0.9), calm, calm, (*calm[:5], 0.61)) + runs(None, calm, calm, (*calm[:5], 0.7))
    df = spark.createDataFrame(rows, RUNS)
    found = decisions.decisions(df.repartition(5), ["series"])
    assert found.count() == 4 * len({r[0] for r in rows})
    assert {(r["series"], r["rule"], r["level"], r["run_id"]) for r in found.filter("triggered").collect()} == {
        ("jaccard", "feature_instability", 2, "jaccard2"), ("gaps", "feature_instability", 2, "gaps2"), ("entropy", "route_instability", 2, "entropy2"), ("changes", "route_instability", 2, "changes5"),
        ("explosion", "feature_explosion_decline", 2, "explosion2"), ("balance", "class_balance_drift", 1, "balance3"), (None, "class_balance_drift", 1, "None2")}
    assert {(r["level"], r["action"], r["reason"]) for r in found.filter("NOT triggered").collect()} == {(0, None, None)}
    assert decisions.decisions(df.select("series", "run_id", "ts"), ["series"]).filter("triggered").collect() == [] and decisions.decisions(df.limit(0), ["series"]).collect() == []


def expected_interval(minutes):
    gaps = [b - a for a, b in zip(minutes, minutes[1:]) if 0 < b - a <= 1440]
    if not gaps:
        return 0, None, 5, "no_gaps"
    near = [g for g in gaps if g <= 10 * statistics.median(gaps)]
    m = statistics.median(near)
    best = min((1, 5, 15, 30, 60), key=lambda c: abs(c - m))
    return (len(near), m, best, "snapped") if abs(best - m) <= 0.2 * best else (len(near), m, 5, "odd")


def test_intervals(spark):
    series = {"five": [*range(0, 390, 5), *range(1440, 1800, 5), 9000], "half": [0, 29, 61, 90, 121], "odd": [0, 9, 18, 27], "hour": [0, 60, 120, 120, 1000, 1060], "one": [7], "weekly": [0, 10080, 20160], "even": [0, 10, 20, 30]}
    rows = [(s, DAY + datetime.timedelta(minutes=m)) for s, ms in series.items() for m in ms] + [("one", None)]
    found = intervals.bar_intervals(spark.createDataFrame(rows, "symbol string, ts timestamp").repartition(4))
    assert {r["symbol"]: (r["n_gaps"], r["median_gap"], r["minutes"], r["status"]) for r in found.collect()} == {s: expected_interval(sorted(ms)) for s, ms in series.items()}


def test_near_copies(spark):
    rows = [(float(i % 2), float(i % 2), 1.0 - i % 2, float(i % 2) if i else 0.5, None if i % 5 == 0 else float(i % 2), float(i), i % 2 * 1.0) for i in range(2000)] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "y double, same double, flipped double, nearly double, holes double, other double, hour_sin double")
    names = df.columns[1:]
    found = {r["feature"]: r for r in label_checks.near_copies(df, names, "y", True).collect()}
    assert {f for f, r in found.items() if r["leak"]} == {"same", "flipped", "nearly"} and {r["n"] for r in found.values()} == {2000}
    assert found["nearly"]["match"] == 0.9995 and found["holes"]["match"] == 0.8 and found["hour_sin"]["calendar"]
    line = spark.range(100).selectExpr("id * 2.0 AS y", "id + 3.0 AS same", "pow(id - 50, 2) AS bent", "7.0 AS flat", "CAST(NULL AS DOUBLE) AS none")
    assert {r["feature"]: r["leak"] for r in label_checks.near_copies(line, ["same", "bent", "flat", "none"], "y", False).collect()} == {"same": True, "bent": False, "flat": False, "none": False}
    assert [r["match"] for r in label_checks.near_copies(line.limit(0), ["same"], "y", True).collect()] == [None]


def test_label_changes(spark):
    old = [("A", i, float(i % 3)) for i in range(50)] + [("B", 1, 1.0), ("B", 2, None)]
    new = [("A", i, float(i % 3) if i % 4 else 9.0) for i in range(10, 60)] + [("B", 2, 3.0), ("C", 1, 1.0)]
    schema = "symbol string, ts int, y double"
    found = {r["symbol"]: r for r in label_checks.label_changes(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["symbol", "ts"], "y", "symbol", 3).collect()}
    a = found["A"]
    assert (a["n_old"], a["n_new"], a["only_old"], a["only_new"], a["n_both"], a["n_diff"]) == (50, 50, 10, 10, 40, 10) and a["match_rate"] == 0.75
    assert [(e["ts"], e["old"], e["new"]) for e in a["examples"]] == [(12, 0.0, 9.0), (16, 1.0, 9.0), (20, 2.0, 9.0)] and a["old_mean"] == pytest.approx(sum(i % 3 for i in range(10, 50)) / 40) and a["new_max"] == 9.0
    b = found["B"]
    assert (b["n_old"], b["n_new"], b["only_old"], b["n_both"], b["match_rate"], b["new_count"], b["old_count"], b["examples"]) == (2, 1, 1, 0, None, 1, 0, None) and found["C"]["only_new"] == 1


def test_interactions():
    from barloom.operators import interactions

    made = interactions.built(["volume", "ret_5m", "macd", "momentum_5", "mom_5d", "close"])
    assert set(made) == {"ret2_5m", "vol_x_ret_5m", "ret_x_mom_5d", "vol_x_mom_5d", "macd_x_vol", "macd_x_volume", "macd_x_ret", "momentum_x_vol", "roc_x_vol", "price_x_volume"}
    assert made["momentum_x_vol"] == "CAST(momentum_5 AS DOUBLE) * volume" and made["roc_x_vol"] == "CAST(mom_5d AS DOUBLE) * volume" and interactions.built([]) == {}


def test_interactions_over_a_panel(spark):
    from barloom.operators import interactions

    df = spark.createDataFrame([(2, 3.0, 9.0), (None, 3.0, 9.0)], "volume long, adx_14 double, adx_x_vol double")
    assert [tuple(r) for r in interactions.with_interactions(df).select("adx_14", "volume", "adx_x_vol").collect()] == [(3.0, 2, 6.0), (3.0, None, None)]


def plain_tau(a, b):
    common = [f for f in a if f in b]
    at = [b.index(f) for f in common]
    signs = [1 if y > x else -1 for i, x in enumerate(at) for y in at[i + 1 :]]
    return sum(signs) / len(signs) if len(common) >= 3 else None


def test_stability(spark):
    import random

    from barloom.operators import stability

    rng, rankings = random.Random(4), {}
    for s in ("A", "B"):
        for i in range(6):
            names = [f"f{k}" for k in range(12) if rng.random() < 0.9]
            rng.shuffle(names)
            rankings[s, i] = names
    rankings["C", 0], rankings["C", 1] = ["x", "y"], ["y", "x"]
    rankings["D", 0] = ["x"]
    rows = [(s, f"r{i}", DAY + datetime.timedelta(days=i), f, 1.0 / (k + 1)) for (s, i), names in rankings.items() for k, f in enumerate(names)] + [("A", "r0", DAY, None, 9.0)]
    df = spark.createDataFrame(rows, "series string, run_id string, ts timestamp, feature string, importance double").repartition(5)
    found = {(r["series"], r["run_id"]): r for r in stability.pairs(df, ["series"], 4).collect()}
    assert set(found) == {(s, f"r{i}") for s, i in rankings if (s, i - 1) in rankings}
    for (s, run), r in found.items():
        new, old = rankings[s, int(run[1:])], rankings[s, int(run[1:]) - 1]
        assert r["overlap"] == pytest.approx(len(set(new[:4]) & set(old[:4])) / len(set(new[:4]) | set(old[:4]))) and r["tau"] == (None if plain_tau(old, new) is None else pytest.approx(plain_tau(old, new)))
    told = {r["series"]: r for r in stability.summary(stability.pairs(df, ["series"], 4), ["series"]).collect()}
    overlaps = [r["overlap"] for (s, _), r in found.items() if s == "A"]
    assert told["A"]["mean_overlap"] == pytest.approx(statistics.mean(overlaps)) and told["A"]["sd_overlap"] == pytest.approx(statistics.pstdev(overlaps)) and told["A"]["n_comparisons"] == 5
    assert (told["C"]["status"], told["C"]["mean_tau"]) == ("stable", None) and "D" not in told and stability.pairs(df.limit(0), ["series"]).collect() == []


def test_usable_snapshots(spark):
    from barloom.operators import stability

    rows = [("A", "r1", "u", "s", "t"), ("A", "r2", "u", "s", "t"), ("A", "r3", "v", "s", "t"), ("A", "r4", "u", None, "t"), ("A", "r5", "u", "", "t"), ("B", "r1", "u", "s", "t"), ("B", "r2", "u", "s", "z"), ("C", "r1", "b", "s", "t"), ("C", "r2", "a", "s", "t"), (None, "r1", None, "s", "t")]
    df = spark.createDataFrame(rows, "series string, run_id string, universe string, data string, split string")
    found = {(r["series"], r["run_id"]): r["refused"] for r in stability.usable(df, ["series"], ["data", "split"]).collect()}
    assert found == {("A", "r1"): None, ("A", "r2"): None, ("B", "r1"): "split", ("B", "r2"): "split", ("C", "r2"): None, (None, "r1"): None}


def test_run_rules(spark):
    from barloom.operators import run_rules

    good = ("60", "60m", "1h", "45m", "c", "f", 5, 0.7)
    kinds = {"good": good, "purge": ("1h30m", "85.0m", "90m", None, *good[4:]), "embargo": ("1d", "1440", "23h", None, *good[4:]), "lookback": ("5m", "1h", None, "2h", *good[4:]), "text": ("soon", "5m", "5m", None, *good[4:]), "score": (*good[:7], 0.95), "nan": (*good[:7], float("nan")), "nothing": (None,) * 8}
    rows = [(k, "r0", DAY, *v) for k, v in kinds.items()] + [(k, f"r{i}", DAY + datetime.timedelta(days=i), *v) for k, vs in {"data": [good, (*good[:5], "g", *good[6:]), (*good[:4], "d", "h", *good[6:])], "folds": [good, (*good[:6], 6, 0.7)]}.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "series string, run_id string, ts timestamp, horizon string, purge string, embargo string, lookback string, cohort string, fingerprint string, folds int, score double")
    assert {tuple(r) for r in run_rules.violations(df, ["series"]).collect()} == {("purge", "r0", "purge_below_horizon", "critical"), ("embargo", "r0", "embargo_below_horizon", "critical"), ("lookback", "r0", "purge_below_lookback", "critical"), ("text", "r0", "duration_unreadable", "critical"), ("score", "r0", "suspicious_score", "warning"), ("data", "r1", "fingerprint_changed", "critical"), ("folds", "r1", "folds_changed", "warning")}
    assert run_rules.violations(df.limit(0), ["series"]).collect() == []


def test_multiclass(spark):
    import math

    from barloom.operators import evaluation

    rows = [("a", 0, [0.5, 0.3, 0.2]), ("a", 1, [0.5, 0.3, 0.2]), ("a", 2, [0.0, 0.0, 1.0]), ("a", None, [1.0, 0.0, 0.0]), ("a", 1, None), ("b", 1, [0.4, 0.4, 0.2]), (None, 0, [2.0, 2.0])]
    found = {r["g"]: r for r in evaluation.multiclass(spark.createDataFrame(rows, "g string, y int, p array<double>"), "y", "p", ["g"]).collect()}
    a = found["a"]
    assert a["n"] == 3 and a["accuracy"] == pytest.approx(2 / 3) and a["cross_entropy"] == pytest.approx(-(math.log(0.5) + math.log(0.3)) / 3, abs=1e-6) and a["macro_f1"] == pytest.approx((2 / 3 + 0 + 1) / 3)
    assert (found["b"]["accuracy"], found["b"]["macro_f1"]) == (0.0, 0.0) and found[None]["cross_entropy"] == pytest.approx(math.log(2))
