"""Selection, views, trends, run differences, consensus, probes and audits against plain Python."""

from __future__ import annotations

import datetime
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import consensus, evaluation, moments, probes, run_diff, stages, target_views, trends

START = datetime.datetime(2024, 1, 1)


def test_three_hundred_columns_in_one_scan(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 300)) + 1e6
    x[:, 7] = x[:, 3] + rng.normal(size=400) * 0.01
    x[:, 250] = -x[:, 3] * 2
    x[:, 9] = 5.0
    y = x[:, 3] + 0.3 * x[:, 11] + rng.normal(size=400)
    x[::7, 20] = np.nan
    names = [f"c{i:03d}" for i in range(300)]
    rows = [(*(None if np.isnan(v) else float(v) for v in r), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "y"])).repartition(3)
    corr = {(r["fa"], r["fb"]): r for r in moments.correlations(df, [*names, "y"]).collect()}
    assert len(corr) == 301 * 300 // 2
    held = ~np.isnan(x[:, 20])
    assert corr["c011", "c020"]["corr"] == pytest.approx(np.corrcoef(x[held, 11], x[held, 20])[0, 1], abs=1e-9) and corr["c011", "c020"]["n"] == held.sum()
    assert corr["c009", "y"]["corr"] is None
    found = {r["feature"]: r for r in moments.selected(df, names, "y").collect()}
    with_y = [abs(np.corrcoef(x[:, i], y)[0, 1]) for i in (3, 7, 250)]
    first = (3, 7, 250)[int(np.argmax(np.round(with_y, 12)))]
    assert found[f"c{first:03d}"]["place"] == 1 and found[f"c{first:03d}"]["kept"]
    assert {found[f"c{i:03d}"]["because"] for i in (3, 7, 250) if i != first} == {f"c{first:03d}"}
    assert found["c009"]["place"] == 300 and sum(r["kept"] for r in found.values()) == 298
    few = moments.selected(df, names, "y", count=5).filter("kept").count()
    assert few == 5 and moments.selected(df.limit(0), names[:3], "y").filter("kept").count() == 3


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(12):
        slope = 1.0 if s < 10 else -1.0
        for t in range(120):
            f, g = (float(v) for v in rng.normal(size=2))
            rows.append((f"S{s:02d}", START + datetime.timedelta(days=t), f, g, float(rng.normal()), slope * f + 0.5 * float(rng.normal())))
    rows += [(None, START, 1.0, 1.0, 1.0, 1.0), ("S00", START + datetime.timedelta(days=500), None, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, f double, g double, o double, y double").cache()


def test_views_of_every_symbol(panel):
    found = {(r["view"], r["name"]): r for r in target_views.symbol_views(panel, ["f", "g"], "y").collect()}
    assert len(found) == 25 and found["symbol", "S11"]["ic"] > 0.8 and found["leave_one_out", "S11"]["ic"] < -0.8
    pdf = panel.toPandas().dropna()
    start = target_views.split_time(panel, 0.25)
    late = pdf["ts"] >= start
    for s in ("S00", "S07", "S11"):
        train, test = pdf[~late & (pdf["symbol"] != s)], pdf[late & (pdf["symbol"] == s)]
        x = train[["f", "g"]].to_numpy()
        z = (x - x.mean(0)) / x.std(0)
        w = np.linalg.solve(z.T @ z / len(z) + 0.01 * np.eye(2), z.T @ (train["y"] - train["y"].mean()) / len(z)) / x.std(0)
        p = test[["f", "g"]].to_numpy() @ w + train["y"].mean() - x.mean(0) @ w
        r = found["leave_one_out", s]
        assert r["ic"] == pytest.approx(np.corrcoef(p, test["y"])[0, 1], abs=1e-9) and r["mse"] == pytest.approx(((p - test["y"]) ** 2).mean(), abs=1e-9)
        assert (r["n_train"], r["n_test"]) == (len(train), len(test))
    assert target_views.symbol_views(panel.limit(0), ["f"], "y").collect() == []
    assert {r["leaky"] for r in target_views.symbol_views(panel.withColumn("copy", F.col("y") + 1), ["f", "copy"], "y").collect()} == {"copy"}
    flat = target_views.symbol_views(panel.withColumn("flat", F.lit(2.0)), ["flat"], "y").collect()
    assert all(r["ic"] is None for r in flat)


def test_probes_flag_a_leak_and_pass_a_clean_panel(panel):
    held = panel.filter("symbol < 'S10'")
    clean = {r["probe"]: r for r in probes.leak_probes(held, ["f", "g"], "y", ["o"], shift=5).collect()}
    assert set(clean) == set(probes.EXPECTED) and {r["verdict"] for r in clean.values()} == {"ok"}
    assert clean["as_is"]["score"] > 0.8 and clean["held_out_symbols"]["score"] > 0.8 and abs(clean["raw_bars"]["score"]) < 0.3
    assert all(abs(clean[p]["score"]) < 0.25 for p, e in probes.EXPECTED.items() if e == "none")
    leaks = {r["probe"]: r["verdict"] for r in probes.leak_probes(held.withColumn("leak", F.col("y") + F.col("g") / 100), ["f", "leak"], "y", ["o"], shift=5).collect()}
    assert leaks["as_is"] == leaks["held_out_symbols"] == "leak" and leaks["shuffled_label"] == "ok"
    sticky = held.withColumn("y", F.when(F.col("symbol") > "S04", 1.0).otherwise(-1.0) + F.col("y") / 10).withColumn("f", F.col("y"))
    assert {r["probe"]: r["verdict"] for r in probes.leak_probes(sticky, ["f"], "y", ["o"], shift=5).collect()}["random_times"] == "leak"  # the label tells the symbol, not the time
    assert probes.leak_probes(held.limit(1), ["f"], "y", ["o"]).filter("verdict <> 'no_score'").isEmpty()


def test_trends_and_breaks(spark):
    at = lambda d: START + datetime.timedelta(days=d)
    rows = [("down", at(i), 0.9 - 0.01 * i) for i in range(20)] + [("flat", at(i), 0.5) for i in range(5)] + [("one", at(0), 0.5), ("two", at(0), 0.5), ("two", at(1), 0.6), ("two", at(2), None)]
    rows += [("step", at(i), 0.5 + 0.2 * (i >= 12) + 0.1 * (i >= 30) + 0.01 * (i % 3)) for i in range(45)]
    df = spark.createDataFrame(rows, "name string, ts timestamp, v double")
    found = {r["name"]: r for r in trends.trends(df, ["name"], "v", 7.0, F.lit(at(20)).cast("timestamp")).collect()}
    assert {n: r["status"] for n, r in found.items()} == {"down": "ok", "flat": "no_variance", "one": "first_run", "two": "insufficient_runs", "step": "ok"}
    down = found["down"]
    assert down["slope"] == pytest.approx(-0.01) and down["intercept"] == pytest.approx(0.9) and down["estimate"] == pytest.approx(0.7) and "negative_slope" in down["alerts"]
    x, y = np.arange(45.0), np.array([r[2] for r in rows if r[0] == "step"])
    w = 0.5 ** ((20 - x) / 7)
    b, a = np.polyfit(x, y, 1, w=np.sqrt(w))
    rest = np.sqrt((w * (y - a - b * x) ** 2).sum() / w.sum() + 1e-12)
    assert (found["step"]["slope"], found["step"]["residual_sd"]) == (pytest.approx(b), pytest.approx(rest))
    ewma, alpha = y[0], 1 - 0.5 ** (1 / 7)
    for v in y[1:]:
        ewma = alpha * v + (1 - alpha) * ewma
    assert found["step"]["ewma"] == pytest.approx(ewma)
    cuts = {(r["name"], r["nth"]): r for r in trends.breaks(df.filter("name IN ('step', 'flat', 'two')"), ["name"], "v").collect()}
    assert set(cuts) == {("step", 13), ("step", 31)}
    assert cuts["step", 31]["before"] == pytest.approx(y[12:30].mean() if cuts["step", 31]["round"] == 2 else y[:30].mean()) and cuts["step", 31]["after"] == pytest.approx(y[30:].mean())
    signed = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, None), ("b", 1, "z")], "name string, ts int, s string")
    assert [(r["name"], r["nth"], r["previous"], r["signature"]) for r in trends.changes(signed, ["name"], "s").collect()] == [("a", 3, "x", "y")]
    assert trends.trends(df.limit(0), ["name"], "v", 7.0, F.current_timestamp()).collect() == [] and trends.breaks(df.limit(0), ["name"], "v").collect() == []


def test_run_differences(spark):
    day = lambda d: START + datetime.timedelta(days=d)
    rows = [
        ("s", "r1", day(1), "k", {"a": "1", "b": "2"}, {"auc": 0.6, "n": 10.0}), ("s", "r2", day(2), "k", {"a": "1", "b": "3", "c": "9"}, {"auc": 0.7, "n": 10.0, "x": float("nan")}),
        ("s", "r3", day(3), "other", {"a": "2"}, {"auc": 0.9}), ("s", "r4", day(4), "k", {"a": "2"}, {"auc": 0.5, "x": 1.0}), ("s", "r5", day(5), None, None, None), ("t", "r6", day(1), "k", {"a": None}, {"auc": 0.1}), ("t", "r7", day(2), "k", {}, {"auc": 0.1})]
    df = spark.createDataFrame(rows, "series string, run_id string, ts timestamp, signature string, settings map<string,string>, metrics map<string,double>")
    found = {r["run_id"]: r for r in run_diff.run_diff(df, "auc", ["a"]).collect()}
    pick = lambda c: [found[f"r{i}"][c] for i in range(1, 8)]
    assert pick("previous_id") == [None, "r1", "r2", "r3", "r4", None, "r6"]
    assert pick("comparable_id") == [None, "r1", None, "r2", None, None, "r6"]
    assert pick("best_id") == ["r1", "r2", "r3", "r2", None, "r6", "r6"]
    assert pick("changed") == [[], ["b", "c"], ["a", "b", "c"], [], ["a"], [], ["a"]]
    assert pick("comparability") == ["first", "comparable", "none", "earlier", "none", "first", "comparable"]
    assert pick("severity") == ["none", "minor", "critical", "major", "critical", "none", "critical"]
    assert set(found["r2"]["deltas"]) == {"auc"} and found["r4"]["deltas"]["auc"]["share"] == pytest.approx(-2 / 7)
    assert run_diff.run_diff(df.limit(0), "auc", []).collect() == []


def test_consensus_against_plain_python(spark):
    rng = np.random.default_rng(1)
    rows = [(f, s, f"x{i}", round(float(rng.random()), 3)) for f in ("tree", "line", "flat") for s in ("A", "B", "C") for i in range(8) if rng.random() < 0.6]
    weights, gate = {"tree": 2.0, "flat": 0.5}, {"x0": 1.0, "x1": 0.0, "x2": 0.3}
    df = spark.createDataFrame([*rows, ("line", "A", "x9", None), ("none", "A", None, 1.0), ("off", "A", "x0", 9.0)], "family string, symbol string, feature string, importance double")
    gates = spark.createDataFrame(list(gate.items()), "feature string, score double")
    for within, across in (("mean", "mean"), ("median", "median"), ("mean", "geometric")):
        found = {r["feature"]: r for r in consensus.consensus(df, {**weights, "off": 0.0}, gates, within, across).collect()}
        expected = {}
        for x in {r[2] for r in rows}:
            scores = {}
            for f in ("flat", "line", "tree"):
                ran = sorted({r[1] for r in rows if r[0] == f} | ({"A"} if f == "line" else set()))
                v = [next((r[3] for r in rows if r[:3] == (f, s, x)), 0.0) for s in ran]
                scores[f] = (statistics.mean(v) if within == "mean" else statistics.median(v)) * weights.get(f, 1.0)
            v = list(scores.values())
            base = {"mean": statistics.mean, "median": statistics.median, "geometric": lambda v: statistics.geometric_mean([max(u, 1e-6) for u in v])}[across](v)
            effect = 0.2 if gate.get(x, 0.5) >= 1 else -0.3 if gate.get(x, 0.5) <= 0 else 0.0
            if any(u > 0 for u in v):
                expected[x] = (base, effect, base + effect, sum(u > 0 for u in v), statistics.stdev(v), scores)
        assert set(found) == set(expected)
        order = sorted(expected, key=lambda x: (-round(expected[x][2], 12), x))
        for place, x in enumerate(order, 1):
            r, e = found[x], expected[x]
            assert r["place"] == place and r["agree"] == e[3] and r["agree_pct"] == pytest.approx(100 * e[3] / 3)
            assert (r["base"], r["gate_effect"], r["final"], r["spread"]) == tuple(pytest.approx(v) for v in (e[0], e[1], e[2], e[4])) and r["scores"] == {k: pytest.approx(v) for k, v in e[5].items()}
    assert consensus.consensus(df.limit(0), weights).collect() == []
    assert all(r["gate_effect"] == 0 and r["agree"] >= 2 for r in consensus.consensus(df, {}, least_families=2).collect())


def test_quantiles_of_many_columns(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(3000, 4)), 2)
    x[:, 3] = 7.0
    rows = [tuple(None if (i + j) % 11 == 0 else float(v) for j, v in enumerate(r)) + (None,) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    ps = [0.0, 0.25, 0.5, 0.75, 0.9999, 1.0]
    found = evaluation.exact_quantiles(df, list("abcde"), ps)
    for j, c in enumerate("abcd"):
        held = np.array([r[j] for r in rows if r[j] is not None])
        for p in ps:
            assert found[c, p] == pytest.approx(np.quantile(held, p)), (c, p)
    assert found["e", 0.5] is None and set(evaluation.exact_quantiles(df.limit(0), ["a"], [0.5]).values()) == {None}
    kept = evaluation.fences(df, list("abcde")).filter("inside").count()
    q = {c: np.quantile([r[j] for r in rows if r[j] is not None], [0.25, 0.75]) for j, c in enumerate("abcd")}
    inside = lambda j, v: v is None or q["abcd"[j]][0] - 1.5 * (q["abcd"[j]][1] - q["abcd"[j]][0]) <= v <= q["abcd"[j]][1] + 1.5 * (q["abcd"[j]][1] - q["abcd"[j]][0])
    assert kept == sum(all(inside(j, r[j]) for j in range(4)) for r in rows) < 3000
    wild = df.select("a").union(spark.createDataFrame([(1e6,), (None,)], "a double"))
    assert evaluation.without_extremes(wild, "a").agg(F.max("a")).first()[0] < 10 and evaluation.without_extremes(wild, "a").filter("a IS NULL").count() == wild.filter("a IS NULL").count()
    two = spark.createDataFrame([(0.0,), (1.0,)], "a double")
    assert evaluation.without_extremes(two, "a", sigmas=0.5).count() == 2 and evaluation.without_extremes(two.limit(0), "a").count() == 0


def test_audit_of_stages(spark):
    t = lambda names: spark.createDataFrame([("v", n) for n in names], "view string, feature string")
    facts = stages.stage_facts({"requested": t(["a", "b", "c", "d", "e", "a", None]), "allowed": t(["a", "b", "c", "d"]), "present": t(["a", "b", "c", "z"]), "kept": t(["a", "b"]), "used": t(["a"])})
    notes = spark.createDataFrame([("v", "c", "kept", "constant"), ("v", "a", "kept", "no matter")], "view string, feature string, stage string, reason string")
    audited = stages.audit(facts, given=notes)
    found = {r["feature"]: (r["last_stage"], r["lost_at"], r["reason"]) for r in audited.collect()}
    assert found == {"a": ("used", None, "ok"), "b": ("kept", "used", "not_selected"), "c": ("present", "kept", "constant"), "d": ("allowed", "present", "not_in_data"), "e": ("requested", "allowed", "not_in_registry"), "z": ("present", "kept", "unexpected_present")}
    assert {r["reason"]: (r["n"], r["present"]) for r in stages.stage_counts(audited).collect()}["ok"] == (1, 1)
    assert stages.audit(facts.limit(0)).collect() == [] and stages.audit(facts).filter("feature = 'c'").first()["reason"] == "dropped_by_quality"
