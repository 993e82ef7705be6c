"""Leak probes: the same score on data from which the signal has been taken out, where it has to collapse."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.moments import fit_quality, products, ridge
from barloom.operators.target_views import split_time

RESULT = "probe string, n_train long, n_test long, score double, expected string, verdict string"
#: What each probe's score has to do: stay, collapse, or fall behind the whole's.
EXPECTED = {"as_is": "high", "held_out_symbols": "high", "raw_bars": "lower", "shuffled_label": "none", "shifted_label": "none", "random_times": "none"}


def probe_frame(df: DataFrame, features: list[str], label: str, raw: list[str], shift: int, test_share: float, held_out: float, seed: str = "") -> DataFrame:
    """probe, part (train or test), x0.. and y: all probes of a panel(symbol, ts, features, label, raw) in one table.

    as_is: rows before and after the split time. held_out_symbols: symbols dealt out by hash, trained on the rest over all times. raw_bars: the raw
    columns instead of the features. shuffled_label: labels dealt anew by hash within each time. shifted_label: the label `shift` rows later.
    random_times: within each symbol, features of one row meet the label of another, dealt by hash. Dealing is by ranks within a time or a
    symbol, joined on these ranks, so no rows meet that the panel's own windows don't bring together.
    """
    start = split_time(df, test_share)
    held = df.filter(F.col(label).isNotNull()).select("symbol", "ts", *dict.fromkeys([*features, *raw]), F.col(label).alias("y"))
    in_time = F.when(F.col("ts") >= F.lit(start), "test").otherwise("train")
    width = max(len(features), len(raw))
    chance = F.pmod(F.xxhash64(F.concat("symbol", F.lit(seed))), F.lit(10_000)) / 10_000

    def rows(probe: str, frame: DataFrame, columns: list[str], part, y: str = "y") -> DataFrame:
        x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)] + [F.lit(0.0).alias(f"x{i}") for i in range(len(columns), width)]
        return frame.select(F.lit(probe).alias("probe"), part.alias("part"), *x, F.col(y).cast("double").alias("y"))

    by_hash = F.md5(F.concat_ws("|", F.lit(seed), F.col("ts").cast("string"), "symbol"))

    def dealt(keys: list[str], own: str) -> DataFrame:
        """Labels dealt anew within keys: the n-th row in the order of `own` gets the label of the n-th row in the order of hashes."""
        at, other = Window.partitionBy(*keys).orderBy(own), Window.partitionBy(*keys).orderBy(by_hash)
        labels = held.select(*keys, F.row_number().over(other).alias("nth"), F.col("y").alias("y_dealt"))
        return held.withColumn("nth", F.row_number().over(at)).join(labels, [*keys, "nth"])

    later = held.withColumn("y_later", F.lead("y", shift).over(Window.partitionBy("symbol").orderBy("ts")))
    parts = [
        rows("as_is", held, features, in_time), rows("held_out_symbols", held, features, F.when(chance < held_out, "test").otherwise("train")), rows("raw_bars", held, raw, in_time),
        rows("shuffled_label", dealt(["ts"], "symbol"), features, in_time, "y_dealt"), rows("shifted_label", later, features, in_time, "y_later"), rows("random_times", dealt(["symbol"], "ts"), features, in_time, "y_dealt"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def leak_probes(df: DataFrame, features: list[str], label: str, raw: list[str], shift: int = 52, test_share: float = 0.25, held_out: float = 0.2, penalty: float = 0.01, too_good: float = 0.95, collapsed: float = 0.1) -> DataFrame:
    """RESULT, a row a probe: score is the correlation of a ridge's prediction with the label on the test part.

    verdict: `leak` if as_is or held_out_symbols tells the label better than too_good, or raw_bars does; `leak` if a probe that has to collapse keeps
    more than `collapsed` of correlation, give or take three standard errors of its test rows; `no_score` without rows to fit and test; else `ok`.
    Every probe's sums of products come from one scan of the probe frame; fits and scores are made of them, a matrix a probe.
    """
    width = max(len(features), len(raw))
    xs = [f"x{i}" for i in range(width)]
    sums = products(probe_frame(df, features, label, raw, shift, test_share, held_out), ["probe", "part"], xs, "y")
    each = sums.groupBy("probe").agg(*(F.max(F.when(F.col("part") == p, F.col("m"))).alias(p) for p in ("train", "test")))
    size = width + 2

    def fits(batches):
        for batch in batches:
            out = []
            for probe, a, b in zip(batch["probe"], batch["train"], batch["test"], strict=True):
                train, test = (None if m is None else pd.Series(m).to_numpy(dtype=float).reshape(size, size) for m in (a, b))
                score = fit_quality(test, ridge(train, penalty))[0] if train is not None and test is not None and min(train[0, 0], test[0, 0]) > 1 else None
                expected = EXPECTED[probe]
                bound = too_good if expected != "none" else collapsed + 3 / max(test[0, 0] if test is not None else 1.0, 1.0) ** 0.5
                out.append((probe, int(round(train[0, 0])) if train is not None else 0, int(round(test[0, 0])) if test is not None else 0, score, expected, "no_score" if score is None else "leak" if abs(score) > bound else "ok"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    return each.mapInPandas(fits, RESULT)
