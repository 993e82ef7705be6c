"""Which targets are modelled over all symbols, which for single symbols, which not at all; every rule is a row of scores against a threshold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def target_summary(scores: DataFrame, good: float = 0.60) -> DataFrame:
    """scores(target, symbol, auc) to a row a target: n_symbols, mean, median, lo, hi, iqr, frac_good and winners, the sorted symbols of `good` or more.

    Null scores and null targets don't count; a target without scores has n_symbols 0, frac_good 0, no winners and null statistics. Of repeated rows of
    a target and symbol the highest score counts. Partial aggregates go before the shuffle; a target's list is as long as there are symbols."""
    each = scores.filter("target IS NOT NULL").groupBy("target", "symbol").agg(F.max("auc").alias("auc"))
    wins = F.col("auc") >= good
    return each.groupBy("target").agg(
        F.count("auc").alias("n_symbols"), F.avg("auc").alias("mean"), F.percentile("auc", 0.5).alias("median"), F.min("auc").alias("lo"), F.max("auc").alias("hi"),
        (F.percentile("auc", 0.75) - F.percentile("auc", 0.25)).alias("iqr"), F.coalesce(F.try_divide(F.count_if(wins), F.count("auc")), F.lit(0.0)).alias("frac_good"),
        F.array_sort(F.collect_list(F.when(wins, F.col("symbol")))).alias("winners"))


def target_routes(cross: DataFrame, scores: DataFrame, strong: float = 0.65, good: float = 0.60, least_share: float = 0.5, suspicious: float = 0.90, suspicious_symbol: float = 0.95, wide: float = 0.15) -> DataFrame:
    """cross(target, auc), a target's score over all symbols, and scores(target, symbol, auc) to the summary of each target with route and reason.

    A null or missing score over all symbols is a failed fit: the target goes to single symbols if one of them is good, else it is blocked. Scores too
    good to be true block. Strong with enough good symbols goes to the cross-section, weak with a good symbol to single symbols, strong with few good
    symbols or scores spread wider than `wide` to both; what is left goes to the cross-section. Of repeated rows of a target the highest counts."""
    whole = cross.filter("target IS NOT NULL").groupBy("target").agg(F.max("auc").alias("auc"))
    rows = whole.join(target_summary(scores, good), "target", "full").withColumns({"n_symbols": F.coalesce("n_symbols", F.lit(0)), "frac_good": F.coalesce("frac_good", F.lit(0.0)), "winners": F.coalesce("winners", F.array().cast("array<string>"))})
    some = F.coalesce(F.col("hi") >= good, F.lit(False))
    rules = [
        (F.col("auc").isNull() & some, "SYMBOL_SPECIFIC", "cross_failed"), (F.col("auc").isNull(), "BLOCKED", "no_viable_route"),
        (F.col("auc") >= suspicious, "BLOCKED", "suspicious"), (F.col("hi") >= suspicious_symbol, "BLOCKED", "suspicious_symbol"),
        ((F.col("auc") >= strong) & (F.col("frac_good") >= least_share), "CROSS_SECTIONAL", "strong"), ((F.col("auc") < strong) & some, "SYMBOL_SPECIFIC", "weak_but_good_symbols"),
        ((F.col("auc") >= strong) & (F.col("n_symbols") > 0) & ((F.col("iqr") > wide) | (F.col("frac_good") < least_share)), "BOTH", "concentrated"),
    ]
    first = lambda at, rest: _first([(c, (route, why)[at]) for c, route, why in rules], rest)
    return rows.withColumn("route", first(0, "CROSS_SECTIONAL")).withColumn("reason", first(1, "default"))


def _first(rules: Sequence[tuple[Column, str]], rest: str) -> Column:
    out = F.when(*rules[0])
    for condition, name in rules[1:]:
        out = out.when(condition, name)
    return out.otherwise(rest)


def candidates(cross: DataFrame, scores: DataFrame) -> DataFrame:
    """One frame of facts for routing: a row a target of cross (level cross_sectional, no symbol), one a target and symbol of scores (level symbol), and
    mode: `both` where a target has rows of either kind, else the only kind it has. Columns of one frame alone are null in the other's rows."""
    rows = cross.withColumn("symbol", F.lit(None).cast("string")).withColumn("level", F.lit("cross_sectional")).unionByName(scores.withColumn("level", F.lit("symbol")), allowMissingColumns=True)
    kinds = rows.groupBy("target").agg(F.count_if(F.col("level") == "symbol").alias("s"), F.count_if(F.col("level") != "symbol").alias("c"))
    mode = F.when((F.col("s") > 0) & (F.col("c") > 0), "both").when(F.col("s") > 0, "symbol_only").otherwise("cross_sectional_only")
    return rows.join(kinds.select(F.col("target").alias("_t"), mode.alias("mode")), F.col("target").eqNullSafe(F.col("_t"))).drop("_t")


# Horizons below these minutes are of this tier.
TIERS = (("short", 60), ("medium", 240), ("long", 1440))


def horizon_minutes(target: Column) -> Column:
    """The minutes that a target's name tells: 60m, 2h or 5d before an underscore or its end; null where it tells none."""
    found = lambda unit: F.nullif(F.regexp_extract(target, rf"(\d+){unit}(?:_|$)", 1), F.lit("")).try_cast("long")
    return F.coalesce(found("m"), found("h") * 60, found("d") * 1440)


def horizon_tier(minutes: Column) -> Column:
    """short under an hour, medium under four, long under a day, very_long beyond; default where the horizon is not known."""
    out = F.when(minutes.isNull(), "default")
    for name, end in TIERS:
        out = out.when(minutes < end, name)
    return out.otherwise("very_long")


@dataclass(frozen=True)
class SideRules:
    """What one side, the cross-section or a symbol's own model, needs. A score is a number for all tasks, or a map of task (`classification`,
    `regression` or `regression/<tier>`) to a number: the tier's entry counts, then `regression`."""

    least_rows: int
    least_score: float | Mapping[str, float]
    strong_score: float | Mapping[str, float]
    stable: Sequence[str]


@dataclass(frozen=True)
class RouteRules:
    cross: SideRules = SideRules(50_000, 0.55, 0.60, ("STABLE", "DRIFTING"))
    symbol: SideRules = SideRules(5_000, 0.58, 0.62, ("STABLE",))
    block_leaks: bool = True
    both: str = "BOTH"
    experimental_score: float | Mapping[str, float] | None = 0.52  # None: no experiments
    experimental_stable: Sequence[str] = field(default=("DRIFTING", "UNKNOWN"))


def _threshold(given: float | Mapping[str, float], task: Column, tier: Column) -> Column:
    if not isinstance(given, Mapping):
        return F.lit(float(given))
    held = F.create_map(*(F.lit(x) for k, v in given.items() for x in (k, float(v))))
    kind = F.when(F.upper(task).contains("CLASSIFICATION"), "classification").otherwise("regression")
    return F.coalesce(F.try_element_at(held, F.concat(kind, F.lit("/"), tier)), F.try_element_at(held, kind), F.when(kind == "classification", 0.5).otherwise(-0.5))


def signal(rules: SideRules, every: RouteRules, prefix: str, tier: Column) -> Column:
    """STRONG, WEAK, EXPERIMENTAL or DISALLOWED from the columns <prefix>score, rows, stability, leak and task; no score or no rows: DISALLOWED."""
    score, rows, stability, leak, task = (F.col(prefix + c) for c in ("score", "rows", "stability", "leak", "task"))
    stable = stability.isin(*rules.stable)
    out = F.when(F.coalesce(rows < rules.least_rows, F.lit(True)) | score.isNull() | F.isnan(score), "DISALLOWED")
    if every.block_leaks:
        out = out.when(leak == "BLOCKED", "DISALLOWED")
    out = out.when((score >= _threshold(rules.strong_score, task, tier)) & stable, "STRONG").when((score >= _threshold(rules.least_score, task, tier)) & stable, "WEAK")
    if every.experimental_score is not None:
        out = out.when((score >= _threshold(every.experimental_score, task, tier)) & stability.isin(*every.experimental_stable), "EXPERIMENTAL")
    return out.otherwise("DISALLOWED")


FACTS = ("score", "rows", "stability", "leak", "task")


def symbol_routes(cross: DataFrame, local: DataFrame, rules: RouteRules = RouteRules()) -> DataFrame:
    """cross(target, FACTS) and local(target, symbol, FACTS) to a row a target and symbol: tier, cross_state, local_state and route.

    Neither side allowed: BLOCKED. One: CROSS_SECTIONAL or SYMBOL_SPECIFIC. Both strong or weak: as rules.both says (BOTH, CROSS_SECTIONAL or
    SYMBOL_SPECIFIC). One of them experimental: EXPERIMENTAL_ONLY. A target that cross lacks is disallowed there, and one that no symbol has gets a row
    without symbol. Both frames hold one row a key; other columns go."""
    c = cross.select("target", *(F.col(k).alias(f"cross_{k}") for k in FACTS))
    s = local.select("target", "symbol", *(F.col(k).alias(f"local_{k}") for k in FACTS))
    rows = s.join(c, "target", "full").withColumn("tier", horizon_tier(horizon_minutes(F.col("target"))))
    rows = rows.withColumn("cross_state", signal(rules.cross, rules, "cross_", F.col("tier"))).withColumn("local_state", signal(rules.symbol, rules, "local_", F.col("tier")))
    no_cross, no_local = F.col("cross_state") == "DISALLOWED", F.col("local_state") == "DISALLOWED"
    tried = (F.col("cross_state") == "EXPERIMENTAL") | (F.col("local_state") == "EXPERIMENTAL")
    return rows.withColumn("route", _first([(no_cross & no_local, "BLOCKED"), (no_cross, "SYMBOL_SPECIFIC"), (no_local, "CROSS_SECTIONAL"), (tried, "EXPERIMENTAL_ONLY")], rules.both))
