"""A query for each group of features over the weekly panel (hourly where clock time matters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.ewm import ewm_sql
from barloom.functions.portable import steps_sql
from barloom.operators import features
from barloom.plans.registry import NUDGE, panel_op, register, rounded, translated
from barloom.sources import panels

HOURLY = {"FT-53", "FT-54", "FT-57", "FT-58", "FT-60"}


def _name(group: str) -> str:
    return group.lower().replace("-", "_")


for _group, _chain in features.CHAINS.items():
    if _group == "FT-32":  # a running product of some 1e32 compares by its logarithm
        _chain = (*_chain, {"negative_volume_index": "ln(negative_volume_index)"})  # noqa: PLW2901
    if _group == "FT-33":  # a long running sum: its last places depend on the order of adding
        _chain = (*_chain, {"price_volume_trend": "round(price_volume_trend, 2)"})  # noqa: PLW2901
    panel_op(_name(_group), features.shown(_group), *_chain, panel="bars_h" if _group in HOURLY else "bars_w", large=_group == "FT-43")


def _ewm_op(group: str) -> None:
    before, means, after = features.EWM[group]
    inner, columns = steps_sql(f"({panels.BARS_W})", panels.BAR_COLUMNS, *before), [*panels.BAR_COLUMNS, *(c for s in before for c in s if c not in panels.BAR_COLUMNS)]
    for level in means:
        inner = f"(SELECT _r.*, {', '.join(level)} FROM {ewm_sql(inner, level)})"
        inner = f"(SELECT * EXCLUDE (_i) FROM {inner})"
        columns += list(level)
    inner = steps_sql(inner, columns, *after)
    names = features.shown(group)
    text = f"SELECT symbol, CAST(ts AS VARCHAR) AS ts, {', '.join(f'round(CAST({c} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {c}' for c in names)} FROM {inner}"
    register(_name(group), lambda spark, sf: rounded(features.add_group(panels.weekly_bars(spark, sf), group).select("symbol", "ts", *(F.col(c).cast("double").alias(c) for c in names))), translated(text))


for _group in features.EWM:
    _ewm_op(_group)

# A builder's columns by category: what build_features makes of the names, against the chains one after another.
_VOLUME = [f"FT-{n}" for n in features.CATEGORIES["volume"] if f"FT-{n}" in features.CHAINS]
_SHOWN = [c for g in ("FT-37", "FT-38", "FT-40", "FT-41", "FT-42") for c in features.shown(g)]


def _built_sql() -> str:
    inner, held = f"({panels.BARS_W})", list(panels.BAR_COLUMNS)
    for group in _VOLUME:
        inner = steps_sql(inner, held, *features.CHAINS[group])
        held += [c for c in features.shown(group) if c not in held]
        inner = f"(SELECT {', '.join(held)} FROM {inner})"
    return translated(f"SELECT symbol, CAST(ts AS VARCHAR) AS ts, {', '.join(f'round(CAST({c} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {c}' for c in _SHOWN)} FROM {inner}")


register("ft_62", lambda spark, sf: rounded(features.build_features(panels.weekly_bars(spark, sf), ["volume"]).select("symbol", "ts", *(F.col(c).cast("double").alias(c) for c in _SHOWN))), _built_sql())
