"""Forward labels of bars. A label at bar t uses bars t+1 to t+H only, stays on its own row, and is null where fewer than H bars follow.

H is horizon_minutes / interval_minutes, whole bars, rounded down; both are mandatory. Volatility is that of bar t: the standard
deviation of up to 20 one-bar returns, from 5 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.functions.portable import KEY, Step, ahead, apply_steps, change, lag, over, ratio

VOL_WINDOW, MIN_PERIODS = 20, 5


def horizon_bars(horizon_minutes: float, interval_minutes: float) -> int:
    if not interval_minutes or interval_minutes <= 0:
        raise ValueError("interval_minutes must be a positive number of minutes")
    bars = int(horizon_minutes / interval_minutes)
    if bars < 1:
        raise ValueError("the horizon is shorter than a bar")
    return bars


def volatility() -> tuple[Step, ...]:
    return {"ret": change("close")}, {"vol": f"CASE WHEN count(ret) {over(VOL_WINDOW - 1)} >= {MIN_PERIODS} THEN stddev_samp(ret) {over(VOL_WINDOW - 1)} END"}


def first_hit(condition, h: int) -> str:
    """The first k in 1..h whose condition on the close k bars ahead holds."""
    return "CASE " + " ".join(f"WHEN {condition(lag('close', -k))} THEN {k}" for k in range(1, h + 1)) + " END"


def touches(h: int, up: float, down: float) -> tuple[Step, ...]:
    """Bars to the first close at or beyond either barrier, and whether h bars follow."""
    barriers = {"barrier_up": f"close * (1 + {up} * vol)", "barrier_down": f"close * (1 - {down} * vol)"}
    ready = f"vol > 0 AND count(close) {over(-1, h)} = {h}"
    return *volatility(), barriers, {"ready": ready, "up_at": first_hit(lambda p: f"{p} >= barrier_up", h), "down_at": first_hit(lambda p: f"{p} <= barrier_down", h)}


FIRST = "CASE WHEN NOT coalesce(ready, false) THEN NULL WHEN up_at IS NULL AND down_at IS NULL THEN 0 WHEN down_at IS NULL OR up_at < down_at THEN 1 ELSE -1 END"
EARLIEST = "CASE WHEN ready THEN least(coalesce(up_at, down_at), coalesce(down_at, up_at)) END"


def barrier(h: int, k: float = 0.5) -> tuple[Step, ...]:
    flag = lambda x: f"CASE WHEN ready THEN CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END END"
    return *touches(h, k, k), {"y_first_touch": FIRST, "y_will_peak": flag("up_at"), "y_will_valley": flag("down_at"), "p_up": "CASE WHEN ready THEN CASE WHEN up_at IS NOT NULL THEN 0.5 ELSE 0.0 END END", "p_down": "CASE WHEN ready THEN CASE WHEN down_at IS NOT NULL THEN 0.5 ELSE 0.0 END END", "barrier_up": "barrier_up", "barrier_down": "barrier_down", "vol_at_t": "vol"}


def time_to_hit(h: int, k: float = 0.5) -> tuple[Step, ...]:
    return *touches(h, k, k), {"tth_abs": EARLIEST, "hit_direction": FIRST}, {"tth": "CASE WHEN hit_direction <> 0 THEN tth_abs * hit_direction END", "tth_abs": "tth_abs", "hit_direction": "hit_direction"}


def asymmetric(h: int, take: float, stop: float) -> tuple[Step, ...]:
    return *touches(h, take, stop), {"hit_asym": FIRST, "tth_asym": EARLIEST}


def excursions(h: int, threshold: float = 0.002) -> tuple[Step, ...]:
    return {"mfe": ratio(ahead("max", "close", h), "close") + " - 1", "mdd": ratio(ahead("min", "close", h), "close") + " - 1"}, {"mfe": "mfe", "mdd": "mdd", "y_will_peak_mfe": f"CASE WHEN mfe >= {threshold} THEN 1 WHEN mfe IS NOT NULL THEN 0 END", "y_will_valley_mdd": f"CASE WHEN mdd <= -{threshold} THEN 1 WHEN mdd IS NOT NULL THEN 0 END"}


def ordinal(h: int, cuts: tuple[float, float, float] = (0.5, 1.0, 2.0)) -> tuple[Step, ...]:
    a, b, c = cuts
    size = f"CASE WHEN abs(ret_zscore) >= {c} THEN 3 WHEN abs(ret_zscore) >= {b} THEN 2 WHEN abs(ret_zscore) >= {a} THEN 1 WHEN ret_zscore IS NOT NULL THEN 0 END"
    return *volatility(), {"ret_zscore": f"({ratio(lag('close', -h), 'close')} - 1) / greatest(vol, 1e-8)"}, {"ret_ord": f"CASE WHEN ret_zscore < 0 THEN -({size}) ELSE {size} END", "ret_zscore": "ret_zscore"}


def path_quality(h: int) -> tuple[Step, ...]:
    steps = {f"r{k}": ratio(lag("close", -k), "close") + " - 1" for k in range(1, h + 1)}
    names = list(steps)
    high, low = f"greatest({', '.join(names)}, 0.0)", f"greatest({', '.join(f'-{n}' for n in names)}, 0.0)"
    gains = " + ".join(f"CASE WHEN {n} > 0 THEN 1.0 ELSE 0.0 END" for n in names)
    flips = " + ".join(f"CASE WHEN signum({a}) <> signum({b}) THEN 1 ELSE 0 END" for a, b in zip(names, names[1:], strict=False))
    whole = f"{names[-1]} IS NOT NULL"
    return steps, {"mfe_share": f"CASE WHEN {whole} THEN {ratio(high, f'{high} + {low}')} END", "time_in_profit": f"CASE WHEN {whole} THEN ({gains}) / {h} END", "flipcount": f"CASE WHEN {whole} THEN {flips} END"}


def zigzag_swing(h: int, side: int = 3) -> tuple[Step, ...]:
    """Is there a bar in the future path strictly beyond its neighbours on both sides, all of them inside the path too?"""
    inner = over(-(1 + side), h - side)
    flags = {"peak": f"CASE WHEN close > max(close) {over(side, -1)} AND close > max(close) {over(-1, side)} THEN 1 ELSE 0 END", "pit": f"CASE WHEN close < min(close) {over(side, -1)} AND close < min(close) {over(-1, side)} THEN 1 ELSE 0 END"}
    return flags, {"y_will_swing_high": f"CASE WHEN count(close) {over(-1, h)} = {h} THEN max(peak) {inner} END", "y_will_swing_low": f"CASE WHEN count(close) {over(-1, h)} = {h} THEN max(pit) {inner} END"}


def forward_returns(horizons: tuple[int, ...], prefix: str = "fwd_ret") -> tuple[Step, ...]:
    return ({f"{prefix}_{h}": ratio(lag("close", -h), "close") + " - 1" for h in horizons},)


def session_return() -> tuple[Step, ...]:
    """The whole day's return from its first open to its last close: looks ahead within the day."""
    day = "PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return ({"ret_oc_same_day": ratio(f"last_value(close) OVER ({day})", f"first_value(open) OVER ({day})") + " - 1"},)


def session_forward(h: int, most: float = 0.2) -> tuple[Step, ...]:
    same = f"CAST({lag('ts', -h)} AS DATE) = CAST(ts AS DATE)"
    return {"close_tph": lag("close", -h), "same": same}, {"close_t": "close", "close_tph": "close_tph", "fwd_ret_session": f"CASE WHEN same THEN greatest(least({ratio('close_tph', 'close')} - 1, {most}), -{most}) END", "horizon_bars": f"CAST({h} AS INT)"}


_MARKET = {"ret": change("close")}, {"mkt": "avg(ret) OVER (PARTITION BY ts)"}


def rolling_beta(n: int = 60) -> tuple[Step, ...]:
    return *_MARKET, {"beta": f"CASE WHEN count(ret) {over(n - 1)} = {n} THEN {ratio(f'covar_samp(ret, mkt) {over(n - 1)}', f'var_samp(mkt) {over(n - 1)}')} END"}


def excess_return(h: int, n: int = 60, bfill: bool = False) -> tuple[Step, ...]:
    """Sum of the next h residuals to the market. bfill takes the first known beta for earlier bars, which leaks."""
    fill = ({"beta": f"coalesce(beta, first_value(beta) IGNORE NULLS OVER ({KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"},) if bfill else ()
    return *rolling_beta(n), *fill, {"resid": "ret - beta * mkt"}, {"excess_ret": ahead("sum", "resid", h)}


def grid(horizons: tuple[int, ...], sizes: tuple[float, ...], pairs: tuple[tuple[float, float], ...], thresholds: tuple[float, ...] = (0.001, 0.002, 0.005), reversals: tuple[float, ...] = (0.05, 0.1, 0.2), side: int = 3) -> tuple[Step, ...]:
    """Labels of every horizon with every barrier size, take:stop pair, excursion threshold and reversal, in one sort. A swing's label asks of the
    path that the bar turns by the reversal within it, beyond its neighbours on `side` sides; horizons too short for both sides have none."""
    hits, labels = zigzag_swing(2 * side + 1, side)[0] | {}, {}
    wide = [h for h in horizons if h > 2 * side]
    for h in horizons:
        hits[f"ready_{h}"] = f"vol > 0 AND count(close) {over(-1, h)} = {h}"
        hits[f"top_{h}"], hits[f"bottom_{h}"] = ahead("max", "close", h), ahead("min", "close", h)
        for name, up, down in [(f"y_first_touch_{h}_{i}", k, k) for i, k in enumerate(sizes)] + [(f"hit_asym_{h}_{i}", a, b) for i, (a, b) in enumerate(pairs)]:
            hits[f"u_{name}"] = first_hit(lambda p, up=up: f"{p} >= close * (1 + {up} * vol)", h)
            hits[f"d_{name}"] = first_hit(lambda p, down=down: f"{p} <= close * (1 - {down} * vol)", h)
            labels[name] = FIRST.replace("ready", f"ready_{h}").replace("up_at", f"u_{name}").replace("down_at", f"d_{name}")
        for i, t in enumerate(thresholds):
            labels[f"y_will_peak_mfe_{h}_{i}"] = f"CASE WHEN top_{h} >= close * (1 + {t}) THEN 1 WHEN top_{h} IS NOT NULL THEN 0 END"
            labels[f"y_will_valley_mdd_{h}_{i}"] = f"CASE WHEN bottom_{h} <= close * (1 - {t}) THEN 1 WHEN bottom_{h} IS NOT NULL THEN 0 END"
        for i, r in enumerate(reversals if h in wide else ()):
            inner = over(-(1 + side), h - side)
            labels[f"y_will_swing_high_{h}_{i}"] = f"CASE WHEN top_{h} IS NOT NULL THEN CASE WHEN max(peak) {inner} = 1 AND bottom_{h} <= top_{h} * (1 - {r}) THEN 1 ELSE 0 END END"
            labels[f"y_will_swing_low_{h}_{i}"] = f"CASE WHEN top_{h} IS NOT NULL THEN CASE WHEN max(pit) {inner} = 1 AND top_{h} >= bottom_{h} * (1 + {r}) THEN 1 ELSE 0 END END"
    return *volatility(), hits, labels


def add_labels(bars: DataFrame, *steps: Step) -> DataFrame:
    """bars and the last step's columns of a chain of this module."""
    return apply_steps(bars, *steps).select(*bars.columns, *(c for c in steps[-1] if c not in bars.columns))

