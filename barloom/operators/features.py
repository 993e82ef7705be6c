"""Feature columns of bars: prices, technical indicators, volume, volatility, microstructure, calendar, interactions.

Every feature is a chain of select lists (see functions.portable) over symbol, ts, open, high, low, close, volume, vwap; bar counts, never
clock time, are in the names. Ratios are null where their denominator is zero, logarithms where there is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.functions.ewm import with_means
from barloom.functions.portable import KEY, Step, apply_steps, change, lag, log, over, ratio, roll

RET = {"ret": change("close")}
TP = {"tp": "(high + low + close) / 3"}


def _each(template, sizes) -> dict[str, str]:
    return {k: v for n in sizes for k, v in template(n).items()}


def _rsi(n: int) -> dict[str, str]:
    gain, loss = roll("avg", "gain", n), roll("avg", "loss", n)
    return {f"rsi_{n}": f"CASE WHEN {loss} = 0 THEN 100.0 ELSE 100 - 100 / (1 + ({gain}) / nullif({loss}, 0)) END"}


def _mfi(n: int) -> dict[str, str]:
    up, down = roll("sum", "inflow", n), roll("sum", "outflow", n)
    return {f"mfi_{n}": f"CASE WHEN {down} = 0 THEN 100.0 ELSE 100 - 100 / (1 + ({up}) / nullif({down}, 0)) END"}


_TRUE_RANGE = {"pc": lag("close")}, {"tr": "CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END"}
_GAINS = {"d": f"close - {lag('close')}"}, {"gain": "CASE WHEN d IS NOT NULL THEN greatest(d, 0.0) END", "loss": "CASE WHEN d IS NOT NULL THEN greatest(-d, 0.0) END"}
_FLOW = TP, {"ptp": lag("tp")}, {"inflow": "CASE WHEN tp > ptp THEN tp * volume WHEN ptp IS NOT NULL THEN 0.0 END", "outflow": "CASE WHEN tp < ptp THEN tp * volume WHEN ptp IS NOT NULL THEN 0.0 END"}
_ATR = (*_TRUE_RANGE, {"atr_14": roll("avg", "tr", 14)})
_MFV = {"mfv": ratio("((close - low) - (high - close))", "high - low") + " * volume"}

#: What the products of FT-60 are made of.
_INPUTS = (
    {
        "pc": lag("close"), "d": f"close - {lag('close')}", "m20": roll("avg", "close", 20), "s20": roll("stddev_samp", "close", 20), "gap_co": ratio("open", lag("close")) + " - 1",
        "volatility_20d": roll("stddev_samp", "ret", 20), "mom_5d": change("close", 5), "mom_20d": change("close", 20), **{f"ret_{n}m": change("close", n) for n in (5, 15, 60)},
        "stoch_k_14": "100 * " + ratio(f"close - {roll('min', 'low', 14)}", f"{roll('max', 'high', 14)} - {roll('min', 'low', 14)}"),
        "gain": f"CASE WHEN {lag('close')} IS NOT NULL THEN greatest(close - {lag('close')}, 0.0) END", "loss": f"CASE WHEN {lag('close')} IS NOT NULL THEN greatest({lag('close')} - close, 0.0) END",
        "tr": f"CASE WHEN {lag('close')} IS NULL THEN high - low ELSE greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) END",
    },
    {"bb_width_20": ratio("4 * s20", "m20"), "atr_14": roll("avg", "tr", 14), **_rsi(14)},
)

#: Each feature group's chain; the last step's columns are the features unless SHOWN says otherwise.
CHAINS: dict[str, tuple[Step, ...]] = {
    "FT-1": ({"range_frac": "high - low"},),
    "FT-2": ({"ret_oc": ratio("close", "open") + " - 1"},),
    "FT-3": ({"gap_co": ratio("open", lag("close")) + " - 1"}, {"gap_co": "gap_co", "overnight_return": "gap_co"}),
    "FT-4": ({"oc": ratio("open", lag("close"))}, {"overnight_vol": f"abs({log('oc')})"}),
    "FT-5": ({"vwap_dev": ratio("close - vwap", "vwap"), "vwap_dev_high": ratio("high - vwap", "vwap"), "vwap_dev_low": ratio("low - vwap", "vwap")},),
    "FT-6": ({"close_loc_1d": ratio("close", "high"), "open_loc_1d": ratio("open", "high"), "low_loc_1d": ratio("low", "high")},),
    "FT-7": ({"dollar_volume": "close * volume"},),
    "FT-8": (_each(lambda n: {f"turnover_{n}": ratio("volume", roll("avg", "volume", n))}, (5, 20)),),
    "FT-9": ({**_each(lambda n: {f"ret_{n}m": change("close", n)}, (1, 5, 15, 30, 60)), **_each(lambda n: {f"returns_{n}d": change("close", n)}, (1, 5, 20)), **_each(lambda n: {f"mom_{n}d": change("close", n)}, (1, 3, 5, 10)), **_each(lambda n: {f"price_momentum_{n}d": change("close", n)}, (5, 20, 60))},),
    "FT-10": (RET, {**_each(lambda n: {f"vol_{n}m": roll("stddev_samp", "ret", n)}, (5, 15, 30, 60)), **_each(lambda n: {f"volatility_{n}d": roll("stddev_samp", "ret", n)}, (20, 60)), **_each(lambda n: {f"realized_vol_{n}": roll("stddev_samp", "ret", n)}, (5, 10, 20))}),
    "FT-11": (_each(lambda n: {f"sma_{n}": roll("avg", "close", n)}, (5, 10, 20, 50, 200)),),
    "FT-13": (_each(lambda n: {f"w{n}": f"2 * {roll('avg', 'close', n // 2)} - {roll('avg', 'close', n)}"}, (5, 10, 20)), _each(lambda n: {f"hull_ma_{n}": roll("avg", f"w{n}", int(n**0.5))}, (5, 10, 20))),
    "FT-15": ({"cv": "close * volume"}, _each(lambda n: {f"vwma_{n}": ratio(roll("sum", "cv", n), roll("sum", "volume", n))}, (5, 10, 20))),
    "FT-16": (*_GAINS, _each(_rsi, (5, 7, 10, 14, 21, 30))),
    "FT-18": ({"m20": roll("avg", "close", 20), "s20": roll("stddev_samp", "close", 20)}, {"bb_upper_20": "m20 + 2 * s20", "bb_lower_20": "m20 - 2 * s20", "bb_width_20": ratio("4 * s20", "m20"), "bb_percent_b_20": ratio("close - (m20 - 2 * s20)", "4 * s20")}),
    "FT-19": (_each(lambda n: {f"stoch_k_{n}": "100 * " + ratio(f"close - {roll('min', 'low', n)}", f"{roll('max', 'high', n)} - {roll('min', 'low', n)}")}, (5, 14, 21)), {**_each(lambda n: {f"stoch_k_{n}": f"stoch_k_{n}", f"stoch_d_{n}": roll("avg", f"stoch_k_{n}", 3)}, (5, 14, 21))}),
    "FT-20": (_each(lambda n: {f"williams_r_{n}": "-100 * " + ratio(f"{roll('max', 'high', n)} - close", f"{roll('max', 'high', n)} - {roll('min', 'low', n)}")}, (7, 14, 21)),),
    "FT-21": (TP, _each(lambda n: {f"m{n}": roll("avg", "tp", n)}, (10, 14, 20, 30)), _each(lambda n: {f"a{n}": f"abs(tp - m{n})"}, (10, 14, 20, 30)), _each(lambda n: {f"cci_{n}": ratio(f"tp - m{n}", f"0.015 * {roll('avg', f'a{n}', n)}")}, (10, 14, 20, 30))),
    "FT-22": _ATR,
    "FT-23": (*_ATR, {"up": f"high - {lag('high')}", "dn": f"{lag('low')} - low"}, {"pdm": "CASE WHEN up > dn AND up > 0 THEN up ELSE 0.0 END", "mdm": "CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0.0 END"}, {"pdi": ratio("100 * " + roll("avg", "pdm", 14), "atr_14"), "mdi": ratio("100 * " + roll("avg", "mdm", 14), "atr_14")}, {"dx": ratio("100 * abs(pdi - mdi)", "pdi + mdi")}, {"adx_14": roll("avg", "dx", 14)}),
    "FT-24": ({**_each(lambda n: {f"momentum_{n}": change("close", n)}, (5, 10, 20)), **_each(lambda n: {f"roc_{n}": change("close", n)}, (5, 10, 20, 50))},),
    "FT-25": ({"psar": "(high + low) / 2", "psar_af": "0.02 + 0 * close"},),
    "FT-26": (_each(lambda n: {f"mid{n}": f"({roll('max', 'high', n)} + {roll('min', 'low', n)}) / 2"}, (9, 26, 52)), {"ichimoku_tenkan": "mid9", "ichimoku_kijun": "mid26", "ichimoku_senkou_a": "(mid9 + mid26) / 2", "ichimoku_senkou_b": "mid52"}),
    "FT-27": ({"ichimoku_chikou": lag("close", -26)},),
    "FT-28": (*_ATR, {"m20": roll("avg", "close", 20), "hi20": roll("max", "high", 20), "lo20": roll("min", "low", 20)}, {"keltner_upper": "m20 + 2 * atr_14", "keltner_lower": "m20 - 2 * atr_14", "keltner_middle": "m20", "donchian_upper": "hi20", "donchian_lower": "lo20", "donchian_middle": "(hi20 + lo20) / 2", "supertrend": "(high + low) / 2 + 2 * atr_14", "supertrend_direction": "CASE WHEN close > (high + low) / 2 + 2 * atr_14 THEN 1 WHEN atr_14 IS NOT NULL THEN -1 END"}),
    "FT-29": ({"zigzag_high": roll("max", "high", 5), "zigzag_low": roll("min", "low", 5)},),
    "FT-30": ({"fractal_high": f"CASE WHEN high > {lag('high', 1)} AND high > {lag('high', 2)} AND high > {lag('high', -1)} AND high > {lag('high', -2)} THEN 1 ELSE 0 END", "fractal_low": f"CASE WHEN low < {lag('low', 1)} AND low < {lag('low', 2)} AND low < {lag('low', -1)} AND low < {lag('low', -2)} THEN 1 ELSE 0 END"},),
    "FT-31": ({"mid": "(high + low) / 2"}, {"awesome_oscillator": f"{roll('avg', 'mid', 5)} - {roll('avg', 'mid', 34)}", "market_facilitation_index": ratio("high - low", "volume"), "ease_of_movement": f"(mid - {lag('mid')}) * " + ratio("high - low", "volume"), "mass_index": roll("sum", "high - low", 25)}),
    "FT-32": ({"f": f"CASE WHEN volume < {lag('volume')} THEN {ratio('close', lag('close'))} ELSE 1.0 END"}, {"lf": log("f")}, {"negative_volume_index": f"exp(sum(lf) {over()})"}),
    "FT-33": (RET, {"price_volume_trend": f"sum(ret * volume) {over()}"}),
    "FT-34": (_MFV, {"williams_accumulation": "mfv", "ad_line": "mfv"}),
    "FT-36": ({"force_index": f"(close - {lag('close')}) * volume"},),
    "FT-37": ({**_each(lambda n: {f"volume_momentum_{n}d": change("volume", n)}, (5, 20)), **_each(lambda n: {f"volume_roc_{n}": change("volume", n)}, (5, 10, 20))},),
    "FT-38": ({**_each(lambda n: {f"volume_ratio_{n}d": ratio("volume", roll("avg", "volume", n))}, (5, 20)), "volume_volatility_20d": roll("stddev_samp", "volume", 20), **_each(lambda n: {f"volume_sma_{n}": roll("avg", "volume", n)}, (5, 20, 50))},),
    "FT-40": ({"pc": lag("close")}, {"obv": f"sum(CASE WHEN close > pc THEN volume WHEN close < pc THEN -volume ELSE 0 END) {over()}"}),
    "FT-41": (_MFV, {"cmf": ratio(roll("sum", "mfv", 20), roll("sum", "volume", 20))}),
    "FT-42": (*_FLOW, _each(_mfi, (14, 21))),
    "FT-43": ({**TP, "tv": "(high + low + close) / 3 * volume"}, {**_each(lambda n: {f"vwap_{n}": ratio(roll("sum", "tv", n), roll("sum", "volume", n))}, (5, 10, 20)), "volume_weighted_price": "tv"}),
    "FT-44": ({"hl": ratio("high", "low"), "co": ratio("close", "open")}, {"x": f"0.5 * power({log('hl')}, 2) - (2 * ln(2.0) - 1) * power({log('co')}, 2)"}, _each(lambda n: {f"gk_vol_{n}": roll("avg", "x", n)}, (5, 10, 20))),
    "FT-45": ({"hl": ratio("high", "low")}, {"x": f"0.25 * power({log('hl')}, 2)"}, _each(lambda n: {f"parkinson_vol_{n}": roll("avg", "x", n)}, (5, 10, 20))),
    "FT-46": ({"hc": ratio("high", "close"), "ho": ratio("high", "open"), "lc": ratio("low", "close"), "lo": ratio("low", "open")}, {"x": f"{log('hc')} * {log('ho')} + {log('lc')} * {log('lo')}"}, _each(lambda n: {f"rs_vol_{n}": roll("avg", "x", n)}, (5, 10, 20))),
    "FT-47": ({"op": ratio("open", lag("close")), "co": ratio("close", "open")}, {"x": f"power({log('op')}, 2) + power({log('co')}, 2)"}, _each(lambda n: {f"yz_vol_{n}": roll("avg", "x", n)}, (5, 10, 20))),
    "FT-48": ({"bid_ask_spread_est": ratio("high - low", "close"), "effective_spread": ratio("close - open", "close"), "realized_spread": ratio("close - open", "close"), "mid_price_vol": "(high + low) / 2", "order_flow_imbalance": ratio("close - open", "high - low")},),
    "FT-49": (RET, {"price_impact": ratio("abs(ret)", log("volume")), "market_impact": ratio("abs(ret)", log("volume"))}),
    "FT-50": (RET, {"v20": roll("stddev_samp", "ret", 20), **_each(lambda n: {f"v{n}": roll("stddev_samp", "ret", n)}, (5, 15, 60))}, {"trade_size_vol": roll("stddev_samp", "volume", 20), **_each(lambda n: {f"vol_clustering_{n}m": ratio(f"v{n}", "v20")}, (5, 15, 60)), "vol_persistence": ratio("v20", "v60"), **_each(lambda n: {f"vol_over_vol_{n}": roll("stddev_samp", f"v{n}", 20)}, (5, 15))}),
    "FT-51": (_each(lambda n: {f"range_compression_{n}m": ratio("high - low", roll("avg", "close", n))}, (5, 15, 60)),),
    "FT-52": (RET, {"liquidity_ratio": ratio("volume", "high - low"), "turnover": ratio("volume", roll("avg", "volume", 20)), "vol_dollar": "volume * close", "volume_price_trend": "volume * ret", **{f"{c}_vol_frac": ratio(c, "volume") for c in ("open", "close", "high", "low")}}),
    "FT-53": ({**{f"hour_{h}": f"CASE WHEN hour(ts) = {h} THEN 1 ELSE 0 END" for h in range(9, 16)}, **{f"wd_{d}": f"CASE WHEN (weekday(ts)) = {d} THEN 1 ELSE 0 END" for d in range(5)}, **{f"month_{m}": f"CASE WHEN month(ts) = {m} THEN 1 ELSE 0 END" for m in range(1, 13)}, **{f"quarter_{q}": f"CASE WHEN quarter(ts) = {q} THEN 1 ELSE 0 END" for q in range(1, 5)}},),
    "FT-54": ({"trading_day_of_month": "floor((day(ts) - 1) / 7) + 1", "trading_day_of_quarter": "floor((day(ts) - 1) / 7) + 1", "is_holiday": "CASE WHEN month(ts) = 12 AND day(ts) IN (24, 25, 31) THEN 1 ELSE 0 END", "is_pre_holiday": "CASE WHEN month(ts) = 12 AND day(ts) IN (23, 30) THEN 1 ELSE 0 END", "is_post_holiday": "CASE WHEN month(ts) = 12 AND day(ts) = 26 THEN 1 ELSE 0 END"},),
    "FT-55": ({"volume_quantile_20d": f"CASE WHEN count(volume) {over(19)} = 20 THEN percentile(volume, 0.5) {over(19)} END", "volume_std_20d": roll("stddev_samp", "volume", 20), "m20": roll("avg", "volume", 20)}, {"volume_quantile_20d": "volume_quantile_20d", "volume_std_20d": "volume_std_20d", "volume_skew_20d": ratio("volume - m20", "volume_std_20d"), "volume_kurt_20d": "power(" + ratio("volume - m20", "volume_std_20d") + ", 2)"}),
    "FT-56": ({f"vwap_dev_{k}": ratio("close - vwap", "vwap") for k in ("5m", "15m", "30m", "session")},),
    "FT-57": ({"hour_of_day": "hour(ts)", "day_of_week": "(weekday(ts))", "day_of_month": "day(ts)", "month_of_year": "month(ts)", "quarter": "quarter(ts)", "year": "year(ts)", "is_month_end": "CASE WHEN day(ts) >= 28 THEN 1 ELSE 0 END", "is_quarter_end": "CASE WHEN month(ts) IN (3, 6, 9, 12) AND day(ts) >= 28 THEN 1 ELSE 0 END"},),
    "FT-58": ({"intraday_seasonality": "CASE WHEN hour(ts) IN (9, 10, 15) THEN 1.0 ELSE 0.5 END", "weekly_seasonality": "CASE WHEN (weekday(ts)) IN (0, 4) THEN 1.0 ELSE 0.5 END", "monthly_seasonality": "CASE WHEN month(ts) IN (1, 12) THEN 1.0 ELSE 0.5 END", "quarterly_seasonality": "CASE WHEN quarter(ts) IN (1, 4) THEN 1.0 ELSE 0.5 END", "holiday_effect": "CASE WHEN month(ts) = 12 THEN 1.0 ELSE 0.5 END"},),
    "FT-59": (RET, {"mkt": "avg(ret) OVER (PARTITION BY ts)", "dv": "close * volume"}, {"relative_performance": "ret - mkt", "beta_60": ratio(roll("covar_samp", "ret, mkt", 60).replace("count(ret, mkt)", "count(ret)"), roll("var_samp", "mkt", 60)), "market_correlation_60": roll("corr", "ret, mkt", 60).replace("count(ret, mkt)", "count(ret)"), "market_cap_decile": "ntile(10) OVER (PARTITION BY ts ORDER BY dv, symbol)"}),
    "FT-60": (
        RET,
        _INPUTS[0],
        _INPUTS[1],
        {
            **{f"ret2_{n}m": f"ret_{n}m * ret_{n}m" for n in (5, 15, 60)},
            **{f"vol_x_ret_{n}m": f"volume * ret_{n}m" for n in (5, 15, 60)},
            "ret_x_mom_5d": "ret_5m * mom_5d",
            "ret_x_mom_20d": "ret_5m * mom_20d",
            "vol_x_mom_5d": "volume * mom_5d",
            "vol_x_mom_20d": "volume * mom_20d",
            "rsi_x_vol": "rsi_14 * volume",
            "bb_x_vol": "bb_width_20 * volume",
            "bb_x_ret": "bb_width_20 * ret_5m",
            "stoch_x_vol": "stoch_k_14 * volume",
            "stoch_x_ret": "stoch_k_14 * ret_5m",
            "atr_x_vol": "atr_14 * volume",
            "momentum_x_vol": "mom_5d * volume",
            "roc_x_vol": "mom_5d * volume",
            "momentum_x_volatility": "mom_5d * volatility_20d",
            "roc_x_volatility": "mom_5d * volatility_20d",
            "hour_x_volume": "hour(ts) * volume",
            "day_x_volume": "(weekday(ts)) * volume",
            "price_x_volume": "close * volume",
            "gap_x_volume": "gap_co * volume",
        },
    ),
    "FT-61": (
        RET,
        _each(lambda n: {f"s{n}": roll("avg", "close", n)}, (5, 10, 20, 50)) | _each(lambda n: {f"v{n}": roll("stddev_samp", "ret", n)}, (5, 20, 60)),
        {
            **{f"sma_ratio_{a}_{b}": ratio(f"s{a}", f"s{b}") for a, b in ((5, 20), (10, 20), (10, 50), (20, 50))},
            "price_ma_ratio": ratio("close", "s20"),
            **{f"vol_ratio_{a}_{b}": ratio(f"v{a}", f"v{b}") for a, b in ((5, 20), (20, 60))},
            "ret_vol_ratio_20": ratio("ret", "v20"),
        },
    ),
    "RG-1": ({"rn": f"row_number() OVER ({KEY})"}, {"trend_strength": f"CASE WHEN count(close) {over(49)} >= 2 THEN corr(close, rn) {over(49)} END"}),
}
_VOLZ = RET, {"v20": roll("stddev_samp", "ret", 20)}, {"vol_z": f"(v20 - avg(v20) {over(199)}) / (stddev_samp(v20) {over(199)} + 1e-8)"}
_REGIME = (*_VOLZ, *CHAINS["RG-1"], {"regime": "CASE WHEN vol_z > 1.5 THEN 2 WHEN abs(trend_strength) > 0.7 THEN 1 ELSE 0 END"})
_CHANGED = (*_REGIME, {"before": lag("regime")}, {"regime_changed": "CASE WHEN before IS NULL OR before <> regime THEN 1 ELSE 0 END"})
CHAINS |= {
    "RG-2": _VOLZ,
    "RG-3": (*_REGIME, {"regime": "regime", **{f"regime_{k}": f"CASE WHEN regime = {k} THEN 1 ELSE 0 END" for k in range(3)}}),
    "RG-4": (*_REGIME, {f"ret_regime_{k}": f"ret * CASE WHEN regime = {k} THEN 1 ELSE 0 END" for k in range(3)}),
    "RG-5": (*_CHANGED, {"regime_changed": "regime_changed", "entered_trend": "CASE WHEN regime = 1 AND before <> 1 THEN 1 ELSE 0 END", "exited_trend": "CASE WHEN before = 1 AND regime <> 1 THEN 1 ELSE 0 END", "entered_vol": "CASE WHEN regime = 2 AND before <> 2 THEN 1 ELSE 0 END"}),
    "RG-6": (*_CHANGED, {"island": f"sum(regime_changed) {over()}"}, {"regime_duration": "row_number() OVER (PARTITION BY symbol, island ORDER BY ts)"}),
}

#: Means that need the exponentially weighted operator: group to (steps before, name -> (column, span), steps after).
EWM: dict[str, tuple[tuple[Step, ...], tuple[dict[str, tuple[str, int]], ...], tuple[Step, ...]]] = {
    "FT-12": ((), ({f"ema_{n}": ("close", n) for n in (5, 10, 20, 50)} | {f"kama_{n}": ("close", n) for n in (5, 10, 20)},), ()),
    "FT-14": (
        (),
        ({f"e{n}": ("close", n) for n in (5, 10, 20)}, {f"f{n}": (f"e{n}", n) for n in (5, 10, 20)}, {f"g{n}": (f"f{n}", n) for n in (5, 10, 20)}),
        ({f"dema_{n}": f"2 * e{n} - f{n}" for n in (5, 10, 20)} | {f"tema_{n}": f"3 * e{n} - 3 * f{n} + g{n}" for n in (5, 10, 20)},),
    ),
    # The mean of a difference is the difference of the means, so the signal line is made of the means' means.
    "FT-17": (
        (),
        ({"e12": ("close", 12), "e26": ("close", 26)}, {"s12": ("e12", 9), "s26": ("e26", 9)}),
        ({"macd": "e12 - e26", "macd_signal": "s12 - s26", "macd_hist": "e12 - e26 - s12 + s26"},),
    ),
    "FT-35": (({**_MFV, "pc": lag("close")}, {"cmf": ratio(roll("sum", "mfv", 20), roll("sum", "volume", 20)), "obv": f"CAST(sum(CASE WHEN close > pc THEN volume WHEN close < pc THEN -volume ELSE 0 END) {over()} AS DOUBLE)"}), ({"e3": ("mfv", 3), "ad_line_ema": ("mfv", 10), "cmf_ema": ("cmf", 10), "obv_ema": ("obv", 10)},), ({"chaikin_oscillator": "e3 - ad_line_ema", "ad_line_ema": "ad_line_ema", "cmf_ema": "cmf_ema", "obv_ema": "obv_ema"},)),
    "FT-61-EMA": (
        (),
        ({f"e{n}": ("close", n) for n in (5, 10, 20, 50)},),
        ({**{f"ema_ratio_{a}_{b}": ratio(f"e{a}", f"e{b}") for a, b in ((5, 20), (10, 20), (10, 50), (20, 50))}, "price_ema_ratio": ratio("close", "e20")},),
    ),
    "FT-39": (({"v": "CAST(volume AS DOUBLE)"},), ({f"volume_ema_{n}": ("v", n) for n in (5, 20)},), ()),
}
CATEGORIES = {"price": range(1, 11), "technical": range(11, 37), "volume": range(37, 44), "volatility": range(44, 48), "microstructure": range(48, 53), "time": range(53, 59), "cross": range(59, 60), "interaction": range(60, 62)}


def shown(group: str) -> tuple[str, ...]:
    """The feature columns of a group."""
    if group in EWM:
        _, means, after = EWM[group]
        return tuple(after[-1]) if after else tuple(means[-1])
    skip = {"mid", "m20"} if group == "FT-55" else set()
    return tuple(c for c in CHAINS[group][-1] if c not in skip)


def add_group(bars: DataFrame, group: str) -> DataFrame:
    """bars and the group's columns."""
    if group in EWM:
        before, means, after = EWM[group]
        df = apply_steps(bars, *before)
        for level in means:
            df = with_means(df, level)
        df = apply_steps(df, *after)
    else:
        df = apply_steps(bars, *CHAINS[group])
    return df.select(*bars.columns, *(c for c in shown(group) if c not in bars.columns))


def build_features(bars: DataFrame, categories: list[str]) -> DataFrame:
    """bars with all features of the categories, in the order given (FT-62). Windows of one symbol share a shuffle and a sort."""
    groups = [g for c in categories for n in CATEGORIES[c] for g in (f"FT-{n}", f"FT-{n}-EMA") if g in CHAINS or g in EWM]
    df = bars
    for group in groups:
        df = df.transform(add_group, group)
    return df


