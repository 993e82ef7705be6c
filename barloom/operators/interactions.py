"""Products of features, for those whose factors a panel has (FT-60)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

#: Product's name to its factors; a factor may go by either of two names, the first that the panel has counts.
PRODUCTS: Mapping[str, tuple[str, str]] = {
    **{f"ret2_{n}m": (f"ret_{n}m", f"ret_{n}m") for n in (5, 15, 60)}, **{f"vol_x_ret_{n}m": ("volume", f"ret_{n}m") for n in (5, 15, 60)},
    "ret_x_mom_5d": ("ret_5m", "mom_5d"), "ret_x_mom_20d": ("ret_5m", "price_momentum_20d|mom_20d"), "vol_x_mom_5d": ("volume", "mom_5d"), "vol_x_mom_20d": ("volume", "price_momentum_20d|mom_20d"),
    **{f"{short}_x_{v}": (name, "volume") for short, name in (("rsi", "rsi_14"), ("bb", "bb_width_20"), ("macd", "macd")) for v in ("vol", "volume")},
    **{f"{short}_x_ret": (name, "ret_5m") for short, name in (("bb", "bb_width_20"), ("macd", "macd"), ("stoch", "stoch_k_14"))},
    **{f"{short}_x_vol": (name, "volume") for short, name in (("stoch", "stoch_k_14"), ("atr", "atr_14"), ("adx", "adx_14"), ("cci", "cci_20"), ("momentum", "momentum_5|mom_5d"), ("roc", "roc_5|mom_5d"))},
    "momentum_x_volatility": ("momentum_5|mom_5d", "volatility_20d"), "roc_x_volatility": ("roc_5|mom_5d", "volatility_20d"), "hour_x_volume": ("hour_of_day", "volume"), "day_x_volume": ("day_of_week", "volume"),
    "price_x_volume": ("close", "volume"), "gap_x_volume": ("gap_co", "volume"),
}


def built(columns: list[str], products: Mapping[str, tuple[str, str]] = PRODUCTS) -> dict[str, str]:
    """The expressions of the products whose factors are all among these columns."""
    have = set(columns)
    named = {k: [next((c for c in f.split("|") if c in have), None) for f in v] for k, v in products.items()}
    return {k: f"CAST({a} AS DOUBLE) * {b}" for k, (a, b) in named.items() if a and b}


def with_interactions(df: DataFrame, products: Mapping[str, tuple[str, str]] = PRODUCTS) -> DataFrame:
    """df and its products, in place of columns of the same name; a product with a null factor is null. No shuffle and no pass of its own."""
    made = built(df.columns, products)
    return df.selectExpr(*(f"`{c}`" for c in df.columns if c not in made), *(f"{e} AS `{c}`" for c, e in made.items()))
