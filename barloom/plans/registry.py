"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.portable import Step, apply_steps, steps_sql
from barloom.sources import panels

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Words of Spark's SQL that the test database spells differently.
_SPELLING = [(r"\b(first|last)_value\((\w+)\) IGNORE NULLS", r"\1_value(\2 IGNORE NULLS)"), (r"from_utc_timestamp\(CAST\((\w+) AS TIMESTAMP\), 'America/New_York'\)", r"timezone('America/New_York', timezone('UTC', \1))"), (r"\bCAST\((\w+) AS INTERVAL\)", r"\1"), (r"\bunix_timestamp\(", "epoch("), (r"\bweekday\(", "-1 + isodow("), (r"\bAS STRING\b", "AS VARCHAR"), (r"\bstruct\(", "row("), (r"\bpercentile\(", "quantile_cont("), (r"percentile_disc\(([\d.]+)\) WITHIN GROUP \(ORDER BY (\w+)\)", r"quantile_disc(\2, \1)"), (r"\brlike\(", "regexp_matches("), (r"\bregexp_extract\(([^()]*)\)", r"regexp_extract(\1)"), (r"\bsignum\(", "sign("), (r"\btimestamp_seconds\(", "to_timestamp(")]
#: Queries whose SQL orders ticks to the last, as the panels do; the other texts leave ticks of one instant, order and line to chance.
SETTLED = frozenset("csx_11 csx_13 csx_15 csx_6 ev_4_classes ft_2 ft_35 ft_36 ft_43 ft_46 ft_48 ft_52 ft_56 ft_60_indicators ag_16 ag_4 csx_1 csx_15_frame ft_28 ft_32 ft_33 ft_34 ft_47 ft_14 ft_17 ft_21 ft_5 ft_62".split())
_PANELS = {"bars_w": (panels.weekly_bars, panels.BARS_W), "bars_h": (panels.hourly_bars, panels.BARS_H)}


def doubled(sql: str) -> str:
    """Spark reads 1.0 as a decimal; here every number with a point is a double."""
    return re.sub(r"(?<![\w.'])(\d+\.\d+)(?![\w.'])", r"\1D", sql)


def translated(sql: str) -> str:
    for pattern, word in _SPELLING:
        sql = re.sub(pattern, word, sql)
    return sql


#: Added before rounding: prices are cents over a quantity, so many values end in an exact half of the last place, which two engines round apart.
NUDGE = 3e-8


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to so many places, with one zero; ts as text."""
    near = lambda c: F.round(F.col(c).cast("double") + F.lit(NUDGE), digits) + F.lit(0.0)
    shape = {"double": near, "float": near, "timestamp": lambda c: F.col(c).cast("string"), "timestamp_ntz": lambda c: F.col(c).cast("string"), "date": lambda c: F.col(c).cast("string")}
    return df.select(*(shape.get(t, F.col)(c).alias(c) for c, t in df.dtypes))


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = panels.settled(sql) if name in SETTLED else sql


def panel_op(name: str, columns: Sequence[str], *steps: Step, panel: str = "bars_w", keys: Sequence[str] = ("symbol", "ts"), large: bool = False) -> None:
    """Registers a chain of steps over a panel, with these columns of its result; all of them are numbers. large: the SQL rounds the
    number's digits, as Spark does; the test database multiplies a double before it rounds, and some 1e13 leave no room for what decides."""
    bars, text = _PANELS[panel]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(apply_steps(bars(spark, sf_dir), *steps).select(*keys, *(F.col(c).cast("double").alias(c) for c in columns)))

    inner = steps_sql(f"({text})", panels.BAR_COLUMNS, *steps)
    near = lambda x: f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), 6) AS DOUBLE)" if large else f"round({x}, 6)"
    shown = [*(f"CAST({k} AS VARCHAR) AS {k}" if k == "ts" else k for k in keys), *(f"{near(f'CAST({c} AS DOUBLE) + {NUDGE}')} + 0.0 AS {c}" for c in columns)]
    register(name, query, translated(f"SELECT {', '.join(shown)} FROM {inner}"))


def sql_op(name: str, text: str, sources: Mapping[str, str] | None = None, by: Query | None = None) -> None:
    """Registers one SQL text over the panels bars_w and bars_h and the given tables: Spark runs it on its DataFrames, the test database on CTEs.
    sources: further CTEs, name to text. by: the operator's own query, which Spark runs instead of the text."""
    tables = [t for t in ("lineitem", "supplier", "orders", "events", "customer", "nation", "part") if re.search(rf"\{{{t}\}}", text + " ".join((sources or {}).values()))]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
        frames |= {p: f(spark, sf_dir) for p, (f, _) in _PANELS.items() if f"{{{p}}}" in text + " ".join((sources or {}).values())}
        for k, part in (sources or {}).items():
            frames[k] = spark.sql(doubled(part), **{n: v for n, v in frames.items() if f"{{{n}}}" in part})
        return rounded(spark.sql(doubled(text), **{n: v for n, v in frames.items() if f"{{{n}}}" in text}))

    parts = [(p, t) for p, (_, t) in _PANELS.items()] + list((sources or {}).items())
    named = ", ".join(f"_{k} AS ({re.sub(r'\{(\w+)\}', lambda m: m[1] if m[1] in tables else '_' + m[1], v)})" for k, v in parts)
    whole = re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in tables else "_" + m[1], text)
    register(name, (lambda spark, sf_dir: rounded(by(spark, sf_dir))) if by else query, translated(f"WITH {named}, _out AS ({whole}) SELECT * FROM _out"))
