"""Exponentially weighted means with adjusted weights: a recurrence over a symbol's bars in time order, one step a bar.

Rows meet by symbol and are sorted by time; a task walks through them in Arrow batches and carries two sums of each mean from one batch to the next,
so neither a symbol's length nor a span's reach is held anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from barloom.functions.portable import KEY

#: Mean's name to its column and span.
Means = Mapping[str, tuple[str, int]]


def decayed(x: np.ndarray, keep: float, before: float) -> np.ndarray:
    """The sums s[i] = keep * s[i - 1] + x[i], from s[-1] = before on."""
    own = pd.Series(x).ewm(alpha=1 - keep, adjust=True).sum().to_numpy()
    return own + before * keep ** np.arange(1, len(x) + 1)


def with_means(df: DataFrame, means: Means) -> DataFrame:
    """df and a column for each mean: sum((1-a)^i x[t-i]) / sum((1-a)^i) over the values so far, a = 2 / (span + 1); null where x is null."""
    kept = [c for c in df.columns if c not in means]
    schema = StructType([*(df.schema[c] for c in kept), *(StructField(name, DoubleType()) for name in means)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = object(), {name: (0.0, 0.0) for name in means}
        for batch in batches:
            symbols = batch.column(batch.schema.get_field_index("symbol")).to_pandas().to_numpy()
            edges = [0, *(np.flatnonzero(symbols[1:] != symbols[:-1]) + 1).tolist(), len(symbols)] if len(symbols) else [0]
            out = {name: np.full(len(symbols), np.nan) for name in means}
            columns = {x: np.asarray(batch.column(batch.schema.get_field_index(x)).to_pandas(), dtype=float) for x, _ in means.values()}
            for a, b in zip(edges, edges[1:], strict=False):
                if symbols[a] != last:
                    last, carried = symbols[a], {name: (0.0, 0.0) for name in means}
                for name, (x, span) in means.items():
                    values, keep = columns[x][a:b], 1 - 2 / (span + 1)
                    there = ~np.isnan(values)
                    top, low = decayed(np.where(there, values, 0.0), keep, carried[name][0]), decayed(there.astype(float), keep, carried[name][1])
                    carried[name] = float(top[-1]), float(low[-1])
                    out[name][a:b] = np.divide(top, low, out=np.full(b - a, np.nan), where=there)
            held = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*held, *(pa.array(v, from_pandas=True) for v in out.values())], names=[*kept, *out])

    return df.repartition("symbol").sortWithinPartitions("symbol", "ts").mapInArrow(walk, schema)


def ewm_sql(relation: str, means: Means) -> str:
    """The same by a self-join of each row with those before it whose weight shows in a double."""
    reach = {n: int(np.ceil(np.log(1e-17) / np.log(1 - 2 / (n + 1)))) for _, n in means.values()}
    parts = ", ".join(
        f"CASE WHEN any_value(a.{x}) IS NOT NULL THEN sum(b.{x} * power({1 - 2 / (n + 1)}, a._i - b._i)) FILTER (a._i - b._i < {reach[n]}) / sum(power({1 - 2 / (n + 1)}, a._i - b._i)) FILTER (b.{x} IS NOT NULL AND a._i - b._i < {reach[n]}) END AS {name}"
        for name, (x, n) in means.items()
    )
    held = f"SELECT *, row_number() OVER ({KEY}) AS _i FROM {relation}"
    return f"(WITH _e AS ({held}) SELECT any_value(a) AS _r, {parts} FROM _e a JOIN _e b ON a.symbol = b.symbol AND b._i <= a._i AND b._i > a._i - {max(reach.values())} GROUP BY a.symbol, a._i)"
