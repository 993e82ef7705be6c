"""The zigzag pivot line: a recurrence over a symbol's bars in time order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Closes that are looked at for the next turn; doubled while there is none.
STEP = 64


class _Swing:
    """The state between two bars: the extreme of the current swing (NaN before the first close) and its direction."""

    def __init__(self, reversal: float):
        self.reversal, self.extreme, self.direction = reversal, np.nan, 0

    def walk(self, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pivots and directions at these closes, none of which is missing; the state goes on."""
        pivots, directions = np.empty(len(closes)), np.empty(len(closes), np.int32)
        at, step = 0, STEP
        if len(closes) and np.isnan(self.extreme):
            self.extreme, pivots[0], directions[0], at = closes[0], closes[0], 0, 1
        while at < len(closes):
            seen = closes[at : at + step]
            run = np.full(len(seen) + 1, self.extreme)  # the extreme before each close, and after the last
            if self.direction:
                np.copyto(run[1:], seen)
                run = (np.maximum if self.direction > 0 else np.minimum).accumulate(run)
            before, turns = run[:-1], np.zeros(len(seen), bool)
            if self.direction >= 0:
                turns |= seen <= before * (1 - self.reversal)
            if self.direction <= 0:
                turns |= seen >= before * (1 + self.reversal)
            turned = bool(turns.any())
            n = int(turns.argmax()) if turned else len(seen)
            pivots[at : at + n], directions[at : at + n] = run[1 : n + 1], self.direction
            self.extreme, at = run[n], at + n
            if turned:
                down = self.direction >= 0 and closes[at] <= self.extreme * (1 - self.reversal)
                self.extreme, self.direction, step = closes[at], -1 if down else 1, STEP
                pivots[at], directions[at] = self.extreme, self.direction
                at += 1
            else:
                step *= 2
        return pivots, directions


def zigzag(bars: DataFrame, reversal: float) -> DataFrame:
    """symbol, ts, pivot, direction: the running extreme of the current swing and its direction; a swing turns once the close is `reversal`
    beyond its extreme, and the first one starts that far from the first close. A bar without a close keeps the state, which is null and 0 before the first.

    Rows meet by symbol and are sorted by time; a task walks through them in Arrow batches and carries a symbol's extreme and direction on, so no
    symbol's bars are held anywhere."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), _Swing(reversal)
        for batch in batches:
            names, closes = batch.column(0).to_pandas().to_numpy(), np.asarray(batch.column(2).to_pandas(), dtype=float)
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else [0]
            pivots, directions = np.full(len(names), np.nan), np.zeros(len(names), np.int32)
            for a, b in zip(edges, edges[1:], strict=False):
                if names[a] != last:
                    last, state = names[a], _Swing(reversal)
                there = np.flatnonzero(~np.isnan(closes[a:b]))
                held = [state.extreme], [state.direction]
                walked = state.walk(closes[a:b][there])
                known = np.searchsorted(there, np.arange(b - a), side="right")  # how many closes there are up to each bar
                pivots[a:b], directions[a:b] = np.concatenate([held[0], walked[0]])[known], np.concatenate([held[1], walked[1]])[known]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pivots, from_pandas=True), pa.array(directions)], names=["symbol", "ts", "pivot", "direction"])

    kind = bars.schema["ts"].dataType.simpleString()
    held = bars.selectExpr("symbol", "ts", "CAST(close AS DOUBLE) AS close")
    return held.repartition("symbol").sortWithinPartitions("symbol", "ts").mapInArrow(walk, f"symbol string, ts {kind}, pivot double, direction int")
