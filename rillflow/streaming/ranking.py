"""The best rows of each group of a stream, as a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillflow.streaming.run import use_rocksdb


class _Best(StatefulProcessor):
    """Keeps the first ``n`` rows of a window in state and gives them when the watermark reaches its end."""

    def __init__(self, n: int, columns: Sequence[str], measure: str, ties: Sequence[str], schema: T.StructType, window: str):
        self.n, self.columns, self.window = n, list(columns), window
        self.by, self.rising = [measure, *ties], [False, *[True] * len(ties)]
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def _held(self) -> pd.DataFrame:
        rows = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        return pd.DataFrame(rows, columns=self.columns)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, first = self._held(), not self.best.exists()
        for more in rows:
            more = more[self.columns]
            held = pd.concat([held, more], ignore_index=True) if len(held) else more
            held = held.sort_values(self.by, ascending=self.rising, kind="stable").head(self.n)
        self.best.put([tuple(r) for r in held.astype(object).itertuples(index=False, name=None)])
        if first:
            self.handle.registerTimer(-(-pd.Timestamp(key[0]).value // 1_000_000))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        self.best.clear()
        held.insert(0, "rk", range(1, len(held) + 1))
        held.insert(0, self.window, [key[0]] * len(held))
        yield held

    def close(self) -> None:
        pass


def top_items(
    stream: DataFrame, n: int, measure: str, ties: Sequence[str], window: str = "window_end"
) -> DataFrame:
    """The ``n`` rows with the largest ``measure`` of each window, with their rank ``rk``.

    ``stream`` holds window aggregates in append mode. The result is a stream like any other, so that more can follow.
    Equal measures go by ``ties``, rising. State holds at most ``n`` rows per window that the watermark has not reached
    the end of.
    """
    use_rocksdb(stream.sparkSession)
    fields = [f for f in stream.schema.fields if f.name not in (window, "window_start")]
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = T.StructType(
        [T.StructField(window, stream.schema[window].dataType), T.StructField("rk", T.IntegerType()), *kept.fields]
    )
    processor = _Best(n, kept.names, measure, list(ties), kept, window)
    return stream.groupBy(window).transformWithStateInPandas(processor, out, "append", "EventTime")
