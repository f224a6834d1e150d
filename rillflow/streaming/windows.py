"""Streaming aggregates made of Spark's own stateful operators.

A window is final, and emitted in append mode, once the watermark (the newest
event time seen, less the allowed delay) reaches its end. Rows behind the
watermark are dropped; ``numRowsDroppedByWatermark`` in the query's progress
counts them. The end of a bounded input does not close the last windows: use the
batch operators for bounded data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.time import duration_us
from rillflow.operators.windows import COUNT, Aggregates, finished, merge, partial
from rillflow.streaming.panes import sliding_counts


def with_event_time(stream: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Use ``ts`` as the clock and allow rows to be ``delay`` out of order.

    Zone-less timestamps are read in the session's time zone, because a watermark
    needs an instant.
    """
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def with_processing_time(stream: DataFrame, name: str = "arrived") -> DataFrame:
    """Use the wall clock; all rows of a micro-batch get the same time."""
    return stream.withColumn(name, F.current_timestamp()).withWatermark(name, "0 seconds")


def _bounded(grouped: DataFrame, keys: Sequence[str], names) -> DataFrame:
    return grouped.select(
        *keys,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *names,
    )


def tumbling(
    stream: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str] = (),
    aggregates: Aggregates = COUNT,
) -> DataFrame:
    window = F.window(ts, size).alias("_w")
    grouped = stream.groupBy(window, *keys).agg(*partial(aggregates))
    return _bounded(grouped, keys, finished(aggregates))


def sliding(
    stream: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    aggregates: Aggregates = COUNT,
    panes: bool = True,
    last: bool = False,
) -> DataFrame:
    """Sliding windows.

    In append mode, state holds one row per pane and window instead of updating
    every window for every row. Pass ``panes=False`` for update mode, which
    cannot chain two aggregations. With ``last=True`` counts are held by pane only
    and a window's rows are made when it is final; no stateful operator can follow.
    """
    if not panes or duration_us(size) % duration_us(slide):
        window = F.window(ts, size, slide).alias("_w")
        grouped = stream.groupBy(window, *keys).agg(*partial(aggregates))
        return _bounded(grouped, keys, finished(aggregates))
    if last and all(isinstance(a, tuple) and a[0] == "count" for a in aggregates.values()):
        return sliding_counts(stream, ts, keys, list(aggregates), size, slide)
    pane = stream.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(*partial(aggregates))
    window = F.window("_p", size, slide).alias("_w")
    grouped = pane.groupBy(window, *keys).agg(*merge(aggregates))
    return _bounded(grouped, keys, finished(aggregates))


def session(
    stream: DataFrame,
    ts: str,
    gap: str,
    keys: Sequence[str],
    aggregates: Aggregates = COUNT,
) -> DataFrame:
    window = F.session_window(ts, gap).alias("_w")
    grouped = stream.groupBy(window, *keys).agg(*partial(aggregates))
    return _bounded(grouped, keys, finished(aggregates))


def late_updates(
    stream: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    delay: str,
    lateness: str,
    aggregates: Aggregates = COUNT,
) -> DataFrame:
    """Tumbling windows whose results are revised by late rows; use update mode.

    Rows count while they are at most ``delay + lateness`` behind. For a result
    that first appears when the window ends, see ``late_windows``.
    """
    total = duration_us(delay) + duration_us(lateness)
    timed = with_event_time(stream, ts, f"{total} microseconds")
    return tumbling(timed, ts, size, keys, aggregates)


def distinct_rows(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "0 seconds") -> DataFrame:
    """Each (``keys``, ``ts``) once; rows at or behind the watermark are dropped and counted."""
    return with_event_time(stream, ts, delay).dropDuplicates([*keys, ts])


def running_totals(
    stream: DataFrame, keys: Sequence[str], aggregates: Aggregates = COUNT
) -> DataFrame:
    """The current total of each key that changed in a micro-batch; use update mode."""
    grouped = stream.groupBy(*keys).agg(*partial(aggregates))
    return grouped.select(*keys, *finished(aggregates))
