"""Window aggregates over event time and over row counts (batch form)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.time import duration_us, from_micros, interval, micros
from rillflow.operators.skew import (
    DEFAULT,
    Limits,
    add_running,
    cut,
    running_count,
    running_max,
)



@dataclass(frozen=True)
class OwnAggregate:
    """An aggregate of one's own that can be computed in parts.

    ``partial`` aggregates rows, ``merge`` aggregates partial values, and ``finish``
    makes the result of a merged value. A mean: partial ``struct(sum, count)``,
    merged by adding up both fields, finished by dividing them.
    """

    partial: Column
    merge: Callable[[Column], Column]
    finish: Callable[[Column], Column] = lambda merged: merged


def distinct_estimate(column: str, lg_k: int = 14) -> OwnAggregate:
    """How many values of ``column`` there are, from sketches that merge across panes and windows.

    A sketch has ``2 ** lg_k`` registers at most. Up to about a tenth of that many values it remembers hashes and the
    rounded estimate is the number itself but for hash collisions (some n * n / 2**27 values); beyond, the relative
    standard error is about ``1.04 / sqrt(2 ** lg_k)``: 0.8 % for 14. Nulls do not count.
    """
    return OwnAggregate(F.hll_sketch_agg(column, lg_k), F.hll_union_agg, F.hll_sketch_estimate)


# name -> (how, column), where count ignores its column, or an own aggregate
Aggregates = Mapping[str, tuple[str, str | None] | OwnAggregate]

COUNT: Aggregates = {"cnt": ("count", None)}

_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def partial(aggregates: Aggregates) -> list[Column]:
    columns = []
    for name, what in aggregates.items():
        if isinstance(what, OwnAggregate):
            columns.append(what.partial.alias(name))
        else:
            how, c = what
            value = F.lit(1) if how == "count" else F.col(c)
            columns.append(_PARTIAL[how](value).alias(name))
    return columns


def merge(aggregates: Aggregates) -> list[Column]:
    return [
        (
            what.merge(F.col(name))
            if isinstance(what, OwnAggregate)
            else _MERGE[what[0]](name)
        ).alias(name)
        for name, what in aggregates.items()
    ]


def finished(aggregates: Aggregates) -> list[Column]:
    """The results, from partial or merged values."""
    return [
        (what.finish(F.col(name)) if isinstance(what, OwnAggregate) else F.col(name)).alias(
            name
        )
        for name, what in aggregates.items()
    ]


def _bounded(grouped: DataFrame, keys: Sequence[str], names) -> DataFrame:
    return grouped.select(
        *keys,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *names,
    )


def tumbling(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str] = (),
    aggregates: Aggregates = COUNT,
) -> DataFrame:
    """Aggregates per key and window ``[start, start + size)``; no keys means one group."""
    window = F.window(ts, size).alias("_w")
    grouped = df.groupBy(*keys, window).agg(*partial(aggregates))
    return _bounded(grouped, keys, finished(aggregates))


def sliding(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    aggregates: Aggregates = COUNT,
    tasks: int | None = None,
) -> DataFrame:
    """Aggregates per key and sliding window.

    When the slide divides the size, rows are first folded into slide-long panes,
    and panes instead of rows are copied into the windows that hold them. The
    windows that end within one stretch of ``size`` need the panes of at most two
    stretches, so a pane is sent to its two stretches once, and the copies are made
    and folded inside the task. The number of those tasks is fixed: chosen by the
    size of their input, as adaptive execution does, they would be too few for the
    copies. ``tasks`` sets it, by default it is ``spark.sql.shuffle.partitions``;
    rule of thumb: panes times size over slide, at 10 million copies a task.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        window = F.window(ts, size, slide).alias("_w")
        grouped = df.groupBy(*keys, window).agg(*partial(aggregates))
        return _bounded(grouped, keys, finished(aggregates))
    kind = df.schema[ts].dataType

    def start_of(us: Column, length: int) -> Column:
        return us - F.pmod(us, F.lit(length))

    rows = df.where(F.col(ts).isNotNull())
    at = micros(ts, kind)
    panes = rows.groupBy(*keys, start_of(at, slide_us).alias("_pane")).agg(
        *partial(aggregates)
    )
    first_end, last_end = F.col("_pane") + slide_us, F.col("_pane") + size_us
    stretches = F.array_distinct(
        F.array(start_of(first_end - 1, size_us), start_of(last_end - 1, size_us))
    )
    ends = F.sequence(
        F.greatest(first_end, F.col("_stretch") + slide_us),
        F.least(last_end, F.col("_stretch") + size_us),
        F.lit(slide_us),
    )
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows = (
        panes.withColumn("_stretch", F.explode(stretches))
        .repartition(tasks, *keys, "_stretch")
        .withColumn("_end", F.explode(ends))
        .groupBy(*keys, "_stretch", "_end")
        .agg(*merge(aggregates))
    )
    return windows.select(
        *keys,
        from_micros(F.col("_end") - size_us, kind).alias("window_start"),
        from_micros("_end", kind).alias("window_end"),
        *finished(aggregates),
    )


def session(
    df: DataFrame,
    ts: str,
    gap: str,
    keys: Sequence[str],
    aggregates: Aggregates = COUNT,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Aggregates per key and session; rows at most ``gap`` apart share a session.

    Rows of one gap-long slot always share a session, so slots are aggregated
    first and only slots are put in order.
    """
    slots = df.groupBy(*keys, F.window(ts, gap).alias("_w")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), *partial(aggregates)
    )
    rows = df.select(*keys, F.col(ts).alias("_first"))
    parts = cut(slots.drop("_w"), keys, ["_first"], limits, measured_on=rows)
    parts = add_running(parts, {"_before": running_max("_last", inclusive=False)})
    opens = F.col("_before").isNull() | (
        F.col("_first") > F.col("_before") + interval(gap)
    )
    parts = parts.with_df(
        parts.df.withColumn("_open", F.when(opens, F.col("_first"))).drop("_before")
    )
    parts = add_running(parts, {"window_start": running_max("_open")})
    return (
        parts.result()
        .groupBy(*keys, "window_start")
        .agg(
            (F.max("_last") + interval(gap)).alias("window_end"), *merge(aggregates)
        )
        .select(*keys, "window_start", "window_end", *finished(aggregates))
    )


def count_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    size: int,
    slide: int | None = None,
    aggregates: Aggregates = COUNT,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Aggregates of the last ``size`` rows of a key after every ``slide`` rows.

    Without a slide, windows follow each other and an incomplete last one is not
    emitted. ``seen`` is the number of the key's rows at that moment.
    """
    slide = size if slide is None else slide
    numbered = add_running(cut(df, keys, order_by, limits), {"_rn": running_count()})
    rn = F.col("_rn")
    first = F.ceil(rn / slide)
    last = F.floor((rn + (size - 1)) / slide)
    firings = F.when(last >= first, F.sequence(first, last))
    windows = (
        numbered.result()
        .withColumn("_firing", F.explode(firings))
        .groupBy(*keys, "_firing")
        .agg(F.max("_rn").alias("_last"), *partial(aggregates))
    )
    return windows.where(F.col("_last") == F.col("_firing") * slide).select(
        *keys, (F.col("_firing") * slide).alias("seen"), *finished(aggregates)
    )
