"""Ordered per-key calculations that stay parallel when one key is very large.

A window function sends all rows of a key to one task. Here keys with more rows
than a task should hold are cut along their order into consecutive parts. Each
part is a window group of its own, and what earlier (or later) parts contribute
is added from a small table with one row per part.

Size bounds, with N rows in total and L = max(rows_per_task, N / max_parts):
at most ``max_parts`` keys have more than L rows, and they are cut into at most
about ``2 * max_parts`` parts. Only tables of that size are collected or
broadcast. Keys below the limit take the plain window path; when no key is
above it, nothing is joined at all. Without keys the positions become literals in
the plan, so there are fewer of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

PART = "_part"
_HOT = "_hot"
_BOUNDS = "_bounds"
_SAMPLES_PER_PART = 32
_MAX_LITERAL_PARTS = 2_000


@dataclass(frozen=True)
class Limits:
    """How many rows of one key a task may take, and the most parts to cut."""

    rows_per_task: int = 500_000
    max_parts: int = 50_000


DEFAULT = Limits()


@dataclass(frozen=True)
class Parts:
    """Rows with a ``_part`` column, grouped by ``keys`` and part without hot groups.

    ``total`` is the number of rows that were measured.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    split: bool
    total: int

    @property
    def group(self) -> list[str]:
        return [*self.keys, PART] if self.split else list(self.keys)

    def with_df(self, df: DataFrame) -> Parts:
        return replace(self, df=df)

    def result(self) -> DataFrame:
        return self.df.drop(PART, _HOT) if self.split else self.df


def _order(order_by: Sequence[str]) -> Column:
    if len(order_by) == 1:
        return F.col(order_by[0])
    return F.struct(*[F.col(c) for c in order_by])


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"_h_{k}"])
    return condition


def _hot_bounds(
    df: DataFrame,
    total: int,
    keys: Sequence[str],
    order_by: Sequence[str],
    limits: Limits,
) -> tuple[list[Row], StructType] | None:
    """One row per hot key with the sorted positions at which to cut it."""
    if total <= limits.rows_per_task:
        return None
    most = limits.max_parts if keys else min(limits.max_parts, _MAX_LITERAL_PARTS)
    limit = max(limits.rows_per_task, math.ceil(total / most))
    renamed = [F.col(k).alias(f"_h_{k}") for k in keys]
    spark = df.sparkSession
    key_schema = df.select(*renamed).schema
    fraction = min(1.0, _SAMPLES_PER_PART / limit)
    sampled = df.select(*keys, _order(order_by).alias("_at")).sample(fraction, seed=17)
    if keys:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        hot_rows = counts.where(F.col("_n") > limit).select(*renamed).collect()
        if not hot_rows:
            return None
        hot = F.broadcast(spark.createDataFrame(hot_rows, key_schema))
        sampled = sampled.join(hot, _same_keys(sampled, hot, keys))
    positions = sampled.groupBy(*key_schema.names)
    every = max(1, round(limit * fraction))
    cuts = positions.agg(F.sort_array(F.collect_list("_at")).alias("_at")).select(
        *key_schema.names,
        F.filter("_at", lambda _, i: (i > 0) & (i % every == 0)).alias(_BOUNDS),
    )
    at_type = sampled.schema["_at"].dataType
    schema = StructType(
        [*key_schema.fields, StructField(_BOUNDS, ArrayType(at_type), True)]
    )
    found = cuts.collect()
    return (found, schema) if found else None


def _literal(value: object, kind: DataType) -> Column:
    if isinstance(kind, ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    if isinstance(kind, StructType):
        return F.struct(
            *[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)]
        )
    return F.lit(value).cast(kind)


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    limits: Limits = DEFAULT,
    measured_on: DataFrame | None = None,
) -> Parts:
    """Add ``_part`` so that no (key, part) group holds many more than the limit.

    Keys that are not cut are whole in part 0; without keys all rows are one group.
    ``order_by`` must order the rows of a key totally. The input is read once to
    count its rows, and again for hot keys when there are more than one task should
    hold. When ``df`` is itself costly, ``measured_on`` can name a cheaper frame with
    the same key and order columns and at least as many rows in any stretch of a key.
    """
    keys, order_by = tuple(keys), tuple(order_by)
    measured = (df if measured_on is None else measured_on).select(*keys, *order_by)
    total = measured.count()
    found = _hot_bounds(measured, total, keys, order_by, limits)
    if found is None:
        return Parts(df, keys, order_by, False, total)
    hot, schema = found
    widest = max(len(row[_BOUNDS]) for row in hot)
    if keys:
        bounds = df.sparkSession.createDataFrame(hot, schema)
        bounds = bounds.withColumn(_BOUNDS, F.sort_array(_BOUNDS))
        marked = df.join(F.broadcast(bounds), _same_keys(df, bounds, keys), "left")
    else:
        positions = _literal(hot[0][_BOUNDS], schema[_BOUNDS].dataType)
        marked = df.withColumn(_BOUNDS, F.sort_array(positions))
    marked = marked.withColumns({_HOT: F.col(_BOUNDS).isNotNull(), PART: F.lit(0)})
    # Binary search for the last bound that is not above the row, one projection
    # per step: these stay in generated code, unlike a lambda.
    at = _order(order_by)
    for bit in reversed(range(max(1, widest.bit_length()))):
        step = 1 << bit
        bound = F.get(_BOUNDS, F.col(PART) + F.lit(step - 1))
        marked = marked.withColumn(
            PART, F.col(PART) + F.when(at >= bound, step).otherwise(0)
        )
    return Parts(marked.select(*df.columns, _HOT, PART), keys, order_by, True, total)


@dataclass(frozen=True)
class Running:
    """A value of each row that depends on the rows before (or after) it."""

    kind: str
    value: Column | None = None
    inclusive: bool = True


def running_sum(value: Column | str, inclusive: bool = True) -> Running:
    return Running("sum", _column(value), inclusive)


def running_count(condition: Column | None = None, inclusive: bool = True) -> Running:
    """Rows so far, or rows so far that meet a condition."""
    one = F.lit(1) if condition is None else F.when(condition, 1)
    return Running("count", one, inclusive)


def running_max(value: Column | str, inclusive: bool = True) -> Running:
    return Running("max", _column(value), inclusive)


def running_min(value: Column | str, inclusive: bool = True) -> Running:
    return Running("min", _column(value), inclusive)


def first_value(value: Column | str) -> Running:
    """The value in the key's first row."""
    return Running("first", _column(value))


def previous(value: Column | str) -> Running:
    return Running("previous", _column(value))


def following(value: Column | str) -> Running:
    return Running("following", _column(value))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


_FOLD = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _within_part(run: Running, parts: Parts) -> Column:
    ordered = Window.partitionBy(*parts.group).orderBy(*parts.order_by)
    if run.kind in _FOLD:
        last = 0 if run.inclusive else -1
        return _FOLD[run.kind](run.value).over(
            ordered.rowsBetween(Window.unboundedPreceding, last)
        )
    boxed = F.struct(run.value.alias("v"))
    if run.kind == "first":
        return F.first(boxed).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    shift = F.lag if run.kind == "previous" else F.lead
    return shift(boxed).over(ordered)


def _part_total(run: Running, order_by: Sequence[str]) -> Column:
    if run.kind in _FOLD:
        return _FOLD[run.kind](run.value)
    boxed = F.struct(run.value.alias("v"))
    pick = F.max_by if run.kind == "previous" else F.min_by
    return pick(boxed, _order(order_by))


def _from_other_parts(run: Running, name: str, keys: Sequence[str]) -> Column:
    ordered = Window.partitionBy(*keys).orderBy(PART)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    if run.kind in _FOLD:
        fold = F.sum if run.kind == "count" else _FOLD[run.kind]
        return fold(name).over(before)
    if run.kind == "first":
        return F.first(name).over(before)
    shift = F.lag if run.kind == "previous" else F.lead
    return shift(name).over(ordered)


def _combine(run: Running, inner: Column, outer: Column) -> Column:
    if run.kind == "count":
        return inner + F.coalesce(outer, F.lit(0))
    if run.kind == "sum":
        return F.coalesce(inner + outer, inner, outer)
    if run.kind == "max":
        return F.greatest(inner, outer)
    if run.kind == "min":
        return F.least(inner, outer)
    if run.kind == "first":
        return F.coalesce(outer, inner)
    return F.coalesce(inner, outer)


def add_running(parts: Parts, columns: dict[str, Running]) -> Parts:
    """Add running columns to rows that were cut by :func:`cut`."""
    df = parts.df
    if not parts.split:
        added = {
            name: _unboxed(run, _within_part(run, parts)) for name, run in columns.items()
        }
        return parts.with_df(df.withColumns(added))

    totals = (
        df.where(_HOT)
        .groupBy(*parts.group)
        .agg(
            *[
                _part_total(run, parts.order_by).alias(f"_o_{n}")
                for n, run in columns.items()
            ]
        )
    )
    carried = totals.select(
        *[F.col(k).alias(f"_h_{k}") for k in parts.keys],
        F.col(PART).alias("_h_part"),
        *[
            _from_other_parts(run, f"_o_{n}", parts.keys).alias(f"_o_{n}")
            for n, run in columns.items()
        ],
    )
    inner = df.withColumns(
        {f"_i_{n}": _within_part(run, parts) for n, run in columns.items()}
    )
    joined = inner.join(
        F.broadcast(carried),
        _same_keys(inner, carried, parts.keys) & (inner[PART] == carried["_h_part"]),
        "left",
    )
    combined = [
        _unboxed(run, _combine(run, F.col(f"_i_{n}"), F.col(f"_o_{n}"))).alias(n)
        for n, run in columns.items()
    ]
    kept = [c for c in df.columns if c not in columns]
    return parts.with_df(joined.select(*kept, *combined))


def _unboxed(run: Running, value: Column) -> Column:
    return value if run.kind in _FOLD else value.getField("v")


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: dict[str, Running],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add running columns per key, in the order of ``order_by``."""
    return add_running(cut(df, keys, order_by, limits), columns).result()
