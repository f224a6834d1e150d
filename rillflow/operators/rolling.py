"""Aggregates that give one output row per input row of a key.

Spark has no arrival order, so every function takes the columns that define it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.skew import (
    DEFAULT,
    Limits,
    add_running,
    cut,
    first_value,
    running_count,
    running_max,
    running_min,
    running_sum,
    with_running,
)


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: Column | str,
    name: str = "sum",
    limits: Limits = DEFAULT,
) -> DataFrame:
    return with_running(df, keys, order_by, {name: running_sum(value)}, limits)


def rolling_count(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "cnt",
    limits: Limits = DEFAULT,
) -> DataFrame:
    return with_running(df, keys, order_by, {name: running_count()}, limits)


def _rolling_extreme(run, df, keys, order_by, value, limits) -> DataFrame:
    others = [c for c in df.columns if c not in keys and c != value]
    columns = {value: run(value)}
    columns.update({c: first_value(c) for c in others})
    named = {f"_r_{c}": r for c, r in columns.items()}
    out = with_running(df, keys, order_by, named, limits)
    return out.select(
        *[F.col(f"_r_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def rolling_max(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Running maximum; every other column stays as in the key's first row."""
    return _rolling_extreme(running_max, df, keys, order_by, value, limits)


def rolling_min(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Running minimum; every other column stays as in the key's first row."""
    return _rolling_extreme(running_min, df, keys, order_by, value, limits)


def rolling_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    literals: dict[str, object],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Running sum of ``value`` where reduced rows take literals in other columns.

    The first row of a key is passed on unchanged.
    """
    parts = cut(df, keys, order_by, limits)
    parts = add_running(parts, {"_sum": running_sum(value), "_rn": running_count()})
    types = dict(df.dtypes)
    first = F.col("_rn") == 1

    def out(c: str) -> Column:
        if c == value:
            return F.col("_sum").cast(types[c]).alias(c)
        if c in literals:
            return (
                F.when(first, F.col(c))
                .otherwise(F.lit(literals[c]).cast(types[c]))
                .alias(c)
            )
        return F.col(c)

    return parts.result().select(*[out(c) for c in df.columns])
