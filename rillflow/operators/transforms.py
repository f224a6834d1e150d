"""Row-wise, routing and multi-stream operators for batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions.text import to_text, tokens


def project(df: DataFrame, **columns: Column) -> DataFrame:
    """One output row per input row with just the given columns."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


def words(lines: DataFrame, line: str = "value") -> DataFrame:
    """(word, 1) for every space-separated token."""
    return lines.select(F.explode(tokens(line)).alias("word")).withColumn("one", F.lit(1))


def unnest(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row per array element, in place of the array."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.explode(array).alias(item))


def keep_and_map(df: DataFrame, condition: Column, **columns: Column) -> DataFrame:
    """Zero or one output row per input row."""
    return project(df.where(condition), **columns)


def partition_by(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by keys; rows are unchanged."""
    return df.repartition(*keys)


def redistribute(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows evenly. Round robin, so a retried task sends the same rows."""
    return df.repartition(partitions)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a scan with fewer splits than cores; others are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return redistribute(df, cores) if df.rdd.getNumPartitions() < cores else df


def map_partitions(
    df: DataFrame,
    set_up: Callable[[], object],
    apply: Callable[[object, str, pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    tear_down: Callable[[object], None] | None = None,
) -> DataFrame:
    """Vectorised map with a resource per partition.

    ``apply`` gets the resource, the task's name and a batch of rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = set_up()
        task = f"partition-{TaskContext.get().partitionId()}"
        try:
            for batch in batches:
                yield apply(resource, task, batch)
        finally:
            if tear_down is not None:
                tear_down(resource)

    return df.mapInPandas(run, schema)


def label(
    df: DataFrame,
    cases: Sequence[tuple[str, Column]],
    otherwise: str | None = None,
    first_only: bool = True,
    name: str = "labels",
) -> DataFrame:
    """Add an array of labels: the first case that holds, or all that hold."""
    chosen = [F.when(condition, F.lit(text)) for text, condition in cases]
    if first_only:
        labels = F.array_compact(F.array(F.coalesce(*chosen, F.lit(otherwise))))
    else:
        labels = F.array_compact(F.array(*chosen))
        if otherwise is not None:
            labels = F.when(F.size(labels) == 0, F.array(F.lit(otherwise))).otherwise(
                labels
            )
    return df.withColumn(name, labels)


def level_cases(value: str, warn: float, alarm: float) -> list[tuple[str, Column]]:
    """normal below ``warn``, warn below ``alarm``, else alarm."""
    v = F.col(value)
    return [("normal", v < warn), ("warn", v < alarm), ("alarm", v.isNotNull())]


def select_label(df: DataFrame, wanted: str, name: str = "labels") -> DataFrame:
    """Rows that carry a label."""
    return df.where(F.array_contains(name, wanted))


def union(*streams: DataFrame) -> DataFrame:
    """Rows of all inputs, duplicates kept."""
    return reduce(DataFrame.unionByName, streams)


def connect(
    first: DataFrame, second: DataFrame, map_first: Column, map_second: Column
) -> DataFrame:
    """Bring two inputs of different type to one ``side, value`` output."""

    def one(df: DataFrame, side: int, value: Column) -> DataFrame:
        return df.select(F.lit(side).alias("side"), value.cast("string").alias("value"))

    return union(one(first, 1, map_first), one(second, 2, map_second))


def side_output(df: DataFrame, condition: Column, tag: str) -> DataFrame:
    """All rows with a null tag, followed by a tagged copy of those that qualify.

    Built as one pass, so the input is read once.
    """
    tags = F.when(condition, F.array(F.lit(None).cast("string"), F.lit(tag))).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    return df.withColumn("tag", F.explode(tags))


def describe_keyed(df: DataFrame, key: str, time: str | None = None) -> DataFrame:
    """One line per row that names the key, the event time (if any) and the row."""
    at = F.lit("null") if time is None else F.col(time).cast("string")
    line = F.concat(
        F.lit("key="),
        F.col(key).cast("string"),
        F.lit(", time="),
        F.coalesce(at, F.lit("null")),
        F.lit(", row="),
        to_text("", *df.columns),
    )
    return df.select(line.alias("value"))
