"""Aggregates with accumulators in code, and code over the rows of a window."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rillflow.operators.arrow import groups

#: Accumulators that a task holds at a time; past it, they are sent on and begun anew.
HELD = 100_000


@dataclass(frozen=True)
class Accumulator:
    """An aggregate in code.

    ``create()`` makes an accumulator, ``add(acc, *values)`` takes in a row's values, ``merge(a, b)`` joins two and
    ``result(acc)`` gives a tuple. Accumulators are tuples of the types in ``state``, results of those in ``returns``
    (both as in ``"n bigint, last string"``). ``add`` and ``merge`` must not depend on the order of rows.
    """

    values: Sequence[str]
    state: str
    returns: str
    create: Callable[[], tuple]
    add: Callable[..., tuple]
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], tuple]


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def accumulate(df: DataFrame, keys: Sequence[str], own: Accumulator) -> DataFrame:
    """The results of ``own`` per key, in two stages.

    Each task first adds its rows to accumulators and sends these, not the rows; a key with very many rows reaches
    the second stage as a few accumulators per task.
    """
    keys = list(keys)
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    partial = T.StructType([*key_fields, T.StructField("acc", _schema(own.state))])
    final = T.StructType([*key_fields, *_schema(own.returns).fields])
    n = len(keys)
    state_names = _schema(own.state).names

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def sent():
            return _batch(partial, [(*k, dict(zip(state_names, acc))) for k, acc in held.items()])

        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            for row in zip(*lists):
                key = row[:n]
                acc = held.get(key)
                held[key] = own.add(own.create() if acc is None else acc, *row[n:])
            if len(held) >= HELD:
                yield sent()
                held.clear()
        if held:
            yield sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for key, parts in groups(batches, range(n)):
            acc = None
            for batch in parts:
                for other in batch.column(n).to_pylist():
                    other = tuple(other.values())
                    acc = other if acc is None else own.merge(acc, other)
            done.append((*key, *own.result(acc)))
            if len(done) >= 1_000:
                yield _batch(final, done)
                done = []
        if done:
            yield _batch(final, done)

    partials = df.select(*keys, *own.values).mapInArrow(add, partial)
    if not keys:
        return partials.coalesce(1).mapInArrow(merge, final)
    return partials.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, final)


def per_window(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    code: Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]],
    returns: str,
    slide: str | None = None,
) -> DataFrame:
    """Own code over all rows of each key and window ``[start, start + size)``, in order.

    ``code(key, batches)`` gets the key with the window's start and end, and the window's rows as Arrow batches in
    the order of ``order_by``, handed over one after another: it need not hold them all. It gives tuples of the types
    in ``returns``, each of which becomes a row with the keys, ``window_start`` and ``window_end`` in front. A window's
    rows are read by one task, since the code may depend on their order. Rows without a time are in no window.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    names = [c for c in df.columns if c not in keys]
    placed = df.where(F.col(ts).isNotNull()).withColumn("_w", window)
    placed = placed.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *names
    )
    group = [*keys, "window_start", "window_end"]
    fields = [T.StructField(f.name, f.dataType) for f in placed.schema.fields[: len(group)]]
    final = T.StructType([*fields, *_schema(returns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for key, parts in groups(batches, range(len(group))):
            for row in code(key, parts):
                done.append((*key, *row))
                if len(done) >= 1_000:
                    yield _batch(final, done)
                    done = []
        if done:
            yield _batch(final, done)

    placed = placed.repartition(*group).sortWithinPartitions(*group, *order_by)
    return placed.mapInArrow(run, final)
