"""Running reduction by any associative function: a prefix scan over sorted parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.arrow import key_at, key_starts, same_key
from rillflow.operators.checkpoints import run_folder

#: What a row of a stored part is: a row of the input, the part's first key, its last key and the state there.
ROW, FIRST, LAST = 0, 1, 2

State = tuple
Reduce = Callable[[State, State], State]


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    values: Sequence[str],
    reduce: Reduce,
    parts: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Every row with its ``values`` replaced by the reduction of its key's rows so far.

    ``reduce(left, right)`` takes and gives tuples of the values; it must be associative, and ``left`` holds the
    earlier rows. A key's first row stays as it is. ``order_by`` must order a key's rows totally: rows that are equal
    in it have no order of their own.

    Rows are sorted in ranges of key and order, so a key with many rows lies in many parts. Each part is reduced on
    its own and written; a part hands one state to those behind it, which are reduced along the parts in the driver;
    rows that go on with an earlier part's key then take in what they were handed. The driver holds two rows per part
    (``parts``, by default ``spark.sql.shuffle.partitions``). The result reads the stored parts, which lie in
    ``folder`` (by default a fresh one below the shared folder).
    """
    spark = df.sparkSession
    names, keys, values = df.columns, list(keys), list(values)
    key_at_columns = [names.index(k) for k in keys]
    value_columns = [names.index(v) for v in values]
    schema = df.schema
    stored = T.StructType(
        [
            T.StructField("mark", T.IntegerType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("row", _nullable(schema)),
        ]
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None
        state, opened, kind = None, True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema
            starts = set(key_starts(batch, key_at_columns).tolist())
            begin = key_at(batch, key_at_columns, 0)
            if last is not None and same_key(last, begin):
                starts.discard(0)
            if first is None:
                first = begin
                yield _marked(_only(kind, key_at_columns, begin), FIRST, part, [True])
            states, flags = [], []
            for at, own in enumerate(zip(*(batch.column(c).to_pylist() for c in value_columns))):
                if at in starts:
                    opened = opened and state is None
                    state = own
                else:
                    state = reduce(state, own)
                states.append(state)
                flags.append(opened)
            last = key_at(batch, key_at_columns, batch.num_rows - 1)
            yield _marked(_with_values(batch, value_columns, states), ROW, part, flags)
        if first is not None:
            end = _only(kind, key_at_columns + value_columns, (*last, *state))
            yield _marked(end, LAST, part, [opened])

    placed = df.repartitionByRange(*([parts] if parts else []), *keys, *order_by)
    placed = placed.sortWithinPartitions(*keys, *order_by)
    path = folder or run_folder(spark, "reduce")
    placed.mapInArrow(fold, stored).write.partitionBy("mark").parquet(path)
    rows = spark.read.schema(stored).parquet(path)
    carried = _carried(rows.where(F.col("mark") != ROW).select("mark", "part", "open", "row").collect(), keys, values, reduce)
    rows = rows.where(F.col("mark") == ROW)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner = pa.RecordBatch.from_struct_array(batch.column(1))
            own = zip(*(inner.column(c).to_pylist() for c in value_columns))
            before = map(carried.get, batch.column(0).to_pylist())
            states = [s if b is None else reduce(b, s) for b, s in zip(before, own)]
            yield _with_values(inner, value_columns, states)

    if not carried:
        return rows.select("row.*")
    done = rows.where(~F.col("open")).select("row.*")
    return done.unionByName(rows.where("open").select("part", "row").mapInArrow(add, _nullable(schema)))


def _carried(marks: list, keys: Sequence[str], values: Sequence[str], reduce: Reduce) -> dict[int, State]:
    """What each part's first key has been reduced to in the parts before it."""
    carried: dict[int, State] = {}
    key = state = None
    for m in sorted(marks, key=lambda m: (m["part"], m["mark"])):
        own = tuple(m["row"][k] for k in keys)
        if m["mark"] == FIRST:
            if state is not None and same_key(key, own):
                carried[m["part"]] = state
            continue
        end = tuple(m["row"][v] for v in values)
        goes_on = m["open"] and m["part"] in carried
        key, state = own, reduce(carried[m["part"]], end) if goes_on else end
    return carried


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _only(kind: pa.Schema, columns: Sequence[int], values: Sequence) -> pa.RecordBatch:
    """One row with nulls but in some columns."""
    given = dict(zip(columns, values))
    fields = [pa.array([given.get(c)], f.type) for c, f in enumerate(kind)]
    return pa.RecordBatch.from_arrays(fields, kind.names)


def _with_values(batch: pa.RecordBatch, columns: Sequence[int], states: Sequence[State]) -> pa.RecordBatch:
    arrays = list(batch.columns)
    for c, column in zip(columns, zip(*states)):
        arrays[c] = pa.array(column, arrays[c].type)
    return pa.RecordBatch.from_arrays(arrays, batch.schema.names)


def _marked(rows: pa.RecordBatch, mark: int, part: int, opened: list[bool]) -> pa.RecordBatch:
    n = rows.num_rows
    return pa.RecordBatch.from_arrays(
        [
            pa.array([mark] * n, pa.int32()),
            pa.array([part] * n, pa.int32()),
            pa.array(opened, pa.bool_()),
            rows.to_struct_array(),
        ],
        ["mark", "part", "open", "row"],
    )
