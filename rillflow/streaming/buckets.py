"""Many keys in one group of ``transformWithStateInPandas``.

A call from Python to the state of a key takes about as long as handling a hundred rows, and a processor makes several per
key. Here keys are dealt into ``BUCKETS`` groups. The state of a group is held in a few values, so a micro-batch makes a few
calls per group however many keys it has; what a group holds is read and written whole. Groups without new rows and without
anything due are not touched.

pandas turns whole numbers with nulls into floats and times into nanoseconds, so columns cross as :class:`Plain` ones. The
event time crosses as it is as well, since late rows are dropped by it: it must lie before 2262.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillflow.streaming.run import use_rocksdb

#: Groups of keys. A stream must go on with the number it began with.
BUCKETS = 1024

_FLOATS = (T.FloatType, T.DoubleType)
_FILLED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.TimestampType, *_FLOATS)
_BITS = 60  # of a mask


class Plain:
    """Columns in a form that pandas keeps: no nulls among numbers, times as epoch microseconds.

    They are named ``c0``, ``c1`` and so on; bits of ``n0``, ``n1`` and so on tell which of them were null.
    """

    def __init__(self, fields: Sequence[T.StructField]):
        self.fields = list(fields)
        self.filled = [i for i, f in enumerate(self.fields) if isinstance(f.dataType, _FILLED)]
        self.bits = {i: (f"n{j // _BITS}", 1 << j % _BITS) for j, i in enumerate(self.filled)}
        self.masks = sorted({name for name, _ in self.bits.values()}, key=lambda n: int(n[1:]))
        self.names = [f"c{i}" for i in range(len(self.fields))] + self.masks

    def name(self, column: str) -> str:
        return f"c{[f.name for f in self.fields].index(column)}"

    def _type(self, field: T.StructField) -> T.DataType:
        if isinstance(field.dataType, T.TimestampType):
            return T.LongType()
        return T.StringType() if isinstance(field.dataType, T.TimestampNTZType) else field.dataType

    def schema(self) -> list[T.StructField]:
        values = [T.StructField(f"c{i}", self._type(f)) for i, f in enumerate(self.fields)]
        return values + [T.StructField(name, T.LongType()) for name in self.masks]

    def columns(self) -> list[Column]:
        out, nulls = [], {name: F.lit(0).cast("bigint") for name in self.masks}
        for i, f in enumerate(self.fields):
            value = F.col(f"`{f.name}`")
            if i in self.bits:
                name, bit = self.bits[i]
                nulls[name] += F.when(value.isNull(), bit).otherwise(0)
                if isinstance(f.dataType, T.TimestampType):
                    value = F.unix_micros(value)
                value = F.coalesce(value, F.lit(0).cast(self._type(f)))
            elif isinstance(f.dataType, T.TimestampNTZType):
                value = value.cast("string")
            out.append(value.alias(f"c{i}"))
        return out + [column.alias(name) for name, column in nulls.items()]

    def restored(self) -> dict[str, Column]:
        """The columns under their names, as they were."""
        out = {}
        for i, f in enumerate(self.fields):
            value = F.col(f"c{i}")
            if isinstance(f.dataType, T.TimestampType):
                value = F.timestamp_micros(value)
            elif isinstance(f.dataType, T.TimestampNTZType):
                value = value.cast(f.dataType)
            elif isinstance(f.dataType, _FLOATS):  # pandas has one sign for null and for what is not a number
                value = F.coalesce(value, F.lit(float("nan")).cast(f.dataType))
            if i in self.bits:
                name, bit = self.bits[i]
                value = F.when(F.col(name).bitwiseAND(F.lit(bit)) == 0, value)
            out[f.name] = value.alias(f.name)
        return out

    def keys(self, rows: pd.DataFrame, columns: Sequence[str]) -> list[tuple]:
        """A tuple for each row that is the same for the same values, nulls included, of some of the columns."""
        places = [[f.name for f in self.fields].index(c) for c in columns]
        parts = []
        for i in places:
            values = rows[f"c{i}"].tolist()
            if isinstance(self.fields[i].dataType, _FLOATS):
                values = [None if v != v else v for v in values]
            parts.append(values)
        for name in self.masks:
            bits = sum(self.bits[i][1] for i in places if i in self.bits and self.bits[i][0] == name)
            if bits:
                parts.append((rows[name] & bits).tolist())
        return list(zip(*parts)) if parts else [()] * len(rows)


def bucket(fields: Sequence[T.StructField], *more: Column) -> Column:
    """The group of the rows with the same values of some columns."""
    values = [
        F.col(f"`{f.name}`") + F.lit(0.0) if isinstance(f.dataType, _FLOATS) else F.col(f"`{f.name}`")  # one zero
        for f in fields
    ]
    return F.pmod(F.xxhash64(*values, *more), F.lit(BUCKETS)).cast("int").alias("bucket")


def event_micros(ts: str) -> Column:
    """The event time in epoch microseconds; a row without one is an error."""
    return F.coalesce(F.unix_micros(ts), F.raise_error(F.lit(f"{ts} must not be null")))


def run_buckets(
    df: DataFrame, processor: StatefulProcessor, schema: Sequence[T.StructField], event_time: str = ""
) -> DataFrame:
    """``df`` has its event time, ``bucket`` and what the processor reads."""
    use_rocksdb(df.sparkSession)
    return df.groupBy("bucket").transformWithStateInPandas(
        processor, T.StructType(list(schema)), "append", "EventTime", eventTimeColumnName=event_time
    )


def packed(state: object) -> tuple[bytes]:
    """Row of a state with the one column ``data binary``."""
    return (pickle.dumps(state, protocol=5),)


def unpacked(row: tuple) -> object:
    return pickle.loads(row[0])


def timer_ms(micros: int) -> int:
    """The first whole millisecond that is not before a time."""
    return -(-micros // 1000)


class Processor(StatefulProcessor):
    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter([])

    def close(self) -> None:
        pass


class Alarmed(Processor):
    """Has one timer at most. ``set_up`` names further state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alarm = handle.getValueState("alarm", "ms bigint")
        self.set_up(handle)

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def _call_at(self, due_us: int | None) -> None:
        due = None if due_us is None else timer_ms(due_us)
        before = self.alarm.get()[0] if self.alarm.exists() else None
        if due == before:
            return
        if before is not None:
            self.handle.deleteTimer(before)
            self.alarm.clear()
        if due is not None:
            self.handle.registerTimer(due)
            self.alarm.update((due,))

    def _call_by(self, due_us: int) -> None:
        """Call not later than ``due_us``."""
        if not self.alarm.exists() or timer_ms(due_us) < self.alarm.get()[0]:
            self._call_at(due_us)

    def _spent(self, expiredTimerInfo) -> None:
        """The timer that calls is not set any more."""
        if self.alarm.exists() and self.alarm.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.alarm.clear()
