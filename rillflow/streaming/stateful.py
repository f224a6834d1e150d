"""Streaming operators with keyed state and event-time timers.

Detection needs the rows of a key in event order, also across micro-batches:
these processors hold rows back until the watermark has passed them and only then
take them in order (:class:`_InOrder`). Times are epoch microseconds inside the
processors. Rows of a key are handled by one task, and a micro-batch bounds how
many there are at once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillflow.functions.time import duration_us
from rillflow.streaming.buckets import (
    Alarmed,
    Plain,
    Processor,
    bucket,
    event_micros,
    packed,
    run_buckets,
    timer_ms,
    unpacked,
)
from rillflow.streaming.run import use_rocksdb
from rillflow.streaming.windows import with_event_time

DAY_US = 86_400_000_000
#: So many rows of a bucket are looked through at a time.
_MANY_ROWS = 100_000


def _by(rows: Iterator[Row], columns: Sequence[str]) -> list[Row]:
    return sorted(rows, key=lambda r: tuple(r[c] for c in columns))


def _schema(df: DataFrame, *extra: T.StructField, without: Sequence[str] = ()):
    kept = [
        T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in without
    ]
    return T.StructType([*kept, *extra])


def _run(
    df: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    schema: T.StructType,
    time_mode: str,
    event_time: str = "",
) -> DataFrame:
    """``event_time`` names the output column that later windows go by."""
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithState(
        processor, schema, "append", time_mode, eventTimeColumnName=event_time
    )


def keyed_process(
    stream: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    schema: T.StructType,
    ts: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Run an own stateful processor per key, with event-time timers where ``ts`` is given.

    Its input then has ``_us`` as well, the event time in epoch microseconds.
    """
    timed = stream if ts is None else _timed(stream, ts, delay)
    return _run(timed, keys, processor, schema, "None" if ts is None else "EventTime")


class _InOrder(Alarmed):
    """Takes the rows of a key in event order, whatever order they arrive in.

    Rows wait in state until no earlier one can come. Subclasses name the columns
    they need and get them in ``take``; ``settle`` is called with the time all
    rows up to which are taken, and returns when it wants to be called again.
    """

    #: Columns to keep of each row besides its time.
    columns: Sequence[str] = ()
    types: Sequence[T.DataType] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField("_us", T.LongType())]
        fields += [T.StructField(c, t) for c, t in zip(self.columns, self.types)]
        self.waiting = handle.getListState("waiting", T.StructType(fields))
        super().init(handle)

    def take(self, key, at: int, *values) -> Iterator[Row]:
        raise NotImplementedError

    def settle(self, key, until: int) -> tuple[list[Row], int | None]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["_us"], *[r[c] for c in self.columns]) for r in rows]
        self.waiting.appendList(new)
        self._call_by(min(r[0] for r in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._spent(expiredTimerInfo)
        until = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.waiting.get(), key=lambda r: r[0]) if self.waiting.exists() else []
        ready = [r for r in rows if r[0] <= until]
        for row in ready:
            yield from self.take(key, *row)
        found, due = self.settle(key, until)
        yield from found
        later = rows[len(ready) :]
        if ready:
            if later:
                self.waiting.put([tuple(r) for r in later])
            else:
                self.waiting.clear()
        if later:
            due = later[0][0] if due is None else min(due, later[0][0])
        self._call_at(due)


# --- one output row per input row -------------------------------------------------


class _Reduce(Processor):
    def __init__(self, schema, order_by, reduce):
        self.schema, self.order_by, self.reduce = schema, order_by, reduce

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = None
        if self.current.exists():
            current = Row(*self.schema.names)(*self.current.get())
        for row in _by(rows, self.order_by):
            current = row if current is None else self.reduce(current, row)
            yield Row(*self.schema.names)(*[current[c] for c in self.schema.names])
        self.current.update(tuple(current[c] for c in self.schema.names))


def rolling_reduce(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    reduce: Callable[[Row, Row], Row],
) -> DataFrame:
    """Emit the running reduction of a key for each of its rows.

    ``reduce(current, row)`` returns a row with the input's columns; the first row
    of a key is emitted as it is. See ``keep_sum`` and ``keep_max``.
    """
    schema = _schema(stream)
    return _run(stream, keys, _Reduce(schema, list(order_by), reduce), schema, "None")


def keep_sum(column: str) -> Callable[[Row, Row], Row]:
    """Add up a column; the others stay as in the key's first row."""

    def reduce(current: Row, row: Row) -> Row:
        return Row(**{**current.asDict(), column: current[column] + row[column]})

    return reduce


def keep_max(column: str) -> Callable[[Row, Row], Row]:
    """The largest value of a column; the others stay as in the key's first row."""

    def reduce(current: Row, row: Row) -> Row:
        return Row(**{**current.asDict(), column: max(current[column], row[column])})

    return reduce


class _Watermark(Processor):
    def __init__(self, names, order_by):
        self.names, self.order_by = names, order_by

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        for row in _by(rows, self.order_by):
            yield Row(*self.names, "watermark_ms")(*[row[c] for c in self.names], now)


def with_watermark_time(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "0 seconds"
) -> DataFrame:
    """Add the watermark, in epoch milliseconds, that held when a row was handled."""
    timed = _timed(stream, ts, delay)
    schema = _schema(timed, T.StructField("watermark_ms", T.LongType()), without=["_us"])
    processor = _Watermark(stream.columns, ["_us"])
    return _run(timed, keys, processor, schema, "EventTime")


# --- count windows ------------------------------------------------------------------


class _CountWindow(Processor):
    def __init__(self, keys, order_by, value, value_type, size, slide):
        self.keys, self.order_by, self.value = keys, order_by, value
        self.value_type, self.size, self.slide = value_type, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n bigint")
        self.last = handle.getListState(
            "last", T.StructType([T.StructField("v", self.value_type)])
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        last = [v[0] for v in self.last.get()] if self.last.exists() else []
        for row in _by(rows, self.order_by):
            seen += 1
            last = [*last, row[self.value]][-self.size :]
            if seen % self.slide == 0:
                yield Row(*self.keys, "seen", self.value)(*key, seen, sum(last))
        self.seen.update((seen,))
        self.last.put([(v,) for v in last])


def count_window(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    size: int,
    slide: int | None = None,
) -> DataFrame:
    """Sum of the last ``size`` values of a key after every ``slide`` rows."""
    types = {f.name: f.dataType for f in stream.schema.fields}
    schema = T.StructType(
        [T.StructField(k, types[k]) for k in keys]
        + [T.StructField("seen", T.LongType()), T.StructField(value, types[value])]
    )
    processor = _CountWindow(
        list(keys), list(order_by), value, types[value], size, slide or size
    )
    return _run(stream, keys, processor, schema, "None")


# --- timers -------------------------------------------------------------------------


class _FirstTimer(Processor):
    def __init__(self, keys, hold_us):
        self.keys, self.hold_us = keys, hold_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "t bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        due = min(r["_us"] for r in rows) + self.hold_us
        if self.due.exists():
            before, fired = self.due.get()
            if fired or before <= due:
                return iter([])
            self.handle.deleteTimer(timer_ms(before))
        self.due.update((due, False))
        self.handle.registerTimer(timer_ms(due))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due, fired = self.due.get()
        if not fired:
            self.due.update((due, True))
            yield Row(*self.keys, "_us")(*key, due)


def _timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    return with_event_time(stream, ts, delay).withColumn("_us", F.unix_micros(ts))


def _instant(us: str) -> Column:
    return F.timestamp_micros(us)


def first_timer(
    stream: DataFrame, keys: Sequence[str], ts: str, hold: str, delay: str = "0 seconds"
) -> DataFrame:
    """One row per key when event time is ``hold`` past the key's first row."""
    timed = _timed(stream, ts, delay)
    types = {f.name: f.dataType for f in timed.schema.fields}
    schema = T.StructType(
        [T.StructField(k, types[k]) for k in keys] + [T.StructField("_us", T.LongType())]
    )
    out = _run(timed, keys, _FirstTimer(list(keys), duration_us(hold)), schema, "EventTime")
    return out.select(*keys, _instant("_us").alias("fires_at"))


class _LateWindows(Alarmed):
    """Counts of the windows of a bucket, and which of them have fired."""

    def __init__(self, plain, keys, lateness_us):
        self.plain, self.keys, self.lateness_us = plain, keys, lateness_us

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getValueState("windows", "data binary")

    def _held(self) -> dict:
        return unpacked(self.windows.get()) if self.windows.exists() else {}

    def _frame(self, found: list[tuple]) -> pd.DataFrame:
        rows = [(*key, end, n) for key, end, n in found]
        return pd.DataFrame(rows, columns=[*self.plain.names, "end", "cnt"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now_us = timerValues.getCurrentWatermarkInMs() * 1000 + self.lateness_us
        windows = self._held()
        for frame in rows:
            new = Counter(zip(self.plain.keys(frame, self.keys), frame["end"].tolist()))
            late = []
            for (k, end), n in new.items():
                before, fired = windows.get((k, end), (0, False))
                windows[k, end] = (before + n, fired)
                if end <= now_us:
                    late += [(k, end, before + i) for i in range(1, n + 1)]
            if late:
                yield self._frame(late)
        self.windows.update(packed(windows))
        self._call_at(self._next(windows))

    def _next(self, windows: dict) -> int | None:
        return min((end if fired else end - self.lateness_us for (_, end), (_, fired) in windows.items()), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._spent(expiredTimerInfo)
        until = timerValues.getCurrentWatermarkInMs() * 1000
        windows = self._held()
        ended = [w for w, (_, fired) in windows.items() if not fired and w[1] - self.lateness_us <= until]
        if ended:
            yield self._frame([(k, end, windows[k, end][0]) for k, end in ended])
        windows.update({w: (windows[w][0], True) for w in ended})
        windows = {w: n for w, n in windows.items() if w[1] > until}
        if windows:
            self.windows.update(packed(windows))
        else:
            self.windows.clear()
        self._call_at(self._next(windows))


def late_windows(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    delay: str,
    lateness: str,
) -> DataFrame:
    """Tumbling counts that fire at the window's end and again for each late row.

    A window ends when event time less ``delay`` reaches its end, and takes late
    rows for ``lateness`` more. The watermark Spark keeps lags by both, and the
    first firing is set ``lateness`` ahead of it.
    """
    lateness_us = duration_us(lateness)
    total = duration_us(delay) + lateness_us
    timed = with_event_time(stream, ts, f"{total} microseconds")
    plain = Plain([timed.schema[k] for k in keys])
    size_us = duration_us(size)
    us = event_micros(ts)
    end = us - F.pmod(us, F.lit(size_us)) + size_us
    rows = timed.select(bucket(plain.fields, end), *plain.columns(), end.alias("end"), F.col(ts).alias("at"))
    schema = [*plain.schema(), T.StructField("end", T.LongType()), T.StructField("cnt", T.LongType())]
    out = run_buckets(rows, _LateWindows(plain, list(keys), lateness_us), schema)
    return out.select(*plain.restored().values(), _instant("end").alias("window_end"), "cnt")


# --- detection ------------------------------------------------------------------------


class _DailyLimit(Alarmed):
    """Counts of the keys of a bucket by day."""

    def __init__(self, plain, keys, order_by, limit):
        self.plain, self.keys, self.order_by, self.limit = plain, keys, order_by, limit
        self.many = _MANY_ROWS

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getValueState("days", "data binary")

    def _cut(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        """The rows in order, without those that come after ``limit + 1`` others of their key and day."""
        rows = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        rows = rows.sort_values(self.order_by, kind="stable", ignore_index=True)
        if len(rows) <= self.many:
            return rows
        by = pd.Series(zip(self.plain.keys(rows, self.keys), rows["us"] // DAY_US))
        return rows[by.groupby(by).cumcount() <= self.limit]

    def _rows(self, frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
        held, n, most = [], 0, self.many
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n > most:
                held = [self._cut(held)]
                n = len(held[0])
                most = max(self.many, 2 * n)
        return self._cut(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = self._rows(rows)
        days = unpacked(self.days.get()) if self.days.exists() else {}
        places, clicks = [], []
        at = (rows["us"] // DAY_US).tolist()
        for place, (k, day) in enumerate(zip(self.plain.keys(rows, self.keys), at)):
            seen = days.setdefault(day, {})
            n = seen.get(k, 0)
            if n > self.limit:
                continue
            seen[k] = n + 1
            places.append(place)
            clicks.append(n + 1)
        self.days.update(packed(days))
        self._call_by((min(days) + 1) * DAY_US)
        out = rows[[*self.plain.names, "us"]].iloc[places].reset_index(drop=True)
        out["at"] = out.pop("us").astype("datetime64[us]").dt.tz_localize("UTC")
        clicks = pd.Series(clicks, dtype="int64")
        out["tag"] = (clicks <= self.limit).map({True: "main", False: "alert"}).astype(object)
        out["clicks"] = clicks.clip(upper=self.limit)
        for k in range(0, len(out), self.many):
            yield out[k : k + self.many]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._spent(expiredTimerInfo)
        over = timerValues.getCurrentWatermarkInMs() * 1000
        days = unpacked(self.days.get()) if self.days.exists() else {}
        days = {day: seen for day, seen in days.items() if (day + 1) * DAY_US > over}
        if days:
            self.days.update(packed(days))
            self._call_at((min(days) + 1) * DAY_US)
        else:
            self.days.clear()
        return iter([])


def daily_limit(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    limit: int = 100,
    delay: str = "0 seconds",
) -> DataFrame:
    """Pass the first ``limit`` rows of a key and UTC day, alert once, drop the rest.

    A day's counter is dropped once the watermark is past the day. Windows can
    follow on the same event time. ``order_by`` may name ``_us`` for the event time.
    """
    timed = with_event_time(stream, ts, delay)
    plain = Plain([f for f in timed.schema.fields if f.name != ts or ts in keys])
    places = ["us" if c in (ts, "_us") else plain.name(c) for c in order_by]
    rows = timed.select(
        bucket([timed.schema[k] for k in keys]),
        *plain.columns(),
        event_micros(ts).alias("us"),
        F.col(ts).alias("at"),
    )
    schema = [
        *plain.schema(),
        T.StructField("at", T.TimestampType()),
        T.StructField("tag", T.StringType()),
        T.StructField("clicks", T.LongType()),
    ]
    out = run_buckets(rows, _DailyLimit(plain, list(keys), places, limit), schema, "at")
    columns = {**plain.restored(), ts: F.col("at").alias(ts)}
    return out.select(*[columns[c] for c in stream.columns], "tag", "clicks")


class _RepeatedFailures(_InOrder):
    def __init__(self, key, within_us):
        self.key, self.within_us = key, within_us

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t bigint")

    def take(self, key, at) -> Iterator[Row]:
        if self.last.exists():
            last = self.last.get()[0]
            if at - last <= self.within_us:
                yield Row(self.key, "_before", "_at")(key[0], last, at)
        self.last.update((at,))

    def settle(self, key, until) -> tuple[list[Row], int | None]:
        """A failure that nothing can follow in time any more is forgotten."""
        if not self.last.exists():
            return [], None
        over = self.last.get()[0] + self.within_us + 1
        if over > until:
            return [], over
        self.last.clear()
        return [], None


def repeated_failures(
    stream: DataFrame, key: str, ts: str, failed: Column, within: str, delay: str
) -> DataFrame:
    """Two consecutive failures of a key at most ``within`` apart."""
    timed = _timed(stream.where(failed), ts, delay)
    kind = next(f.dataType for f in timed.schema.fields if f.name == key)
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("_before", T.LongType()),
            T.StructField("_at", T.LongType()),
        ]
    )
    processor = _RepeatedFailures(key, duration_us(within))
    out = _run(timed, [key], processor, schema, "EventTime")
    return out.select(
        key, _instant("_before").alias("previous_ts"), _instant("_at").alias(ts)
    )


class _Orders(Alarmed):
    """The rows of the orders of a bucket that wait for the watermark, and the last one of each order that waits for its partner."""

    def __init__(self, plain, order, limit_us, keep_us):
        self.plain, self.order, self.limit_us, self.keep_us = plain, order, limit_us, keep_us

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "data binary")
        self.pending = handle.getValueState("pending", "data binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            us = frame["us"].tolist()
            keys = self.plain.keys(frame, [self.order])
            self.waiting.appendValue(packed((us, frame["creates"].tolist(), keys)))
            first = min(us) if first is None else min(first, *us)
        self._call_by(first)
        return iter([])

    def _alone(self, key, is_create, at) -> tuple:
        if is_create:
            return (*key, "pay_missing", at, None)
        return (*key, "create_missing", None, at)

    def _settle(self, pending: dict, found: list[tuple], key, until: int) -> int | None:
        """Reports what waits for more than the limit, drops what waits for longer; gives when it wants to be called again."""
        is_create, at, reported = pending[key]
        over = at + self.limit_us + 1
        if not reported:
            if until < over:
                return over
            found.append(self._alone(key, is_create, at))
            pending[key] = (is_create, at, True)
        over += self.keep_us
        if until < over:
            return over
        del pending[key]
        return None

    def _take(self, pending: dict, found: list[tuple], key, at: int, is_create: bool) -> None:
        if key in pending:
            self._settle(pending, found, key, at)
        if key in pending:
            waiting, since, reported = pending.pop(key)
            if waiting != is_create:
                created, paid = (at, since) if is_create else (since, at)
                late = paid - created > self.limit_us
                found.append((*key, "paid_late" if late else "paid", created, paid))
                return
            if not reported:
                found.append(self._alone(key, waiting, since))
        pending[key] = (is_create, at, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._spent(expiredTimerInfo)
        until = timerValues.getCurrentWatermarkInMs() * 1000
        pending = unpacked(self.pending.get()) if self.pending.exists() else {}
        held = self.waiting.get() if self.waiting.exists() else []
        rows = sorted((row for part in held for row in zip(*unpacked(part))), key=lambda r: r[0])
        ready = bisect_right(rows, until, key=lambda r: r[0])
        found: list[tuple] = []
        for at, is_create, k in rows[:ready]:
            self._take(pending, found, k, at, is_create)
        calls = [self._settle(pending, found, k, until) for k in list(pending)]
        later = rows[ready:]
        if ready and later:
            self.waiting.put([packed(tuple(zip(*later)))])
        elif ready:
            self.waiting.clear()
        if pending:
            self.pending.update(packed(pending))
        else:
            self.pending.clear()
        calls = [due for due in calls if due is not None] + [row[0] for row in later[:1]]
        self._call_at(min(calls, default=None))
        for k in range(0, len(found), _MANY_ROWS):
            yield self._frame(found[k : k + _MANY_ROWS])

    def _frame(self, found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=[*self.plain.names, "outcome", "created", "paid"], dtype=object)
        return out.astype({"created": "Int64", "paid": "Int64"})


def order_outcomes(
    stream: DataFrame,
    ts: str,
    limit: str,
    keep: str,
    order: str = "order_id",
    event_type: str = "event_type",
    delay: str = "0 seconds",
) -> DataFrame:
    """Match creates and pays of an order in event order.

    A missing partner is reported when event time is more than ``limit`` past the
    row. The row is kept for ``keep`` more, so a partner that comes by then still
    gives ``paid`` or ``paid_late``; the batch form gives only that second row.
    """
    timed = with_event_time(stream, ts, delay)
    plain = Plain([timed.schema[order]])
    rows = timed.select(
        bucket(plain.fields),
        *plain.columns(),
        event_micros(ts).alias("us"),
        F.col(event_type).eqNullSafe("create").alias("creates"),
        F.col(ts).alias("at"),
    )
    schema = [
        *plain.schema(),
        T.StructField("outcome", T.StringType()),
        T.StructField("created", T.LongType()),
        T.StructField("paid", T.LongType()),
    ]
    out = run_buckets(rows, _Orders(plain, order, duration_us(limit), duration_us(keep)), schema)
    return out.select(
        plain.restored()[order],
        "outcome",
        _instant("created").alias("created"),
        _instant("paid").alias("paid"),
    )


class _Rising(_InOrder):
    def __init__(self, key, value, value_type, hold_us, start):
        self.key, self.columns, self.types = key, [value], [value_type]
        self.hold_us, self.start = hold_us, start

    def set_up(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(
            "last", T.StructType([T.StructField("v", self.types[0])])
        )
        self.due = handle.getValueState("due", "t bigint")

    def _alert(self, key, due, level) -> Row:
        return Row(self.key, "_deadline", "level")(key[0], due, level)

    def take(self, key, at, level) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else self.start
        due = self.due.get()[0] if self.due.exists() else None
        if due is not None and at > due:
            yield self._alert(key, due, last)
            due = None
        if level <= last:
            due = None
        elif due is None:
            due = at + self.hold_us
        self.last.update((level,))
        if due is None:
            self.due.clear()
        else:
            self.due.update((due,))

    def settle(self, key, until) -> tuple[list[Row], int | None]:
        if not self.due.exists():
            return [], None
        due = self.due.get()[0]
        if until <= due:  # a row at the deadline may still come
            return [], due + 1
        self.due.clear()
        return [self._alert(key, due, self.last.get()[0])], None


def rising_alerts(
    stream: DataFrame,
    key: str,
    ts: str,
    value: str,
    hold: str = "5 seconds",
    start: float = 0,
    delay: str = "0 seconds",
) -> DataFrame:
    """Alert when a level has risen without a fall for ``hold`` after a rise."""
    timed = _timed(stream.where(F.col(value).isNotNull()), ts, delay)
    types = {f.name: f.dataType for f in timed.schema.fields}
    schema = T.StructType(
        [
            T.StructField(key, types[key]),
            T.StructField("_deadline", T.LongType()),
            T.StructField("level", types[value]),
        ]
    )
    processor = _Rising(key, value, types[value], duration_us(hold), start)
    out = _run(timed, [key], processor, schema, "EventTime")
    return out.select(key, _instant("_deadline").alias("deadline"), "level")
