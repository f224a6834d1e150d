"""Alert when a level keeps rising for a while (batch form).

An episode opens at the first rise of a key and has a deadline ``hold`` later. A
row that does not rise cancels it, up to and including the deadline. Otherwise
there is an alert, and the next rise after the deadline opens a new episode.

A row that does not rise ends all episodes before it, so the rows from one such
row to the next (a climb) are independent of all others, and climbs are what is
folded. Climbs longer than a segment are cut; what one segment hands to the next
is worked out from a short summary per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import duration_us, from_micros, micros
from rillflow.operators.checkpoints import materialize
from rillflow.operators.detect import Span
from rillflow.operators.skew import (
    DEFAULT,
    PART,
    Limits,
    Parts,
    add_running,
    cut,
    following,
    previous,
    running_count,
)

SEGMENT_ROWS = 65_536


def rising_alerts(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    hold: Span = 5_000,
    order_by: Sequence[str] | None = None,
    start: float = 0,
    limits: Limits = DEFAULT,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Alerts ``key, deadline, level``; the level is that of the last row in time.

    Rows without a value are left out.
    """
    kind = df.schema[ts].dataType
    length = duration_us(hold) if isinstance(hold, str) else hold
    rows = df.where(F.col(value).isNotNull()).select(
        F.col(key).alias("_key"),
        micros(ts, kind).alias("_ts"),
        F.col(value).alias("_value"),
        *[F.col(c).alias(f"_o_{c}") for c in (order_by or [])],
    )
    order = ["_ts", *[f"_o_{c}" for c in (order_by or []) if c != ts]]
    parts = add_running(
        cut(rows, ["_key"], order, limits),
        {
            "_last": previous("_value"),
            "_next": following(F.struct("_value")),
            "_rn": running_count(),
        },
    )
    fell = F.col("_value") <= F.coalesce(F.col("_last"), F.lit(start))
    parts = parts.with_df(parts.df.withColumn("_fell", fell))
    parts = add_running(
        parts,
        {
            "_climb": running_count(F.col("_fell"), inclusive=False),
            "_fell_before": previous("_fell"),
        },
    )
    group = ["_key", "_climb", "_segment"] + ([PART] if parts.split else [])
    segments = (
        _that_may_alert(parts, length)
        .withColumn("_segment", F.floor(F.col("_rn") / segment_rows))
        .groupBy(*group)
        .agg(
            F.sort_array(
                F.collect_list(F.struct("_ts", "_rn", "_fell", "_value"))
            ).alias("_rows"),
            F.max(F.coalesce("_fell_before", F.lit(True))).alias("_opens"),
            F.max(F.col("_fell") | F.col("_next").isNull()).alias("_closes"),
            F.min("_rn").alias("_from"),
        )
    )
    whole = F.col("_opens") & F.col("_closes")
    types = {f.name: f.dataType for f in rows.schema.fields}
    nothing = F.lit(None).cast("bigint")
    unknown = F.lit(None).cast(types["_value"])

    def named(alerts: DataFrame) -> DataFrame:
        deadline = from_micros("deadline", kind).alias("deadline")
        return alerts.select(F.col("_key").alias(key), deadline, "level")

    fits = not parts.split and (
        parts.total < segment_rows or _most_rows_per_key(rows) < segment_rows
    )
    if fits:
        return named(_alerts(segments, length, nothing, unknown))
    alerts = _alerts(segments.where(whole), length, nothing, unknown)
    cut_climbs = materialize(segments.where(~whole).drop(PART))
    if cut_climbs.isEmpty():
        return named(alerts)
    carried = _handed_over(cut_climbs, length, types["_key"], types["_value"])
    rejoined = cut_climbs.join(
        carried.withColumnRenamed("_key", "_c_key"),
        F.col("_key").eqNullSafe(F.col("_c_key")) & (F.col("_from") == F.col("_c_from")),
        "left",
    )
    later = _alerts(rejoined, length, F.col("_deadline"), F.col("_level"))
    return named(alerts.unionByName(later))


def _that_may_alert(parts: Parts, length: int) -> DataFrame:
    """Leave out climbs whose fall comes before their first deadline.

    They are most of the rows as a rule. Pieces that a cut has parted from their
    first or last row stay.
    """
    piece = Window.partitionBy(*parts.group, "_climb")
    opens = F.max(F.coalesce("_fell_before", F.lit(True))).over(piece)
    falls = F.max("_fell").over(piece)
    first_rise = F.min(F.when(~F.col("_fell"), F.col("_ts"))).over(piece)
    in_time = F.max("_ts").over(piece) <= first_rise + F.lit(length)
    cancelled = opens & falls & F.coalesce(in_time, F.lit(True))
    return parts.df.withColumn("_cancelled", cancelled).where("NOT _cancelled")


def _most_rows_per_key(rows: DataFrame) -> int:
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def _alerts(
    segments: DataFrame, length: int, deadline: Column, level: Column
) -> DataFrame:
    """The alerts of each segment, starting from the episode handed over, if any.

    One search per alert finds the row after its deadline, so the time goes with
    the number of rows and alerts.
    """
    rows = F.col("_rows")
    value = segments.schema["_rows"].dataType.elementType["_value"].dataType
    flat = segments.select(
        "_key",
        F.transform(rows, lambda r: r["_ts"]).alias("_times"),
        F.transform(rows, lambda r: r["_value"]).alias("_values"),
        F.element_at(rows, -1)["_fell"].alias("_falls"),
        F.col("_closes"),
        deadline.alias("_deadline"),
        level.alias("_level"),
    )

    def fold(batches):
        for batch in batches:
            which, deadlines, levels = [], [], []
            columns = ("_times", "_values", "_falls", "_closes", "_deadline", "_level")
            for k, row in enumerate(zip(*(batch[c] for c in columns))):
                for at, last in _episodes(*row, length):
                    which.append(k)
                    deadlines.append(at)
                    levels.append(last)
            yield pd.DataFrame(
                {
                    "_key": batch["_key"].iloc[which].to_numpy(),
                    "deadline": np.asarray(deadlines, dtype="int64"),
                    "level": levels,
                }
            )

    out = T.StructType(
        [
            T.StructField("_key", segments.schema["_key"].dataType),
            T.StructField("deadline", T.LongType()),
            T.StructField("level", value),
        ]
    )
    return flat.mapInPandas(fold, out)


def _episodes(times, values, falls, closes, deadline, level, length):
    """(deadline, level) of the alerts of one segment: rising rows, then maybe a fall."""
    times = np.asarray(times, dtype="int64")
    following_row = np.searchsorted(times, times + length, side="right")
    at = None if pd.isna(deadline) else int(deadline)
    end = len(times)
    if at is not None:
        row = int(np.searchsorted(times, at, side="right"))
    elif falls and end == 1:
        return
    else:
        at, row = int(times[0]) + length, int(following_row[0])
    while row < end:
        yield at, values[row - 1] if row else level
        if falls and row == end - 1:
            return
        at, row = int(times[row]) + length, int(following_row[row])
    if closes and not falls:
        yield at, values[end - 1]


def _handed_over(
    segments: DataFrame, length: int, key_type: T.DataType, value_type: T.DataType
) -> DataFrame:
    """The open episode each segment of a cut climb receives from the one before.

    What a segment hands on depends only on the first rise after the deadline it
    receives, so it is summed up as (rise, deadline handed on) pairs for the rises
    it can start from: those within ``length`` of its first row, and the next one.
    The summaries of a climb are walked through in order, one batch at a time.
    """
    rises = F.filter("_rows", lambda r: ~r["_fell"])
    bare = segments.select(
        "_key",
        "_climb",
        "_from",
        F.transform(rises, lambda r: r["_ts"]).alias("_rises"),
        F.element_at("_rows", -1)["_value"].alias("_level"),
    )

    def summarize(batches):
        for batch in batches:
            starts, ends = [], []
            for rises in batch["_rises"]:
                t = np.asarray(rises, dtype="int64")
                n = len(t)
                following_rise = np.searchsorted(t, t + length, side="right")
                # The last rise of the chain that starts at each, by doubling jumps.
                jump, last = np.append(following_rise, n), np.arange(n)
                while (more := np.flatnonzero(jump[:n] < n)).size:
                    last[more] = last[jump[more]]
                    jump[more] = jump[jump[more]]
                reach = int(following_rise[0]) + 1 if n else 0
                starts.append(t[:reach])
                ends.append((t[last] + length)[:reach])
            yield batch.drop(columns="_rises").assign(_starts=starts, _ends=ends)

    base = [
        T.StructField("_key", key_type),
        T.StructField("_climb", T.LongType()),
        T.StructField("_from", T.LongType()),
        T.StructField("_level", value_type),
    ]
    longs = T.ArrayType(T.LongType())
    summaries = bare.mapInPandas(
        summarize,
        T.StructType(
            [*base, T.StructField("_starts", longs), T.StructField("_ends", longs)]
        ),
    )

    def chain(batches):
        climb, deadline, level = None, None, None
        for batch in batches:
            out = []
            for key, number, start, here, starts, ends in zip(
                *(batch[c] for c in ("_key", "_climb", "_from", "_level", "_starts", "_ends"))
            ):
                own = (None if pd.isna(key) else key, number)
                if own != climb:
                    climb, deadline, level = own, None, None
                first = 0
                if deadline is not None:
                    out.append((key, start, deadline, level))
                    first = int(np.searchsorted(starts, deadline, side="right"))
                if first < len(starts):
                    deadline = int(ends[first])
                level = here
            yield pd.DataFrame(out, columns=["_key", "_c_from", "_deadline", "_level"])

    ordered = summaries.repartition("_key", "_climb")
    ordered = ordered.sortWithinPartitions("_key", "_climb", "_from")
    return ordered.mapInPandas(
        chain,
        T.StructType(
            [
                T.StructField("_key", key_type),
                T.StructField("_c_from", T.LongType()),
                T.StructField("_deadline", T.LongType()),
                T.StructField("_level", value_type),
            ]
        ),
    )
