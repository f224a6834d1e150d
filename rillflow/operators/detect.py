"""Detection over keyed events (batch form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.time import day_of, interval
from rillflow.operators.skew import (
    DEFAULT,
    Limits,
    add_running,
    cut,
    following,
    previous,
    running_count,
    running_max,
    with_running,
)
from rillflow.operators.topn import first_rows

Span = str | int


def span(value: Span) -> Column:
    """A duration text for timestamps, or a plain number for epoch columns."""
    return interval(value) if isinstance(value, str) else F.lit(value)


def blacklist(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    limit: int = 100,
) -> DataFrame:
    """Daily click limit: tag ``main`` for rows within it, ``alert`` for the first above.

    Later rows of the day are dropped. ``clicks`` is the number of rows passed so
    far. At most ``limit + 1`` rows per group and task are shuffled into a group's
    task, so a flooded key stays small.
    """
    days = df.withColumn("day", day_of(ts, df.schema[ts].dataType))
    order = [F.col(c) for c in order_by]
    first = first_rows(days, [*keys, "day"], order, list(order_by), limit + 1, "_nth")
    return (
        first.withColumn("tag", F.when(F.col("_nth") <= limit, "main").otherwise("alert"))
        .withColumn("clicks", F.least("_nth", F.lit(limit)).cast("bigint"))
        .drop("_nth")
    )


def blacklist_pass(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    limit: int = 100,
) -> DataFrame:
    """The rows that go on to the next step, in their original form."""
    tagged = blacklist(df, keys, ts, order_by, limit)
    return tagged.where(F.col("tag") == "main").select(*df.columns)


def blacklist_alerts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    limit: int = 100,
) -> DataFrame:
    """One alert per key and day, at the first row over the limit."""
    tagged = blacklist(df, keys, ts, order_by, limit)
    return tagged.where(F.col("tag") == "alert").select(*keys, "day", ts, "clicks")


def repeated_failures(
    df: DataFrame,
    key: str,
    ts: str,
    failed: Column,
    within: Span = 2,
    order_by: Sequence[str] | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Two consecutive failures of a key at most ``within`` apart.

    Other events are left out first, so they do not break a sequence.
    """
    failures = df.where(failed)
    order_by = [ts] if order_by is None else order_by
    out = with_running(failures, [key], order_by, {"previous_ts": previous(ts)}, limits)
    before = F.col("previous_ts")
    return out.where(F.col(ts).between(before - span(within), before + span(within)))


def order_outcomes(
    events: DataFrame,
    order_by: Sequence[str],
    order: str = "order_id",
    event_type: str = "event_type",
    ts: str = "event_time",
    limit: Span = 900,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Match creates and pays of an order, in arrival order.

    An event pairs with the one just before it when that one is of the other type
    and not paired itself; a second event of the same type replaces the pending
    one. Every type but ``create`` counts as a pay. Outcomes: ``paid``, ``paid_late`` (paid more than ``limit`` after the
    create), ``pay_missing`` and ``create_missing``.
    """
    rows = events.withColumn("_create", F.col(event_type).eqNullSafe("create")).withColumn(
        "_at", F.col(ts)
    )
    rows = rows.select(order, "_create", "_at", *[c for c in order_by if c != order])
    parts = add_running(
        cut(rows, [order], order_by, limits),
        {
            "_before": previous(F.struct("_create", "_at")),
            "_after": following(F.struct("_create")),
            "_rn": running_count(),
        },
    )
    create = F.col("_create")
    differs = F.coalesce(F.col("_before._create") != create, F.lit(False))
    parts = parts.with_df(parts.df.withColumn("_fresh", F.when(~differs, F.col("_rn"))))
    # In a stretch of alternating types every second event pairs with its
    # predecessor; _since is where the stretch began.
    parts = add_running(parts, {"_since": running_max("_fresh")})
    pairs = (F.col("_rn") - F.col("_since")) % 2 == 1
    taken = ~pairs & F.coalesce(F.col("_after._create") != create, F.lit(False))

    at, before = F.col("_at"), F.col("_before._at")
    created = F.when(create, at).when(pairs, before)
    paid = F.when(~create, at).when(pairs, before)
    return (
        parts.result()
        .where(~taken)
        .select(
            order, pairs.alias("_pairs"), created.alias("created"), paid.alias("paid")
        )
        .select(
            order,
            F.when(~F.col("_pairs") & F.col("paid").isNull(), "pay_missing")
            .when(~F.col("_pairs"), "create_missing")
            .when(F.col("paid") > F.col("created") + span(limit), "paid_late")
            .otherwise("paid")
            .alias("outcome"),
            "created",
            "paid",
        )
    )
