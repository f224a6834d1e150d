"""Joins of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.time import duration_us
from rillflow.streaming.windows import with_event_time


def order_pairs(
    creates: DataFrame,
    pays: DataFrame,
    key: str,
    ts: str,
    limit: str,
    keep: str,
    delay: str = "0 seconds",
) -> DataFrame:
    """(key, outcome, created, paid): each create with the pay of its key, or alone, from two streams.

    A full outer join within a time bound: a partner may be up to ``keep`` earlier or later. ``outcome`` is ``paid``, or
    ``paid_late`` where the pay is more than ``limit`` after the create; ``pay_missing`` and ``create_missing`` come once
    the watermarks of both streams are so far that no partner can come, and their rows leave the state then. Rows of a
    key are joined with all of its partners in the bound; rows without a key are alone.
    """
    bound = F.expr(f"INTERVAL {duration_us(keep)} MICROSECONDS")  # a literal, from which Spark learns when rows leave the state
    c = with_event_time(creates.select(F.col(key).alias("c_key"), F.col(ts).alias("created")), "created", delay)
    p = with_event_time(pays.select(F.col(key).alias("p_key"), F.col(ts).alias("paid")), "paid", delay)
    near = (F.col("paid") >= F.col("created") - bound) & (F.col("paid") <= F.col("created") + bound)
    known = F.col("c_key").isNotNull()  # the join of two streams would pair null keys
    both = c.join(p, (F.col("c_key") == F.col("p_key")) & known & near, "full_outer")
    late = F.unix_micros("paid") - F.unix_micros("created") > duration_us(limit)
    outcome = (
        F.when(F.col("paid").isNull(), "pay_missing")
        .when(F.col("created").isNull(), "create_missing")
        .when(late, "paid_late")
        .otherwise("paid")
    )
    return both.select(F.coalesce("c_key", "p_key").alias(key), outcome.alias("outcome"), "created", "paid")
