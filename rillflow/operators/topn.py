"""The N largest groups of each window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Up to this many rows per group, Spark drops the others in each task before the
#: shuffle (the default of ``spark.sql.optimizer.windowGroupLimitThreshold``).
_SPARK_LIMIT = 1_000
_SHARES = 64


def first_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    spread_by: Sequence[str],
    n: int,
    place: str,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered by ``place``.

    For a large ``n``, which Spark's own limit does not cover, the first ``n`` of each
    of ``_SHARES`` parts of a group are found first, and only they meet in one task.
    """
    if n > _SPARK_LIMIT:
        share = F.pmod(F.xxhash64(*spread_by), F.lit(_SHARES))
        part = Window.partitionBy(*group, "_share").orderBy(*order)
        df = df.withColumn("_share", share).withColumn(place, F.row_number().over(part))
        df = df.where(F.col(place) <= n).drop(place, "_share")
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(place, F.row_number().over(whole)).where(F.col(place) <= n)


def top_n(
    counts: DataFrame,
    n: int,
    measure: str,
    ties: Sequence[str],
    window: str = "window_end",
    rank: str = "rk",
) -> DataFrame:
    """Rows with the ``n`` largest measures of each window; ties go by ``ties``, rising.

    At most ``n`` rows per window and task are shuffled into a window's task.
    """
    best_first = [F.col(measure).desc(), *[F.col(t) for t in ties]]
    ranked = first_rows(counts, [window], best_first, list(ties) or [measure], n, rank)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


def report(top: DataFrame, *columns: str, window: str = "window_end") -> DataFrame:
    """One text block per window from the rows of :func:`top_n`."""
    line = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in columns])
    lines = F.array_sort(F.collect_list(F.struct("rk", line.alias("line"))))
    rule = F.lit("-" * 50)
    return top.groupBy(window).agg(
        F.concat_ws(
            "\n",
            F.concat(F.lit("window end: "), _text(F.col(window))),
            rule,
            F.concat_ws("\n", lines["line"]),
            rule,
        ).alias("report")
    )


def _text(c: Column) -> Column:
    return c.cast("string")
