"""Ready-made jobs over parsed logs (batch form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.time import event_time
from rillflow.operators.detect import (
    Span,
    blacklist_alerts,
    blacklist_pass,
    order_outcomes,
    repeated_failures,
)
from rillflow.operators.rising import rising_alerts
from rillflow.operators.rolling import rolling_count
from rillflow.operators.skew import DEFAULT, Limits
from rillflow.operators.topn import top_n
from rillflow.operators.transforms import label, level_cases, side_output, words
from rillflow.operators.windows import distinct_estimate, sliding


def word_count(lines: DataFrame) -> DataFrame:
    return words(lines).groupBy("word").agg(F.sum("one").alias("cnt"))


def _behavior(df: DataFrame, behavior: str | None) -> DataFrame:
    return df if behavior is None else df.where(F.col("behavior") == behavior)


def page_views(df: DataFrame, behavior: str | None = "pv") -> DataFrame:
    """Number of rows with a behavior, or of all rows for ``None``."""
    return _behavior(df, behavior).agg(F.count(F.lit(1)).alias("cnt"))


def running_page_views(
    df: DataFrame,
    order_by: Sequence[str],
    behavior: str = "pv",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """The count so far, once per row."""
    return rolling_count(
        _behavior(df, behavior), ["behavior"], order_by, "cnt", limits
    )


def unique_visitors(
    df: DataFrame, behavior: str | None = "pv", approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return _behavior(df, behavior).agg(count("user_id").alias("uv"))


def visitors_per_window(
    df: DataFrame, ts: str, size: str, slide: str, user: str = "user_id"
) -> DataFrame:
    """Distinct users of each sliding window, from a mergeable sketch per pane (see ``distinct_estimate``)."""
    return sliding(df, ts, size, slide, (), {"uv": distinct_estimate(user)})


def _hot(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    size: str,
    slide: str,
    n: int,
    measure: str,
) -> DataFrame:
    counts = sliding(df, ts, size, slide, keys, {measure: ("count", None)})
    return top_n(counts, n, measure, keys).select("window_end", "rk", *keys, measure)


def hot_items(behavior: DataFrame, n: int = 3) -> DataFrame:
    """Most viewed items of each hour, every five minutes."""
    views = _behavior(behavior, "pv").withColumn("_at", event_time("timestamp"))
    return _hot(views, "_at", ["item_id"], "1 hour", "5 minutes", n, "item_count")


def hot_pages(log: DataFrame, n: int = 3) -> DataFrame:
    """Most requested pages of ten minutes, every five seconds."""
    return _hot(log, "event_time", ["url"], "10 minutes", "5 seconds", n, "view_count")


def hot_ads_by_province(clicks: DataFrame, ts: str, n: int = 3) -> DataFrame:
    """Most clicked (province, ad) pairs of ten minutes, every five seconds."""
    keys = ["province", "ad_id"]
    return _hot(clicks, ts, keys, "10 minutes", "5 seconds", n, "click_count")


def hot_ads_by_user(clicks: DataFrame, ts: str, n: int = 3) -> DataFrame:
    """Most frequent (user, ad) pairs of each hour, every five minutes."""
    keys = ["user_id", "ad_id"]
    return _hot(clicks, ts, keys, "1 hour", "5 minutes", n, "click_count")


def blacklist_then_hot_ads(
    clicks: DataFrame, ts: str, order_by: Sequence[str], limit: int = 100, n: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Hot ads without clicks above the daily limit, and the alerts."""
    keys = ["user_id", "ad_id"]
    passed = blacklist_pass(clicks, keys, ts, order_by, limit)
    alerts = blacklist_alerts(clicks, keys, ts, order_by, limit)
    return hot_ads_by_user(passed, ts, n), alerts


def login_failures(events: DataFrame, within: Span = 2) -> DataFrame:
    """Two failed logins of a user in a row within two seconds."""
    failed = F.col("event_type") == "fail"
    return repeated_failures(events, "user_id", "event_time", failed, within)


def order_timeouts(events: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Outcome of each order with fifteen minutes to pay."""
    return order_outcomes(events, order_by, limit=15 * 60)


def classify_levels(
    df: DataFrame, value: str, warn: float = 50, alarm: float = 80
) -> DataFrame:
    labelled = label(df, level_cases(value, warn, alarm))
    return labelled.withColumn("label", F.col("labels")[0]).drop("labels")


def threshold_alarm(df: DataFrame, value: str, above: float = 5) -> DataFrame:
    """All rows, and again with tag ``alarm`` those above the threshold."""
    return side_output(df, F.col(value) > above, "alarm")


def rising_levels(sensors: DataFrame, unit: str = "s") -> DataFrame:
    """Sensors whose level has been rising for five seconds."""
    timed = sensors.withColumn("_at", event_time("ts", unit))
    return rising_alerts(timed, "id", "_at", "vc", "5 seconds")
