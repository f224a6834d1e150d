"""Ready-made jobs over parsed logs (streaming form).

The hot lists return final window counts; write them through
:func:`rillflow.streaming.top_n_sink` to rank each window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow import streaming as st
from rillflow.functions.text import tokens
from rillflow.functions.time import event_time


def word_count(lines: DataFrame) -> DataFrame:
    """Current counts of the words in each micro-batch; use update mode."""
    return st.running_totals(
        lines.select(F.explode(tokens("value")).alias("word")), ["word"]
    )


def page_views(df: DataFrame, behavior: str | None = "pv") -> DataFrame:
    """The page views so far; use update mode."""
    views = df if behavior is None else df.where(F.col("behavior") == behavior)
    return st.running_totals(views, [])


def unique_visitors(df: DataFrame, behavior: str | None = "pv") -> DataFrame:
    """About how many users there were so far; use update mode."""
    views = df if behavior is None else df.where(F.col("behavior") == behavior)
    return views.groupBy().agg(F.approx_count_distinct("user_id").alias("uv"))


def _at(df: DataFrame, epoch: str) -> DataFrame:
    return df.withColumn("_at", event_time(epoch, "s"))


def hot_items(behavior: DataFrame) -> DataFrame:
    views = _at(behavior.where(F.col("behavior") == "pv"), "timestamp")
    timed = st.with_event_time(views, "_at")
    count = {"item_count": ("count", None)}
    return st.sliding(timed, "_at", "1 hour", "5 minutes", ["item_id"], count)


def hot_pages(log: DataFrame) -> DataFrame:
    """Requests may be up to a minute out of order."""
    timed = st.with_event_time(log, "event_time", "1 minute")
    count = {"view_count": ("count", None)}
    return st.sliding(timed, "event_time", "10 minutes", "5 seconds", ["url"], count)


def hot_ads_by_province(clicks: DataFrame) -> DataFrame:
    timed = st.with_event_time(_at(clicks, "timestamp"), "_at")
    keys, count = ["province", "ad_id"], {"click_count": ("count", None)}
    return st.sliding(timed, "_at", "10 minutes", "5 seconds", keys, count)


def hot_ads_by_user(clicks: DataFrame) -> DataFrame:
    timed = st.with_event_time(_at(clicks, "timestamp"), "_at")
    keys, count = ["user_id", "ad_id"], {"click_count": ("count", None)}
    return st.sliding(timed, "_at", "1 hour", "5 minutes", keys, count)


def blacklist(clicks: DataFrame, limit: int = 100) -> DataFrame:
    """Clicks tagged ``main``, and one ``alert`` per user, ad and day over the limit."""
    keys = ["user_id", "ad_id"]
    return st.daily_limit(_at(clicks, "timestamp"), keys, "_at", ["_us"], limit)


def blacklist_then_hot_ads(clicks: DataFrame, limit: int = 100) -> DataFrame:
    passed = blacklist(clicks, limit).where(F.col("tag") == "main")
    keys, count = ["user_id", "ad_id"], {"click_count": ("count", None)}
    return st.sliding(passed, "_at", "1 hour", "5 minutes", keys, count)


def login_failures(events: DataFrame) -> DataFrame:
    """Two failed logins in a row within two seconds, up to ten out of order."""
    failed = F.col("event_type") == "fail"
    return st.repeated_failures(
        _at(events, "event_time"), "user_id", "_at", failed, "2 seconds", "10 seconds"
    )


def order_timeouts(events: DataFrame, keep: str = "1 day") -> DataFrame:
    """Outcome of each order with fifteen minutes to pay."""
    timed = _at(events, "event_time")
    return st.order_outcomes(timed, "_at", "15 minutes", keep)


def rising_levels(sensors: DataFrame, unit: str = "s") -> DataFrame:
    """Sensors whose level has been rising for five seconds."""
    timed = sensors.withColumn("_at", event_time("ts", unit))
    return st.rising_alerts(timed, "id", "_at", "vc", "5 seconds")
