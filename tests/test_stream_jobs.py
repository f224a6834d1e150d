"""Streaming jobs end with the rows of the batch jobs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow import plans
from rillflow import streaming as st
from rillflow.functions import event_time
from rillflow.operators import top_n
from rillflow.plans import streams
from rillflow.sources import (
    parse_access_log,
    parse_ad_click,
    parse_login,
    parse_order,
    parse_sensor,
    parse_user_behavior,
)
from tests.rows import AD_CLICK_LINES, ORDER_LINES, SENSOR_LINES, WORD_LINES
from tests.test_streams import Feed, end_s


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def counter(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_word_count(feed):
    feed.step(streams.word_count, *WORD_LINES, mode="update")
    assert feed.rows("word", "cnt")[("hello", 4)] == 1


def test_page_views_and_visitors(feed, spark, tmp_path):
    text = ["1,2,3,pv,1", "1,2,3,buy,2", "2,2,3,pv,3"]
    feed.step(lambda x: streams.page_views(parse_user_behavior(x)), *text, mode="update")
    assert feed.rows("cnt") == Counter([(2,)])
    (tmp_path / "uv").mkdir()
    other = Feed(spark, tmp_path / "uv")
    other.step(
        lambda x: streams.unique_visitors(parse_user_behavior(x)), *text, mode="update"
    )
    assert other.rows("uv") == Counter([(2,)])


def test_blacklist_then_hot_ads(feed, lines):
    def build(text):
        return streams.blacklist_then_hot_ads(parse_ad_click(text))

    def ranked(path):
        return st.top_n_sink(st.folder_sink(path), 3, "click_count", ["user_id", "ad_id"])

    feed.step(build, *AD_CLICK_LINES, writer=ranked)
    feed.step(build, "0,0,x,x,1600000000", writer=ranked)
    clicks = parse_ad_click(lines(AD_CLICK_LINES)).withColumn("ts", event_time("timestamp"))
    clicks = clicks.withColumn("place", F.monotonically_increasing_id())
    top, alerts = plans.blacklist_then_hot_ads(clicks, "ts", ["place"])
    columns = (end_s(), "rk", "user_id", "ad_id", "click_count")
    assert feed.rows(*columns) == counter(top, *columns)
    assert alerts.count() == 1


def test_hot_pages(feed, lines):
    def line(second, url):
        return f"10.0.0.1 - - 17/05/2015:10:05:{second:02d} +0000 GET {url}"

    log = [line(9, "/a"), line(1, "/a"), line(3, "/b"), line(4, "/c")]
    later = "10.0.0.1 - - 17/05/2016:10:05:00 +0000 GET /z"
    for text in (log, [later]):
        feed.step(lambda x: streams.hot_pages(parse_access_log(x)), *text)
    top = top_n(feed.read(), 3, "view_count", ["url"])
    columns = (end_s(), "rk", "url", "view_count")
    want = plans.hot_pages(parse_access_log(lines(log)))
    assert counter(top, *columns) == counter(want, *columns)


def test_hot_items(feed, lines):
    text = ["1,7,3,pv,100", "2,7,3,pv,200", "1,8,3,pv,400", "1,8,3,buy,500"]
    for step in (text, ["9,9,9,pv,999999"]):
        feed.step(lambda x: streams.hot_items(parse_user_behavior(x)), *step)
    want = plans.hot_items(parse_user_behavior(lines(text)))
    columns = (end_s(), "item_id", "item_count")
    assert feed.rows(*columns) == counter(want, *columns)


def test_login_failures(feed):
    text = ["1,x,fail,100", "1,x,success,101", "1,x,fail,102", "2,x,fail,102"]
    for step in (text, ["3,x,fail,1000"]):
        feed.step(lambda x: streams.login_failures(parse_login(x)), *step)
    assert feed.rows("user_id", end_s("previous_ts"), end_s("_at")) == Counter(
        [(1, 100, 102)]
    )


def test_order_timeouts(feed):
    def build(text):
        return streams.order_timeouts(parse_order(text), "30 days")

    feed.step(build, *ORDER_LINES)
    feed.step(build, "99999,create,,1600000000")
    got = Counter(r.outcome for r in feed.read().where("order_id < 99999").collect())
    assert (got["paid"], got["paid_late"], got["create_missing"]) == (36, 3, 1)
    assert got["pay_missing"] == 3  # reported at the deadline of the late ones


def test_rising_levels(feed):
    def build(text):
        return streams.rising_levels(parse_sensor(text), "ms")

    feed.step(build, *SENSOR_LINES)
    feed.step(build, "x,1700000000000,0")
    deadline = F.unix_millis("deadline")
    assert feed.rows("id", deadline, "level") == Counter(
        [
            ("'sensor_0'", 1600262296199, 42),
            ("'sensor_0'", 1600262304201, 100),
            ("'sensor_2'", 1600262312203, 42),
            ("'sensor_2'", 1600262322205, 43),
        ]
    )


def test_processing_time_sliding_and_session(feed, spark, tmp_path):
    def timed(text):
        return st.with_processing_time(parse_sensor(text))

    def sliding(text):
        return st.sliding(
            timed(text), "arrived", "10 seconds", "5 seconds", ["id"], panes=False
        )

    feed.step(sliding, "a,1,1", "a,2,1", mode="update")
    assert feed.rows("id", "cnt") == Counter({("a", 2): 2})
    (tmp_path / "session").mkdir()
    other = Feed(spark, tmp_path / "session")
    other.step(lambda x: st.session(timed(x), "arrived", "3 seconds", ["id"]), "a,1,1", "a,2,1")
    assert "arrived" not in other.read().columns


def test_watermark_time(feed):
    def build(text):
        rows = parse_sensor(text).withColumn("at", event_time("ts"))
        return st.with_watermark_time(rows, ["id"], "at", "3 seconds")

    feed.step(build, "a,10,1")
    feed.step(build, "a,20,1")
    feed.step(build, "a,30,1")
    assert feed.rows("ts", "watermark_ms") == Counter(
        [(10, 0), (20, 7000), (30, 17000)]
    )
