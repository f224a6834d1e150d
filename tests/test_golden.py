"""Golden cases over the fixed input rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow import operators as op
from rillflow import plans, schemas
from rillflow.functions import Rule, event_time
from rillflow.sources import (
    parse_access_log,
    parse_ad_click,
    parse_login,
    parse_order,
    parse_sensor,
    parse_user_behavior,
    rows,
)
from tests.rows import AD_CLICK_LINES, ORDER_LINES, SENSOR_LINES, WORD_LINES


def as_set(df, *columns):
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) == len(set(got))
    return set(got)


def at(second):
    return F.timestamp_seconds(F.lit(second))


def numbered(df):
    """Adds the place of each row in the file."""
    return df.withColumn("place", F.monotonically_increasing_id())


@pytest.fixture
def sensors(lines):
    parsed = numbered(parse_sensor(lines(SENSOR_LINES)))
    return parsed.withColumn("id", F.replace(F.col("id"), F.lit("'"), F.lit("")))


@pytest.fixture
def clicks(lines):
    parsed = numbered(parse_ad_click(lines(AD_CLICK_LINES)))
    return parsed.withColumn("ts", event_time("timestamp", "s"))


def test_word_count(lines):
    got = as_set(plans.word_count(lines(WORD_LINES)), "word", "cnt")
    assert got == {("hello", 4), ("scala", 1), ("java", 1), ("spark", 1), ("python", 1)}


def test_trailing_spaces_and_empty_lines(spark):
    text = rows(spark, ["a  b  ", "", "   ", " c"], schemas.LINE)
    got = Counter(r.word for r in op.words(text).collect())
    assert got == Counter({"a": 1, "": 3, "b": 1, "c": 1})


def test_sensor_lines_keep_quotes(lines):
    first = parse_sensor(lines(SENSOR_LINES)).first()
    assert tuple(first) == ("'sensor_1'", 1600262289186, 49)


def test_levels(sensors):
    got = Counter(
        r.label for r in plans.classify_levels(sensors, "vc").collect()
    )
    assert got == {"normal": 12, "warn": 1, "alarm": 2}


def test_pattern(lines):
    rule = (
        Rule("start")
        .where(F.col("id") == "'sensor_0'")
        .where(F.col("vc") >= 50)
        .or_(F.col("id") == "'sensor_2'")
    )
    matches = rule.matches(parse_sensor(lines(SENSOR_LINES)))
    assert matches.count() == 9
    assert matches.select(F.col("match")["start"][0]["id"].alias("id")).where(
        "id = \"'sensor_1'\""
    ).isEmpty()


def test_rolling_max(sensors):
    rows_ = sensors.withColumn("first_ts", F.col("ts"))
    got = op.rolling_max(rows_.select("id", "place", "ts", "vc"), ["id"], ["place"], "vc")
    s0, s1, s2 = 1600262291199, 1600262289186, 1600262295200
    want = Counter(
        [("sensor_1", s1, 49)] * 2
        + [("sensor_0", s0, 42), ("sensor_0", s0, 80)]
        + [("sensor_0", s0, 100)] * 5
        + [("sensor_2", s2, 43)] * 2
        + [("sensor_2", s2, 48)] * 4
    )
    assert Counter(tuple(r) for r in got.select("id", "ts", "vc").collect()) == want


def test_rolling_reduce(sensors):
    out = op.rolling_reduce(
        sensors.select("id", "place", "ts", "vc"),
        ["id"],
        ["place"],
        "vc",
        {"ts": 123},
    ).where("id = 'sensor_1'")
    got = [tuple(r) for r in out.orderBy("place").select("ts", "vc").collect()]
    assert got == [(1600262289186, 49), (123, 96)]


def test_count_window(sensors):
    out = op.count_window(
        sensors, ["id"], ["place"], 3, 2, aggregates={"vc": ("sum", "vc")}
    )
    assert as_set(out, "id", "seen", "vc") == {
        ("sensor_1", 2, 96),
        ("sensor_2", 2, 86),
        ("sensor_0", 2, 122),
        ("sensor_2", 4, 131),
        ("sensor_0", 4, 223),
        ("sensor_0", 6, 159),
        ("sensor_2", 6, 125),
    }


def test_count_window_drops_short_tail(sensors):
    out = op.count_window(sensors, ["id"], ["place"], 3)
    assert as_set(out, "id", "seen", "cnt") == {
        ("sensor_0", 3, 3),
        ("sensor_0", 6, 3),
        ("sensor_2", 3, 3),
        ("sensor_2", 6, 3),
    }


def test_tumbling(sensors):
    timed = sensors.withColumn("at", event_time("ts", "ms"))
    out = op.tumbling(timed, "at", "5 seconds", ["id"]).withColumn(
        "end", F.unix_millis("window_end")
    )
    got = as_set(out, "id", "end", "cnt")
    assert len(got) == 12
    assert {(i, e) for i, e, n in got if n == 2} == {
        ("sensor_2", 1600262300000),
        ("sensor_2", 1600262310000),
        ("sensor_0", 1600262315000),
    }
    assert {n for _, _, n in got} == {1, 2}


def test_rising_alerts(sensors):
    out = op.rising_alerts(sensors, "id", "ts", "vc", 5000)
    assert as_set(out, "id", "deadline", "level") == {
        ("sensor_0", 1600262296199, 42),
        ("sensor_0", 1600262304201, 100),
        ("sensor_2", 1600262312203, 42),
        ("sensor_2", 1600262322205, 43),
    }


def test_ad_clicks_by_user(clicks):
    out = plans.hot_ads_by_user(clicks, "ts")
    ends = out.select("window_end").distinct()
    assert ends.count() == 24

    def top(second):
        return as_set(
            out.where(F.col("window_end") == at(second)),
            "rk", "user_id", "ad_id", "click_count",
        )

    assert top(1511658300) == {
        (1, 543462, 1715, 1),
        (2, 561558, 3611281, 1),
        (3, 662867, 2244074, 1),
    }
    assert top(1511661900) == {
        (1, 937166, 1715, 121),
        (2, 161501, 36156, 4),
        (3, 2315, 7156, 2),
    }


def test_ad_clicks_by_province(clicks):
    out = plans.hot_ads_by_province(clicks, "ts")
    assert out.select("window_end").distinct().count() == 383

    def top(second):
        return as_set(
            out.where(F.col("window_end") == at(second)),
            "rk", "province", "ad_id", "click_count",
        )

    assert top(1511658005) == {(1, "beijing", 1715, 1)}
    assert top(1511661605) == {(1, "beijing", 1715, 4)}
    assert top(1511662200) == {
        (1, "beijing", 1715, 121),
        (2, "jiangsu", 36156, 4),
        (3, "henan", 2914, 2),
    }


def test_report_lists_at_most_n(clicks):
    out = plans.hot_ads_by_province(clicks, "ts")
    text = (
        op.report(out, "province", "ad_id", "click_count")
        .where(F.col("window_end") == at(1511658005))
        .first()
        .report
    )
    assert text.splitlines()[2] == "province=beijing, ad_id=1715, click_count=1"
    assert len(text.splitlines()) == 4


def test_blacklist(clicks):
    keys = ["user_id", "ad_id"]
    passed = op.blacklist_pass(clicks, keys, "ts", ["place"], 100)
    assert passed.count() == 122
    assert passed.where("user_id = 937166").count() == 100
    alerts = op.blacklist_alerts(clicks, keys, "ts", ["place"], 100)
    assert as_set(
        alerts.withColumn("s", F.unix_seconds("ts")), *keys, "s", "clicks"
    ) == {(937166, 1715, 1511661701, 100)}
    top = plans.hot_ads_by_user(passed, "ts").where(
        F.col("window_end") == at(1511661900)
    )
    assert as_set(top, "rk", *keys, "click_count") == {
        (1, 937166, 1715, 100),
        (2, 161501, 36156, 4),
        (3, 2315, 7156, 2),
    }


def test_blacklist_starts_again_at_midnight(spark):
    day = 86_400
    data = [(1, 7, day - 3 + i, i) for i in range(3)] + [(1, 7, day, 3), (1, 7, day + 1, 4)]
    clicks = spark.createDataFrame(data, "user bigint, ad bigint, s bigint, place int")
    clicks = clicks.withColumn("ts", event_time("s"))
    out = op.blacklist(clicks, ["user", "ad"], "ts", ["place"], 2)
    assert as_set(out, "place", "tag", "clicks") == {
        (0, "main", 1), (1, "main", 2), (2, "alert", 2), (3, "main", 1), (4, "main", 2),
    }


def test_order_outcomes(lines):
    events = numbered(parse_order(lines(ORDER_LINES)))
    assert events.where("event_type = 'create' AND tx_id = ''").count() == 39
    out = op.order_outcomes(events, ["place"])
    assert Counter(r.outcome for r in out.collect()) == {
        "paid": 36,
        "paid_late": 3,
        "create_missing": 1,
    }
    late = out.where("outcome = 'paid_late'").withColumn("gap", F.expr("paid - created"))
    assert as_set(late, "order_id", "gap") == {
        (34731, 1_000_003), (34756, 1_038), (34767, 1_072),
    }
    missing = out.where("outcome = 'create_missing'")
    assert as_set(missing, "order_id") == {(34768,)}


def test_order_edges(spark):
    data = [
        (1, "pay", 10, 0), (1, "create", 20, 1),  # pay first still counts as paid
        (2, "create", 0, 2), (2, "pay", 900, 3),
        (3, "create", 0, 4), (3, "pay", 901, 5),
        (4, "create", 5, 6),
        (5, "pay", 5, 7),
        (6, "create", 0, 8), (6, "create", 50, 9), (6, "pay", 940, 10), (6, "pay", 941, 11),
    ]
    events = spark.createDataFrame(
        data, "order_id bigint, event_type string, event_time bigint, place int"
    )
    out = op.order_outcomes(events, ["place"])
    assert as_set(out, "order_id", "outcome", "created", "paid") == {
        (1, "paid", 20, 10),
        (2, "paid", 0, 900),
        (3, "paid_late", 0, 901),
        (4, "pay_missing", 5, None),
        (5, "create_missing", None, 5),
        (6, "pay_missing", 0, None),
        (6, "paid", 50, 940),
        (6, "create_missing", None, 941),
    }


def test_login_failures(lines):
    text = [
        "1,10.0.0.1,fail,100", "1,10.0.0.1,success,101", "1,10.0.0.1,fail,102",
        "1,10.0.0.1,fail,105", "2,10.0.0.2,fail,103", "2,10.0.0.2,success,104",
    ]
    out = plans.login_failures(parse_login(lines(text)))
    assert as_set(out, "user_id", "previous_ts", "event_time") == {(1, 100, 102)}


def test_rising_edges(spark):
    data = [
        ("exact", 0, 5), ("exact", 5000, 5),  # a fall at the deadline cancels
        ("after", 0, 5), ("after", 5001, 5),  # one after it does not
        ("twice", 0, 5), ("twice", 1, 4), ("twice", 2, 3), ("twice", 3, 9),
        ("low", 0, 0), ("low", 9000, -1),
    ]
    rows_ = spark.createDataFrame(data, "id string, ts bigint, vc int")
    out = op.rising_alerts(rows_, "id", "ts", "vc", 5000)
    assert as_set(out, "id", "deadline", "level") == {
        ("after", 5000, 5), ("twice", 5003, 9),
    }


def test_access_log(lines):
    line = "10.0.0.1 - - 17/05/2015:10:05:03 +0000 GET /index"
    row = parse_access_log(lines([line])).withColumn(
        "s", F.unix_seconds("event_time")
    ).first()
    assert (row.ip, row.user_id, row.s, row.method, row.url) == (
        "10.0.0.1", "-", 1431857103, "GET", "/index",
    )


def test_hot_pages(lines):
    def line(second, url):
        return f"10.0.0.1 - - 17/05/2015:10:05:{second:02d} +0000 GET {url}"

    log = [line(1, "/a"), line(2, "/a"), line(3, "/b"), line(4, "/c"), line(4, "/d")]
    out = plans.hot_pages(parse_access_log(lines(log)))
    first = out.orderBy("window_end", "rk").limit(3)
    got = [tuple(r) for r in first.select("rk", "url", "view_count").collect()]
    assert got == [(1, "/a", 2), (2, "/b", 1), (3, "/c", 1)]


def test_page_views(lines):
    text = [
        "1001,2001,301,pv,1511658000", "1002,2001,301,pv,1511658001",
        "1001,2002,302,buy,1511658002", "1001,2002,302,pv,1511658003",
    ]
    behavior = parse_user_behavior(lines(text))
    assert plans.page_views(behavior).first().cnt == 3
    assert plans.page_views(behavior, None).first().cnt == 4
    assert plans.unique_visitors(behavior).first().uv == 2
    assert plans.unique_visitors(behavior, approximate=True).first().uv == 2
    running = plans.running_page_views(behavior, ["timestamp"])
    assert sorted(r.cnt for r in running.collect()) == [1, 2, 3]
    hot = plans.hot_items(behavior)
    first = hot.orderBy("window_end", "rk").first()
    assert (first.item_id, first.item_count) == (2001, 2)


def test_bad_number(lines):
    text = ["s,1,2", "s,x,2", "s,3"]
    lenient = parse_sensor(lines(text), strict=False)
    assert [tuple(r) for r in lenient.collect()] == [
        ("s", 1, 2), ("s", None, 2), ("s", 3, None),
    ]
    with pytest.raises(Exception, match="bad line: ts"):
        parse_sensor(lines(text)).collect()


def test_threshold(sensors):
    tagged = plans.threshold_alarm(sensors, "vc", 60)
    assert tagged.where("tag IS NULL").count() == 15
    assert sorted(r.vc for r in tagged.where("tag = 'alarm'").collect()) == [70, 80, 100]


def test_strict_parsers_do_not_depend_on_ansi(spark, lines):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for text in ("s,x,2", "s,1"):
            with pytest.raises(Exception, match="bad line"):
                parse_sensor(lines([text])).collect()
            assert parse_sensor(lines([text]), strict=False).count() == 1
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_days_are_utc_days_in_any_session(spark):
    rows = [(1, 86_399), (1, 86_400), (1, 86_401)]
    df = spark.createDataFrame(rows, "k int, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = op.blacklist(df, ["k"], "ts", ["s"], 1).select("s", "tag", "day").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = sorted((r.s, r.tag, str(r.day)) for r in out)
    assert got == [(86_399, "main", "1970-01-01"), (86_400, "main", "1970-01-02"), (86_401, "alert", "1970-01-02")]


def test_a_null_event_type_counts_as_a_pay(spark):
    rows = [(1, "create", 10), (1, None, 12)]
    df = spark.createDataFrame(rows, "order_id int, event_type string, event_time bigint")
    out = op.order_outcomes(df, ["event_time"]).collect()
    assert [tuple(r) for r in out] == [(1, "paid", 10, 12)]


def test_large_limits_keep_the_first_rows(spark):
    rows = [(k % 3, (k * 7919) % 6_000, k) for k in range(6_000)]
    df = spark.createDataFrame(rows, "w int, m int, id int").repartition(5)
    top = op.top_n(df, 1_500, "m", ["id"], window="w").collect()
    for w in range(3):
        want = sorted((r for r in rows if r[0] == w), key=lambda r: (-r[1], r[2]))[:1_500]
        got = sorted((r.rk, r.w, r.m, r.id) for r in top if r.w == w)
        assert got == [(n + 1, *r) for n, r in enumerate(want)]
    clicks = df.withColumn("ts", F.timestamp_seconds(F.lit(5)))
    out = op.blacklist(clicks, ["w"], "ts", ["id"], 1_200)
    tags = Counter((r.w, r.tag) for r in out.collect())
    assert tags == Counter({(w, "main"): 1_200 for w in range(3)} | {(w, "alert"): 1 for w in range(3)})
