"""Streaming operators over files, one micro-batch per step."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow import schemas, sinks
from rillflow import streaming as st
from rillflow.functions import event_time
from rillflow.functions.text import tokens
from rillflow.operators.transforms import side_output
from rillflow.sources import kafka_options, parse_sensor, socket_lines, text_stream
from rillflow.streaming.stateful import keep_max, keep_sum
from tests.rows import SENSOR_LINES


class Feed:
    """Writes lines and runs a stream over them from its checkpoint."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.steps = spark, folder, 0
        (folder / "in").mkdir()

    def step(self, build, *lines, mode="append", writer=st.folder_sink):
        path = self.folder / "in" / f"{self.steps:04d}.txt"
        path.write_text("\n".join(lines))
        self.steps += 1
        stream = build(text_stream(self.spark, str(self.folder / "in"), 1))
        write = stream.writeStream.outputMode(mode)
        return st.drain(
            write.foreachBatch(writer(str(self.folder / "out"))),
            str(self.folder / "progress"),
        )

    def read(self):
        return self.spark.read.parquet(str(self.folder / "out"))

    def rows(self, *columns):
        return Counter(tuple(r) for r in self.read().select(*columns).collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def sensors(lines):
    return parse_sensor(lines).withColumn("at", event_time("ts", "s"))


def end_s(c="window_end"):
    return F.unix_seconds(c).alias("end")


def test_running_word_count_update_mode(feed):
    def build(lines):
        return st.running_totals(
            lines.select(F.explode(tokens("value")).alias("word")), ["word"]
        )

    feed.step(build, "a b a", mode="update")
    feed.step(build, "a c", mode="update")
    assert feed.rows("batch_id", "word", "cnt") == Counter(
        [(0, "a", 2), (0, "b", 1), (1, "a", 3), (1, "c", 1)]
    )


def test_tumbling_waits_for_watermark_and_drops_late_rows(feed):
    def build(lines):
        timed = st.with_event_time(sensors(lines), "at", "3 seconds")
        return st.tumbling(timed, "at", "5 seconds", ["id"])

    feed.step(build, "a,1,0", "a,4,0", "a,7,0")
    assert feed.read().isEmpty()  # watermark 4
    feed.step(build, "a,2,0", "a,8,0")  # in time; watermark 5 closes [0, 5)
    assert feed.rows("id", end_s(), "cnt") == Counter([("a", 5, 3)])
    last = feed.step(build, "a,3,0", "a,20,0")  # 3 is too late
    assert feed.rows("id", end_s(), "cnt") == Counter([("a", 5, 3), ("a", 10, 2)])
    dropped = sum(
        json.loads(p.json)["stateOperators"][0]["numRowsDroppedByWatermark"]
        for p in last.recentProgress
    )
    assert dropped == 1


def test_sliding_panes_equal_direct_windows(feed, spark, tmp_path):
    def build(panes):
        def run(lines):
            timed = st.with_event_time(sensors(lines), "at")
            sums = {"n": ("count", None), "vc": ("max", "vc")}
            return st.sliding(timed, "at", "10 seconds", "5 seconds", ["id"], sums, panes)

        return run

    data = ["a,1,5", "a,6,2", "b,7,1", "a,13,9", "z,1000,0"]
    feed.step(build(True), *data)
    other = tmp_path / "direct"
    other.mkdir()
    direct = Feed(spark, other)
    direct.step(build(False), *data)
    got = feed.rows("id", end_s(), "n", "vc")
    assert got == direct.rows("id", end_s(), "n", "vc")
    assert got[("a", 10, 2, 5)] == 1


def test_sessions(feed):
    def build(lines):
        return st.session(
            st.with_event_time(sensors(lines), "at"), "at", "3 seconds", ["id"]
        )

    feed.step(build, "a,1,0", "a,4,0", "a,8,0")
    feed.step(build, "z,100,0")
    assert feed.rows("id", end_s(), "cnt") == Counter([("a", 7, 2), ("a", 11, 1)])


def test_processing_time_windows(feed):
    def build(lines):
        timed = st.with_processing_time(sensors(lines))
        return st.tumbling(timed, "arrived", "5 seconds", ["id"])

    feed.step(build, "a,1,0", "a,2,0", "b,1,0", mode="update")
    assert Counter(
        (r.id, r.cnt) for r in feed.read().where("batch_id = 0").collect()
    ) == Counter([("a", 2), ("b", 1)])


def test_top_n_ranks_final_windows(feed):
    def build(lines):
        timed = st.with_event_time(sensors(lines), "at")
        return st.tumbling(timed, "at", "5 seconds", ["id"])

    def ranked(path):
        return st.top_n_sink(st.folder_sink(path), 2, "cnt", ["id"])

    feed.step(build, "b,1,0", "c,1,0", "a,1,0", "c,2,0", writer=ranked)
    feed.step(build, "z,100,0", writer=ranked)
    assert feed.rows("rk", "id", "cnt") == Counter([(1, "c", 2), (2, "a", 1)])


def test_update_mode_revises_late_windows(feed):
    def build(lines):
        return st.late_updates(
            sensors(lines), "at", "5 seconds", ["id"], "3 seconds", "2 seconds"
        )

    feed.step(build, "a,1,0", "a,9,0", mode="update")
    feed.step(build, "a,2,0", mode="update")
    counts = feed.read().where(end_s() == 5).orderBy("batch_id")
    assert [r.cnt for r in counts.collect()] == [1, 2]


def test_late_windows_fire_at_end_and_per_late_row(feed):
    def build(lines):
        return st.late_windows(
            sensors(lines), ["id"], "at", "5 seconds", "3 seconds", "2 seconds"
        )

    def seen():
        return feed.rows("id", end_s(), "cnt")

    feed.step(build, "a,1,0", "a,7,0")  # event time less the delay: 4
    assert not seen()
    feed.step(build, "a,8,0")  # 5: the window ends
    assert seen() == Counter([("a", 5, 1)])
    feed.step(build, "a,4,0", "a,4,0")  # late, still allowed
    assert seen() == Counter([("a", 5, 1), ("a", 5, 2), ("a", 5, 3)])
    feed.step(build, "a,10,0")  # 7: closed for good
    feed.step(build, "a,4,0", "a,10,0")
    assert seen() == Counter([("a", 5, 1), ("a", 5, 2), ("a", 5, 3)])


def test_rolling_reduce_goes_on_after_restart(feed):
    def build(lines):
        return st.rolling_reduce(parse_sensor(lines), ["id"], ["ts"], keep_sum("vc"))

    feed.step(build, "a,1,5", "a,2,6")
    feed.step(build, "a,3,7", "b,1,1")
    assert feed.rows("id", "ts", "vc") == Counter(
        [("a", 1, 5), ("a", 1, 11), ("a", 1, 18), ("b", 1, 1)]
    )


def test_rolling_max_keeps_first_row(feed):
    def build(lines):
        return st.rolling_reduce(parse_sensor(lines), ["id"], ["ts"], keep_max("vc"))

    feed.step(build, *SENSOR_LINES)
    levels = [r.vc for r in feed.read().where("id = \"'sensor_0'\"").collect()]
    assert sorted(levels) == [42, 80, 100, 100, 100, 100, 100]
    assert feed.read().select("id", "ts").distinct().count() == 3


def test_count_window_across_batches(feed):
    def build(lines):
        return st.count_window(parse_sensor(lines), ["id"], ["ts"], "vc", 3, 2)

    feed.step(build, "a,1,1", "a,2,2", "a,3,3")
    feed.step(build, "a,4,4", "a,5,5", "b,1,9")
    assert feed.rows("id", "seen", "vc") == Counter([("a", 2, 3), ("a", 4, 9)])


def test_daily_limit(feed):
    def build(lines):
        return st.daily_limit(sensors(lines), ["id"], "at", ["vc"], 2)

    day = 86_400
    feed.step(build, f"a,{day - 9},0", f"a,{day - 8},1", f"a,{day - 7},2")
    feed.step(build, f"a,{day - 6},3", f"a,{day},4")
    assert feed.rows("vc", "tag", "clicks") == Counter(
        [(0, "main", 1), (1, "main", 2), (2, "alert", 2), (4, "main", 1)]
    )


def test_repeated_failures(feed):
    def build(lines):
        failed = F.col("vc") == 0
        return st.repeated_failures(
            sensors(lines), "id", "at", failed, "2 seconds", "0 seconds"
        )

    feed.step(build, "a,1,0", "a,2,1", "b,2,0")
    feed.step(build, "a,3,0", "a,6,0")
    feed.step(build, "z,50,0")
    assert feed.rows("id", end_s("previous_ts"), end_s("at")) == Counter([("a", 1, 3)])


def test_repeated_failures_out_of_order(feed):
    def build(lines):
        failed = F.col("vc") == 0
        return st.repeated_failures(
            sensors(lines), "id", "at", failed, "2 seconds", "10 seconds"
        )

    feed.step(build, "a,100,0", "a,105,0")
    feed.step(build, "a,102,0", "b,104,0")  # within the delay
    feed.step(build, "b,103,0", "z,500,0")
    feed.step(build, "z,501,0", "z,900,0")
    assert feed.rows("id", end_s("previous_ts"), end_s("at")) == Counter(
        [("a", 100, 102), ("b", 103, 104), ("z", 500, 501)]
    )


def test_rising_alerts(feed):
    def build(lines):
        return st.rising_alerts(sensors(lines), "id", "at", "vc", "5 seconds")

    def seen():
        return feed.rows("id", end_s("deadline"), "level")

    feed.step(build, "a,1,5", "b,1,5", "c,1,5")
    feed.step(build, "a,4,6", "b,6,5", "c,4,3")  # b falls at the deadline, c before
    feed.step(build, "z,7,0")
    assert seen() == Counter([("a", 6, 6)])  # the timer, as event time is past 6
    feed.step(build, "a,9,1", "z,50,0")
    assert seen() == Counter([("a", 6, 6)])


def test_rising_alerts_out_of_order(feed):
    def build(lines):
        rows = sensors(lines)
        return st.rising_alerts(rows, "id", "at", "vc", "5 seconds", delay="10 seconds")

    feed.step(build, "a,1,5", "a,4,6", "b,1,5", "b,5,9")
    feed.step(build, "a,2,3", "b,3,1")  # a goes on rising from 3, b falls from 5
    feed.step(build, "z,500,1")
    assert feed.rows("id", end_s("deadline"), "level") == Counter(
        [("a", 9, 6), ("b", 10, 9)]
    )


def test_orders(feed):
    def build(lines):
        parsed = sensors(lines).select(
            F.col("vc").alias("order_id"), F.col("id").alias("event_type"), "at"
        )
        return st.order_outcomes(parsed, "at", "10 seconds", "20 seconds")

    def seen():
        return feed.rows("order_id", "outcome", end_s("created"), end_s("paid"))

    feed.step(build, "create,1,1", "pay,2,2", "create,2,3", "create,2,4")
    feed.step(build, "pay,9,1", "create,12,2", "pay,12,3")
    paid = [(1, "paid", 1, 9), (2, "paid", 12, 2), (3, "paid", 2, 12)]
    assert seen() == Counter(paid)
    feed.step(build, "create,13,9")  # more than 10 s after order 4
    assert seen() == Counter([*paid, (4, "pay_missing", 2, None)])
    feed.step(build, "pay,20,4", "pay,20,5")
    late = [*paid, (4, "pay_missing", 2, None), (4, "paid_late", 2, 20)]
    assert seen() == Counter(late)
    feed.step(build, "create,90,8")
    assert seen() == Counter(
        [*late, (9, "pay_missing", 13, None), (5, "create_missing", None, 20)]
    )


def test_first_timer(feed):
    def build(lines):
        return st.first_timer(sensors(lines), ["id"], "at", "5 seconds")

    feed.step(build, "a,1,0", "a,3,0")
    feed.step(build, "a,4,0", "b,7,0")
    assert feed.rows("id", end_s("fires_at")) == Counter([("a", 6)])


def test_first_timer_out_of_order(feed):
    def build(lines):
        return st.first_timer(sensors(lines), ["id"], "at", "5 seconds", "10 seconds")

    feed.step(build, "a,20,0", "b,20,0")
    feed.step(build, "a,15,0", "b,21,0")
    feed.step(build, "z,100,0")
    feed.step(build, "a,101,0")
    assert feed.rows("id", end_s("fires_at")) == Counter([("a", 20), ("b", 25)])


def test_side_output_fan_out(feed, spark, tmp_path):
    def build(lines):
        return side_output(parse_sensor(lines), F.col("vc") > 5, "alarm")

    def split(path):
        return sinks.fan_out(
            {
                None: st.folder_sink(f"{path}/main"),
                "alarm": st.folder_sink(f"{path}/alarm"),
            }
        )

    feed.step(build, "a,1,5", "a,2,6", writer=split)
    out = str(tmp_path / "out")
    assert spark.read.parquet(f"{out}/main").count() == 2
    assert [r.vc for r in spark.read.parquet(f"{out}/alarm").collect()] == [6]


def test_source_options(spark):
    assert kafka_options("host:9092", "sensor", "group") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "sensor",
        "startingOffsets": "latest",
        "kafka.group.id": "group",
    }
    stream = socket_lines(spark, "localhost", 9)  # opens nothing before it starts
    assert stream.isStreaming and stream.columns == schemas.LINE.names
