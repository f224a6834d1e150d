"""Streams that end, rank, join and drop rows."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillflow import streaming as st

T0 = datetime(2024, 1, 1)


def ts(seconds):
    return F.timestamp_seconds(F.lit(1_704_067_200) + seconds)


@pytest.fixture
def feed(spark, tmp_path):
    """Runs a stream over some steps of rows (columns, types); gives the output, the query and the checkpoint."""

    def run(schema, steps, build, name="s", mode="append"):
        query = None
        for step in steps:
            df = spark.createDataFrame(step, schema).withColumn("ts", ts(F.col("s")))
            df.write.mode("append").parquet(f"{tmp_path}/{name}/in")
            stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}/in")
            writer = build(stream).writeStream.outputMode(mode).foreachBatch(st.folder_sink(f"{tmp_path}/{name}/out"))
            query = st.drain(writer, f"{tmp_path}/{name}/progress")
        return spark.read.parquet(f"{tmp_path}/{name}/out").drop("batch_id"), query, f"{tmp_path}/{name}/progress"

    return run


def test_top_items_over_batches_and_its_state(spark, feed):
    def build(rows):
        counts = st.tumbling(st.with_event_time(rows, "ts"), "ts", "1 minute", ["k"])
        return st.top_items(counts, 2, "cnt", ["k"])

    first = [(k, s) for s in (1, 2, 70) for k in "abcde" if not (k == "e" and s == 2)] + [("d", 3), ("c", 80)]
    out, _, checkpoint = feed("k string, s int", [first, [("z", 75), ("b", 100)], [("m", 3600)]], build)
    found = sorted((int((r.window_end - T0).total_seconds()), r.rk, r.k, r.cnt) for r in out.collect())
    assert found == [(60, 1, "d", 3), (60, 2, "a", 2), (120, 1, "b", 2), (120, 2, "c", 2)]
    # What follows the ranking is an ordinary stream, and what a window kept is gone when it is closed.
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "best")
    assert state.option("flattenCollectionTypes", True).load(checkpoint).count() == 0


def test_state_of_the_ranking_is_bounded(spark, feed):
    """Rows of one window that come in several batches, as from an upstream that is not a window aggregate."""

    def build(rows):
        rows = st.with_event_time(rows, "ts", "1 hour").withColumn("window_end", F.col("ts")).drop("ts", "s")
        return st.top_items(rows, 3, "m", ["k"])

    def step(n):
        return [(f"{n}-{k}", 600, (7 * k + n) % 100) for k in range(90)]

    _, _, checkpoint = feed("k string, s int, m int", [step(1), step(2)], build)
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "best")
    held = state.option("flattenCollectionTypes", True).load(checkpoint)
    rows = [r.list_element for r in held.collect()]
    want = sorted((-m, k) for n in (1, 2) for k, _, m in step(n))[:3]
    assert sorted((-r.m, r.k) for r in rows) == want


def test_open_windows_complete_a_stream(spark, feed):
    sums = {"cnt": ("count", None), "total": ("sum", "v"), "least": ("min", "v")}

    def build(rows):
        return st.tumbling(st.with_event_time(rows, "ts", "5 seconds"), "ts", "10 seconds", ["k"], sums)

    data = [(k, s, s % 7) for s in range(95) for k in "ab"]
    out, _, checkpoint = feed("k string, s int, v int", [data[:90], data[90:]], build)
    left = st.open_windows(spark, checkpoint, ["k"], sums)
    assert out.count() == 2 * 8 and left.count() == 2 * 2
    want = Counter()
    for k, s, v in data:
        want[k, s // 10] += v
    both = out.unionByName(left).collect()
    assert {(r.k, int((r.window_start - T0).total_seconds()) // 10): r.total for r in both} == dict(want)
    assert sum(r.cnt for r in both) == len(data)


def test_two_streams_give_all_four_outcomes(spark, tmp_path):
    creates = [[(1, 0), (2, 10), (3, 20), (None, 5)], [(5, 4_000)], [(99, 90_000)]]
    pays = [[(1, 60), (3, 1_000)], [(4, 3_000), (5, 3_990)], [(99, 90_000)]]
    for a, b in zip(creates, pays):
        streams = []
        for name, rows in (("c", a), ("p", b)):
            df = spark.createDataFrame(rows, "order_id int, s int").withColumn("ts", ts(F.col("s"))).drop("s")
            df.write.mode("append").parquet(f"{tmp_path}/{name}")
            streams.append(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}"))
        joined = st.order_pairs(*streams, "order_id", "ts", "15 minutes", "1 hour")
        st.drain(joined.writeStream.foreachBatch(st.folder_sink(f"{tmp_path}/out")), f"{tmp_path}/progress")

    def seconds(t):
        return None if t is None else int((t - T0).total_seconds())

    found = [(r.order_id, r.outcome, seconds(r.created), seconds(r.paid)) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(found, key=str) == sorted(
        [
            (1, "paid", 0, 60), (2, "pay_missing", 10, None), (3, "paid_late", 20, 1_000), (4, "create_missing", None, 3_000),
            (5, "paid", 4_000, 3_990), (None, "pay_missing", 5, None), (99, "paid", 90_000, 90_000),
        ],
        key=str,
    )


def test_dropped_rows_are_counted_per_batch(spark, feed):
    def build(rows):
        return st.distinct_rows(rows, "ts", ["id"])

    steps = [[(1, 100), (2, 200)], [(3, 150), (4, 200), (5, 201), (6, 10)]]
    out, query, _ = feed("id int, s int", steps, build)
    report = st.progress_table(spark, query)
    assert report.agg(F.sum("rows_dropped")).first()[0] == 3
    assert sorted(r.id for r in out.collect()) == [1, 2, 5]
    assert report.agg(F.max("watermark")).first()[0] == datetime(2024, 1, 1, 0, 3, 21)
