import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow import sinks
from rillflow.operators import map_partitions, redistribute
from rillflow.sources import parse_sensor
from tests.rows import SENSOR_LINES


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v string, n bigint")


def test_upsert_keeps_last_value_and_survives_replay(spark, tmp_path):
    log = sinks.KeyedUpsert(str(tmp_path / "log"), "k", "v", ["n"])
    log.write(table(spark, ("a", "old", 1), ("a", "new", 2), ("b", "x", 1)), 0)
    second = table(spark, ("a", "newest", 1))
    log.write(second, 1)
    log.write(second, 1)  # the same batch once more
    want = {("a", "newest"), ("b", "x")}
    assert {tuple(r) for r in log.read(spark).collect()} == want

    folded = log.compact(spark, str(tmp_path / "folded"))
    assert {tuple(r) for r in folded.read(spark).collect()} == want
    folded.write(table(spark, ("b", "y", 0)), 2)
    assert {tuple(r) for r in folded.read(spark).collect()} == {("a", "newest"), ("b", "y")}


class FileHash:
    """Stands in for a hash-server client: one file per call."""

    def __init__(self, folder):
        self.folder = folder

    def hset(self, name, field, value):
        with open(f"{self.folder}/{name}.{field}", "w") as f:
            f.write(value)


def test_hash_fields(spark, lines, tmp_path):
    folder = str(tmp_path)
    sink = sinks.HashSink("sensor", "ts", "vc", ["vc"], lambda: FileHash(folder))
    sink.write(parse_sensor(lines(SENSOR_LINES)), 0)
    written = list(tmp_path.glob("sensor.*"))
    assert len(written) == 15
    assert (tmp_path / "sensor.1600262289186").read_text() == "49"


def test_documents(spark, lines, tmp_path):
    sink = sinks.DocumentSink(str(tmp_path / "index"))
    for _ in range(2):  # a replayed batch leaves its documents once
        sink.write(lines(SENSOR_LINES), 0)
    found = spark.read.text(str(tmp_path / "index")).select("value").collect()
    assert Counter(json.loads(r.value)["data"] for r in found) == Counter(SENSOR_LINES)


def test_jdbc_options(spark, monkeypatch):
    calls = []

    class Writer:
        def jdbc(self, url, table, mode, properties):
            calls.append((url, table, mode, properties))

    class Batch:
        write = Writer()

    sinks.JdbcInsert("jdbc:db://host/test", "sensor", {"user": "u"}).write(Batch(), 0)
    assert calls == [("jdbc:db://host/test", "sensor", "append", {"user": "u"})]


def test_kafka_records(spark):
    df = table(spark, ("a", "x", 7))
    assert sinks.kafka_records(df, "n").first().value == "7"
    assert sinks.kafka_records(df, F.concat("k", "v")).first().value == "ax"


def test_show_with_label(spark, capsys):
    sinks.show(table(spark, *[("a", "x", n) for n in range(50)]), "normal")
    assert capsys.readouterr().out.splitlines() == [f"normal> a, x, {n}" for n in range(50)]


def test_latest_per_key(spark):
    df = table(spark, ("a", "x", 1), ("a", "y", 3), ("a", "z", 2))
    assert [tuple(r) for r in sinks.latest_per_key(df, "k", "v", ["n"]).collect()] == [
        ("a", "y")
    ]


def test_map_partitions_sets_up_and_tears_down_each_partition(spark, tmp_path):
    folder = str(tmp_path)

    def set_up():
        import uuid

        path = f"{folder}/{uuid.uuid4().hex}"
        open(path, "w").close()
        return path

    def tear_down(path):
        with open(path, "w") as f:
            f.write("closed")

    def named(resource, task, batch):
        return batch.assign(task=task)

    rows = redistribute(spark.range(100), 4)
    out = map_partitions(rows, set_up, named, "id bigint, task string", tear_down)
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(100))
    assert {r.task for r in got} == {f"partition-{i}" for i in range(4)}
    states = [p.read_text() for p in tmp_path.iterdir()]
    assert states == ["closed"] * 4


@pytest.mark.parametrize("n", [1, 6])
def test_redistribute_keeps_rows(spark, n):
    out = redistribute(spark.range(50).union(spark.range(50)), n)
    assert out.rdd.getNumPartitions() == n
    assert Counter(r.id for r in out.collect()) == Counter({i: 2 for i in range(50)})
