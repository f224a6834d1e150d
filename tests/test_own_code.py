"""Functions, accumulators and window code of one's own against loops over the rows."""

import random
from itertools import groupby

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from rillflow import operators as op
from rillflow.operators import accumulators

SCHEMA = "k string, t bigint, v bigint, part string, open int"


def rows(n, seed=4):
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "hot", None, "a", "b"]), t, rng.randrange(100), f"p{t}", t % 7)
        for t in rng.sample(range(10 * n), n)
    ]


def folded(a, b):
    """A hash that depends on the order: neither sum nor extreme."""
    return ((a[0] * b[1] + b[0]) % 1_000_003, a[1] * b[1] % 1_000_003)


@pytest.mark.parametrize("parts", [1, 3, 13])
def test_running_reduce(spark, parts):
    data = rows(700)
    df = spark.createDataFrame(data, SCHEMA).repartition(4).withColumn("p", F.lit(31).cast("bigint"))
    out = op.running_reduce(df, ["k"], ["t"], ["v", "p"], folded, parts)
    assert out.columns == df.columns
    want, states = [], {}
    for k, t, v, part, opened in sorted(data, key=lambda r: r[1]):
        state = (v, 31) if k not in states else folded(states[k], (v, 31))
        states[k] = state
        want.append((k, t, state[0], part, opened, state[1]))
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_running_reduce_of_nothing_and_of_one_key(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.running_reduce(empty, ["k"], ["t"], ["v"], lambda a, b: (a[0] + b[0],)).collect() == []
    one = spark.range(1_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.lit(1).alias("v"))
    out = op.running_reduce(one, ["k"], ["t"], ["v"], lambda a, b: (a[0] + b[0],), 9)
    assert sorted((r.t, r.v) for r in out.collect()) == [(t, t + 1) for t in range(1_000)]


TWO_LARGEST = op.Accumulator(
    values=["v"],
    state="top array<bigint>",
    returns="gap bigint",
    create=lambda: ([],),
    add=lambda acc, v: (sorted({*acc[0], v}, reverse=True)[:2],),
    merge=lambda a, b: (sorted({*a[0], *b[0]}, reverse=True)[:2],),
    result=lambda acc: (acc[0][0] - acc[0][1] if len(acc[0]) > 1 else None,),
)


@pytest.mark.parametrize("held", [2, 100_000])
def test_accumulate(spark, monkeypatch, held):
    monkeypatch.setattr(accumulators, "HELD", held)
    data = rows(900)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    values = {}
    for k, _, v, *_ in data:
        values.setdefault(k, set()).add(v)
    want = {k: sorted(v)[-1] - sorted(v)[-2] for k, v in values.items()}
    assert {r.k: r.gap for r in op.accumulate(df, ["k"], TWO_LARGEST).collect()} == want
    top = sorted(set().union(*values.values()))
    assert [r.gap for r in op.accumulate(df, [], TWO_LARGEST).collect()] == [top[-1] - top[-2]]
    assert op.accumulate(df.limit(0), ["k"], TWO_LARGEST).collect() == []


def test_partial_accumulators_are_sent(spark):
    df = spark.range(0, 100_000, 1, 4).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = op.accumulate(df, ["k"], TWO_LARGEST)
    assert [tuple(r) for r in out.collect()] == [("hot", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "MapInArrow" in below  # the first stage runs before rows move


def longest_run(key, batches):
    """The longest run of equal values, over batches that are not kept."""
    best = run = 0
    last = None
    for batch in batches:
        for v in batch.column("v").to_pylist():
            run = run + 1 if v == last else 1
            last, best = v, max(best, run)
    yield (best,)


def test_per_window(spark):
    rng = random.Random(2)
    data = [(rng.choice("ab"), t, rng.randrange(3), "", 0) for t in rng.sample(range(4_000), 2_000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5).withColumn("ts", F.timestamp_seconds("t"))
    out = op.per_window(df, "ts", "10 minutes", ["k"], ["t"], longest_run, "longest int")
    want = {}
    for k, t, v, *_ in sorted(data, key=lambda r: r[1]):
        want.setdefault((k, t // 600 * 600), []).append(v)
    want = {k: max(len(list(g)) for _, g in groupby(v)) for k, v in want.items()}
    found = {(r.k, int(r.window_start.timestamp())): r.longest for r in out.collect()}
    assert found == want


def test_a_window_of_a_million_rows_is_handed_over_in_batches(spark):
    df = spark.range(1_000_000).select(
        (F.col("id") % 1_000 < 700).cast("int").alias("v"), "id", F.timestamp_seconds(F.lit(5)).alias("ts")
    )

    def sizes(key, batches):
        n = largest = 0
        for batch in batches:
            n, largest = n + batch.num_rows, max(largest, batch.num_rows)
        yield n, largest

    row = op.per_window(df, "ts", "1 hour", [], ["id"], sizes, "n int, largest int").first()
    assert row.n == 1_000_000 and row.largest <= 20_000
    assert op.per_window(df, "ts", "1 hour", [], ["id"], longest_run, "n int").first().n == 700


def test_code_may_leave_rows_unread(spark):
    df = spark.range(5_000).select((F.col("id") % 7).alias("k"), "id", F.timestamp_seconds("id").alias("ts"))

    def first(key, batches):
        yield (pc.min(next(batches).column("id")).as_py(),)

    out = op.per_window(df, "ts", "1 day", ["k"], ["id"], first, "least bigint")
    assert sorted((r.k, r.least) for r in out.collect()) == [(k, k) for k in range(7)]
