"""Cut keys give the same rows as whole ones, and as a loop over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from rillflow import operators as op
from rillflow.operators import skew
from rillflow.operators.skew import Limits

CUT = Limits(rows_per_task=40)
SCHEMA = "k string, t bigint, id bigint, v int"


def events(seed, n=600, step=3, ties=True):
    """A third of the rows has one key; another key is null."""
    rng = random.Random(seed)
    t, out = 0, []
    for i in range(n):
        t += rng.randrange(0 if ties else 1, step)
        k = "hot" if rng.random() < 0.4 else rng.choice([None, None, "a", "b", "c"])
        out.append((k, t, i, rng.randrange(-3, 12)))
    return out


def by_key(data):
    keys = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        keys.setdefault(row[0], []).append(row)
    return keys


def frame(spark, data):
    data = list(data)
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("limits", [skew.DEFAULT, CUT])
def test_running_columns(spark, limits):
    data = events(3)
    columns = {
        "total": skew.running_sum("v"),
        "before": skew.running_sum("v", inclusive=False),
        "high": skew.running_count(F.col("v") > 5),
        "most": skew.running_max("v"),
        "least": skew.running_min("v", inclusive=False),
        "first": skew.first_value("id"),
        "prev": skew.previous("v"),
        "next": skew.following("v"),
    }
    out = skew.with_running(frame(spark, data), ["k"], ["t", "id"], columns, limits)
    got = {r.id: tuple(r[c] for c in columns) for r in out.collect()}
    want = {}
    for rows in by_key(data).values():
        vs = [r[3] for r in rows]
        for i, r in enumerate(rows):
            want[r[2]] = (
                sum(vs[: i + 1]),
                sum(vs[:i]) if i else None,
                sum(v > 5 for v in vs[: i + 1]),
                max(vs[: i + 1]),
                min(vs[:i]) if i else None,
                rows[0][2],
                vs[i - 1] if i else None,
                vs[i + 1] if i + 1 < len(vs) else None,
            )
    assert got == want


def test_no_group_stays_hot(spark):
    data = events(5, n=2000)
    parts = skew.cut(frame(spark, data), ["k"], ["t", "id"], CUT)
    assert parts.split
    sizes = parts.df.groupBy(*parts.group).count()
    assert sizes.agg(F.max("count")).first()[0] <= 5 * CUT.rows_per_task
    hot = sizes.where("k = 'hot'")
    assert hot.count() >= 10


def test_equal_first_order_column_is_still_cut(spark):
    data = [("hot", 7, i, 1) for i in range(1000)]
    parts = skew.cut(frame(spark, data), ["k"], ["t", "id"], CUT)
    assert parts.df.groupBy(*parts.group).count().count() >= 10


def test_small_input_is_not_cut(spark):
    parts = skew.cut(frame(spark, events(2)), ["k"], ["t", "id"])
    assert not parts.split
    assert parts.group == ["k"]


@pytest.mark.parametrize("limits", [skew.DEFAULT, CUT])
def test_without_keys_all_rows_are_one_group(spark, limits):
    data = events(21)
    columns = {"total": skew.running_sum("v"), "prev": skew.previous("id")}
    out = skew.with_running(frame(spark, data), [], ["t", "id"], columns, limits)
    got = {r.id: (r.total, r.prev) for r in out.collect()}
    total, prev, want = 0, None, {}
    for _, _, i, v in data:
        total += v
        want[i] = (total, prev)
        prev = i
    assert got == want
    windows = op.count_window(
        frame(spark, data), [], ["t", "id"], 100, None, {"v": ("sum", "v")}, limits
    )
    assert sorted((r.seen, r.v) for r in windows.collect()) == [
        (n, sum(r[3] for r in data[n - 100 : n])) for n in range(100, 601, 100)
    ]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [["k"], []])
def test_parts_are_joined_by_hash(spark, keys):
    columns = {"total": skew.running_sum("v")}
    out = skew.with_running(frame(spark, events(3)), keys, ["t", "id"], columns, CUT)
    text = plan(out)
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_copies_into_windows_are_not_shuffled(spark):
    timed = frame(spark, events(3)).withColumn("ts", F.timestamp_seconds("t"))
    text = plan(op.sliding(timed, "ts", "60 seconds", "5 seconds", ["k"]))
    above_copies = text.split("Generate explode(sequence")[0]
    assert "Exchange" not in above_copies


def test_top_n_and_blacklist_limit_groups_before_the_shuffle(spark):
    timed = frame(spark, events(3)).withColumn("ts", F.timestamp_seconds("t"))
    top = op.top_n(op.tumbling(timed, "ts", "5 seconds", ["k"]), 3, "cnt", ["k"])
    passed = op.blacklist_pass(timed, ["k"], "ts", ["id"], 5)
    for df in (top, passed):
        assert "row_number(), " in plan(df).split("Exchange")[1]


def brute_rising(rows, hold, start=0):
    last, due, out = start, None, []
    for _, t, _, v in rows:
        if due is not None and t > due:
            out.append((due, last))
            due = None
        if v <= last:
            due = None
        elif due is None:
            due = t + hold
        last = v
    if due is not None:
        out.append((due, last))
    return out


@pytest.mark.parametrize("climbing", [False, True])
@pytest.mark.parametrize(
    ("limits", "segment_rows"),
    [(skew.DEFAULT, 65_536), (CUT, 65_536), (CUT, 7), (skew.DEFAULT, 11)],
)
def test_rising_alerts(spark, climbing, limits, segment_rows):
    data = events(11)
    if climbing:  # one climb of a whole key, cut into many segments
        data = [(k, t, i, i if k == "hot" else v) for k, t, i, v in data]
    out = op.rising_alerts(
        frame(spark, data), "k", "t", "v", 9, ["t", "id"],
        limits=limits, segment_rows=segment_rows,
    )
    got = sorted((r.k or "", r.deadline, r.level) for r in out.collect())
    want = sorted(
        (k or "", due, level)
        for k, rows in by_key(data).items()
        for due, level in brute_rising(rows, 9)
    )
    assert got == want
    assert len(got) > 5


def brute_orders(rows):
    pending, out = None, []
    for _, t, _, v in rows:
        create = v % 2 == 0
        if pending is None:
            pending = (create, t)
            continue
        if pending[0] != create:
            c, p = (t, pending[1]) if create else (pending[1], t)
            out.append(("paid_late" if p - c > 2 else "paid", c, p))
            pending = None
            continue
        out.append(_alone(pending))
        pending = (create, t)
    return out + ([_alone(pending)] if pending else [])


def _alone(pending):
    create, t = pending
    return ("pay_missing", t, None) if create else ("create_missing", None, t)


@pytest.mark.parametrize("limits", [skew.DEFAULT, CUT])
def test_order_outcomes(spark, limits):
    data = events(8)
    log = frame(spark, data).withColumn(
        "kind", F.when(F.col("v") % 2 == 0, "create").otherwise("pay")
    )
    out = op.order_outcomes(log, ["t", "id"], "k", "kind", "t", 2, limits)

    def shown(k, outcome, created, paid):
        return (k or "", outcome, -1 if created is None else created, paid or -1)

    got = sorted(shown(*r) for r in out.collect())
    want = sorted(
        shown(k, *o) for k, rows in by_key(data).items() for o in brute_orders(rows)
    )
    assert got == want


@pytest.mark.parametrize("limits", [skew.DEFAULT, CUT])
@pytest.mark.parametrize(("size", "slide"), [(3, None), (3, 2), (5, 1), (2, 4)])
def test_count_windows(spark, limits, size, slide):
    data = events(6)
    out = op.count_window(
        frame(spark, data), ["k"], ["t", "id"], size, slide,
        {"v": ("sum", "v"), "n": ("count", None)}, limits,
    )
    got = sorted((r.k or "", r.seen, r.v, r.n) for r in out.collect())
    want = []
    for k, rows in by_key(data).items():
        vs = [r[3] for r in rows]
        for seen in range(slide or size, len(vs) + 1, slide or size):
            last = vs[max(0, seen - size) : seen]
            want.append((k or "", seen, sum(last), len(last)))
    assert got == sorted(want)


@pytest.mark.parametrize("limits", [skew.DEFAULT, CUT])
def test_sessions(spark, limits):
    data = events(9, step=9)
    timed = frame(spark, data).withColumn("ts", F.timestamp_seconds("t"))
    out = op.session(timed, "ts", "5 seconds", ["k"], limits=limits)
    got = sorted(
        (r.k or "", r.s, r.e, r.cnt)
        for r in out.withColumns(
            {"s": F.unix_seconds("window_start"), "e": F.unix_seconds("window_end")}
        ).collect()
    )
    want = []
    for k, rows in by_key(data).items():
        ts = [r[1] for r in rows]
        start, n = ts[0], 0
        for i, t in enumerate(ts):
            if i and t > ts[i - 1] + 5:
                want.append((k or "", start, ts[i - 1] + 5, n))
                start, n = t, 0
            n += 1
        want.append((k or "", start, ts[-1] + 5, n))
    assert got == sorted(want)


@pytest.mark.parametrize(
    ("size", "slide"), [("12 seconds", "4 seconds"), ("9 seconds", "4 seconds")]
)
def test_sliding_equals_direct_windows(spark, size, slide):
    timed = frame(spark, events(4)).withColumn("ts", F.timestamp_seconds("t"))
    aggregates = {
        "n": ("count", None), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
    }
    got = op.sliding(timed, "ts", size, slide, ["k"], aggregates)
    want = (
        timed.groupBy("k", F.window("ts", size, slide).alias("w"))
        .agg(
            F.count("*").alias("n"),
            F.sum("v").alias("s"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
        )
        .select("k", "w.start", "w.end", "n", "s", "lo", "hi")
    )
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()
    assert want.exceptAll(got).isEmpty()


def test_results_do_not_depend_on_row_or_partition_order(spark):
    data = events(13)
    results = []
    for seed, partitions in ((1, 1), (2, 7)):
        shuffled = list(data)
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, SCHEMA).repartition(partitions)
        out = op.rolling_max(df, ["k"], ["t", "id"], "v", CUT)
        results.append(sorted((r.k or "", r.t, r.id, r.v) for r in out.collect()))
    assert results[0] == results[1]
