"""Streaming operators that hold the state of many keys together."""

from collections import Counter
from decimal import Decimal

import pytest

from rillflow import streaming as st
from rillflow.streaming import buckets, panes, stateful
from tests.test_stream_ends import T0, feed  # noqa: F401

KEYS = [None, 2**53, 2**53 + 1, *range(37)]


@pytest.fixture(autouse=True)
def few(monkeypatch):
    monkeypatch.setattr(buckets, "BUCKETS", 4)


def held(spark, checkpoint, name):
    """How many values the state ``name`` has."""
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", name)
    return state.load(checkpoint).count()


def test_late_windows_of_many_keys(spark, feed):  # noqa: F811
    def build(rows):
        return st.late_windows(rows, ["k", "x"], "ts", "10 seconds", "0 seconds", "20 seconds")

    first = [(k, x, s) for k in KEYS for x in (None, float("nan")) for s in (1, 2, 25)]
    late = [(k, x, s) for k in KEYS[:3] for x in (None, float("nan")) for s in (8, 8, 12)]
    out, _, checkpoint = feed("k bigint, x double, s int", [first, late], build)
    assert 0 < held(spark, checkpoint, "windows") <= 4

    def seen(rows):
        return Counter((r.k, str(r.x), r.window_end.second, r.cnt) for r in rows)

    both = [(k, x) for k in KEYS for x in ("None", "nan")]
    fired = Counter((k, x, 10, 2) for k, x in both)
    again = [(10, 3), (10, 4), (20, 1), (20, 1)]  # a window that begins late fires by its row and by its timer
    assert seen(out.collect()) == fired + Counter((k, x, *w) for k, x in both[:6] for w in again)


def test_daily_limit_of_many_keys(spark, feed, monkeypatch):  # noqa: F811
    """More rows than are looked through at a time; nulls, large numbers and what is not a number stay as they are."""
    monkeypatch.setattr(stateful, "_MANY_ROWS", 50)

    def build(rows):
        return st.daily_limit(rows, ["k", "x"], "ts", ["n"], 3)

    schema = "k bigint, x string, n bigint, v double, i int, d decimal(30,2), a array<int>, s int"
    values = [None, float("nan"), 1.5]
    day = 86_400

    def row(k, x, n, s):
        return (k, x, 2**60 + n, values[n % 3], None if n % 2 else n, None if n % 4 else Decimal(f"{n}.00"), [n, None], s)

    both = [(k, x) for k in KEYS for x in (None, "a")]
    # The order within a batch goes by n, not by place or time.
    first = [row(*key, n, day * (1 + d) + 50 - n) for d in range(2) for n in (9, 2, 7, 3) for key in both[:-2]]
    first += [row(*both[-1], n, day * 2 + n % day) for n in range(400)]
    later = [row(*key, 20 + n, day * 2 + 40_000 + n) for n in range(2) for key in [both[0], both[-2]]]
    out, _, checkpoint = feed(schema, [first, later], build)
    assert 0 < held(spark, checkpoint, "days") <= 4
    want, seen = [], Counter()
    for step in (first, later):
        for r in sorted(step, key=lambda r: r[2]):
            place = r[0], r[1], r[-1] // day
            seen[place] += 1
            if seen[place] <= 4:
                want.append((*r, "main" if seen[place] <= 3 else "alert", min(seen[place], 3)))
    assert out.schema["ts"].dataType.simpleString() == "timestamp" and out.schema["i"].dataType.simpleString() == "int"
    found = [(*[r[c] for c in "kxnvidas"], r.tag, r.clicks) for r in out.collect()]
    assert Counter(map(str, found)) == Counter(map(str, want))


def test_orders_of_many_keys(spark, feed):  # noqa: F811
    def build(rows):
        return st.order_outcomes(rows, "ts", "10 seconds", "20 seconds", delay="5 seconds")

    schema = "order_id bigint, event_type string, s int"
    ids = [2**53, 2**53 + 1, *range(37)]
    first = [(k, "create", 1 + (k or 0) % 3) for k in [None, *ids]] + [(ids[5], "pay", 1), (ids[5], None, 9)]
    steps = [
        first + [(k, "pay", 8) for k in [None, *ids[::2]]],
        [(-1, "create", 20)],  # the watermark is at 15: what was created before 5 and not paid is missing
        [(ids[1], "pay", 17), (-2, "create", 30)],
        [(-3, "create", 36)],  # at 31: what is reported is still kept
    ]
    out, _, checkpoint = feed(schema, steps, build)
    assert 0 < held(spark, checkpoint, "pending") <= 4
    want = Counter([(None, "paid", 1, 8)])
    for k in ids:
        at = 1 + k % 3
        if k == ids[5]:
            continue
        if k in ids[::2]:
            want[k, "paid", at, 8] += 1
        else:
            want[k, "pay_missing", at, None] += 1
    want[ids[1], "paid_late", 1 + ids[1] % 3, 17] += 1
    want[-1, "pay_missing", 20, None] += 1

    def second(t):
        return None if t is None else int((t - T0).total_seconds())

    found = [(r.order_id, r.outcome, second(r.created), second(r.paid)) for r in out.collect()]
    own = [f for f in found if f[0] == ids[5]]
    assert Counter(f for f in found if f[0] != ids[5]) == want
    assert Counter(own) == Counter([(ids[5], "paid", 1, 1), (ids[5], "create_missing", None, 9)])


def test_sliding_windows_from_held_panes(spark, feed, monkeypatch):  # noqa: F811
    """The rows that two aggregations give, at the same time, with nothing but panes in the state."""
    monkeypatch.setattr(panes, "_MANY_PANES", 7)

    def build(last):
        def run(rows):
            timed = st.with_event_time(rows, "ts", "10 seconds")
            counts = {"n": ("count", None), "again": ("count", "s")}
            return st.sliding(timed, "ts", "1 minute", "20 seconds", ["k", "x"], counts, last=last)

        return run

    def step(low, high):
        return [(k, x, s) for k in KEYS[:9] for x in (None, "a") for s in range(low + (k or 0) % 5, high, 7)]

    steps = [step(0, 50), step(45, 130), [(1, "a", 131), (None, "b", 300)], [(4, None, 291), (5, "z", 420)]]
    schema = "k bigint, x string, s int"
    out, _, _ = feed(schema, steps, build(True), "held")
    chained, _, _ = feed(schema, steps, build(False), "chained")
    assert out.columns == chained.columns and [f.dataType for f in out.schema] == [f.dataType for f in chained.schema]
    assert out.count() > 100 and Counter(out.collect()) == Counter(chained.collect())
