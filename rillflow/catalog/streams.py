"""Streaming queries on the supplied tables.

A table is fed as files in two halves, followed by one marker row far in the
future that moves the watermark past all real rows. The query stops after each
step and goes on from its checkpoint, so every run is also a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow import streaming as st
from rillflow.catalog import tables as tb
from rillflow.catalog.queries import Query
from rillflow.functions.text import tokens
from rillflow.operators.checkpoints import run_folder
from rillflow.operators.transforms import side_output
from rillflow.operators.windows import distinct_estimate
from rillflow.sinks import KeyedUpsert, fan_out
from rillflow.sinks.writers import Writer
from rillflow.streaming.stateful import keep_max, keep_sum

STREAMS: dict[str, Query] = {}

MARKER_TIME = "2100-01-01 00:00:00"


def query(run: Query) -> Query:
    STREAMS[run.__name__] = run
    return run


def _halves(df: DataFrame, order: str) -> list[DataFrame]:
    low, high = df.agg(F.min(order), F.max(order)).first()
    middle = low + (high - low) / 2
    return [df.where(F.col(order) <= middle), df.where(F.col(order) > middle)]


def _marker(df: DataFrame, ts: str, **others) -> DataFrame:
    """One row with an event time and nulls."""
    values = {ts: MARKER_TIME, **others}
    return df.sparkSession.range(1).select(
        *[
            F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _feed(
    steps: list[DataFrame],
    build: Callable[[DataFrame], DataFrame],
    mode: str = "append",
    writer: Callable[[str], Writer] = st.folder_sink,
) -> str:
    """Run a stream over the steps, one after the other; gives the output folder.

    The number of state partitions is fixed by a stream's first run: one per core.
    """
    spark = steps[0].sparkSession
    folder = run_folder(spark, "stream")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    try:
        for step in steps:
            step.write.mode("append").parquet(f"{folder}/in")
            rows = spark.readStream.schema(steps[0].schema).parquet(f"{folder}/in")
            write = build(rows).writeStream.outputMode(mode)
            st.drain(write.foreachBatch(writer(f"{folder}/out")), f"{folder}/progress")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return f"{folder}/out"


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Back to the zone-less timestamps of the tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _timed_steps(df: DataFrame, ts: str = "ts", **others) -> list[DataFrame]:
    return [*_halves(df, ts), _marker(df, ts, **others)]


@query
def stream_word_count(spark, folder):
    def build(rows):
        words = rows.select(F.explode(tokens("value")).alias("word"))
        return st.running_totals(words, ["word"])

    lines = tb.table(spark, folder, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("value")
    )

    def table(path):
        return KeyedUpsert(path, "word", "cnt", ["cnt"])

    out = _feed(
        _halves(lines, "doc_id"), build, "update", lambda path: table(path).write
    )
    return table(out).read(spark)


@query
def stream_tumbling(spark, folder):
    def build(rows):
        timed = st.with_event_time(rows, "ts", "10 minutes")
        return st.tumbling(timed, "ts", "1 hour", ["event_type"])

    rows = tb.events(spark, folder).select("ts", "event_type")
    return _zoneless(
        _read(spark, _feed(_timed_steps(rows), build)), "window_start", "window_end"
    )


@query
def stream_sessions(spark, folder):
    def build(rows):
        timed = st.with_event_time(rows, "ts")
        return st.session(timed, "ts", "3 hours", ["user_id"])

    rows = tb.events(spark, folder).select("ts", "user_id")
    out = _read(spark, _feed(_timed_steps(rows), build))
    return _zoneless(out, "window_start", "window_end")


@query
def stream_hot_by_user(spark, folder):
    keys = ["user_id", "event_type"]

    def build(rows):
        timed = st.with_event_time(rows, "ts")
        return st.sliding(timed, "ts", "1 hour", "5 minutes", keys, last=True)

    def ranked(path):
        return st.top_n_sink(st.folder_sink(path), 3, "cnt", keys)

    rows = tb.events(spark, folder).select("ts", *keys)
    out = _read(spark, _feed(_timed_steps(rows), build, writer=ranked))
    return _zoneless(out, "window_end").select("window_end", "rk", *keys, "cnt")


def _ranked(keys):
    return lambda path: st.top_n_sink(st.folder_sink(path), 3, "cnt", keys)


@query
def stream_hot_items(spark, folder):
    def build(rows):
        timed = st.with_event_time(rows, "ts")
        return st.sliding(timed, "ts", "1 hour", "5 minutes", ["user_id"])

    rows = tb.events(spark, folder).where(F.col("event_type") == "view")
    steps = _timed_steps(rows.select("ts", "user_id"))
    out = _read(spark, _feed(steps, build, writer=_ranked(["user_id"])))
    return _zoneless(out, "window_end").select("window_end", "rk", "user_id", "cnt")


@query
def stream_hot_pages(spark, folder):
    def build(rows):
        timed = st.with_event_time(rows, "ts", "1 minute")
        return st.sliding(timed, "ts", "10 minutes", "5 seconds", ["event_type"])

    steps = _timed_steps(tb.events(spark, folder).select("ts", "event_type"))
    out = _read(spark, _feed(steps, build, writer=_ranked(["event_type"])))
    return _zoneless(out, "window_end").select("window_end", "rk", "event_type", "cnt")


@query
def stream_blacklist_hot_ads(spark, folder):
    keys = ["user_id", "event_type"]

    def build(rows):
        tagged = st.daily_limit(rows, keys, "ts", ["event_id"], 2)
        passed = tagged.where(F.col("tag") == "main")
        return st.sliding(passed, "ts", "1 hour", "5 minutes", keys, last=True)

    rows = tb.events(spark, folder).select("event_id", "ts", *keys)
    out = _read(spark, _feed(_timed_steps(rows), build, writer=_ranked(keys)))
    return _zoneless(out, "window_end").select("window_end", "rk", *keys, "cnt")


@query
def stream_rolling_sum(spark, folder):
    def build(rows):
        return st.rolling_reduce(rows, ["user_id"], ["event_id"], keep_sum("cents"))

    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    out = _read(spark, _feed(_halves(rows, "event_id"), build))
    return out.select("user_id", "cents")


@query
def stream_rolling_max(spark, folder):
    def build(rows):
        return st.rolling_reduce(rows, ["user_id"], ["event_id"], keep_max("value"))

    rows = tb.events(spark, folder).select("user_id", "event_id", "value")
    out = _read(spark, _feed(_halves(rows, "event_id"), build))
    return out.withColumnRenamed("event_id", "first_event_id")


@query
def stream_count_window(spark, folder):
    def build(rows):
        return st.count_window(rows, ["user_id"], ["event_id"], "cents", 3, 2)

    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    return _read(spark, _feed(_halves(rows, "event_id"), build))


@query
def stream_blacklist(spark, folder):
    def build(rows):
        keys = ["user_id", "event_type"]
        return st.daily_limit(rows, keys, "ts", ["event_id"], 2)

    rows = tb.events(spark, folder).select("event_id", "ts", "user_id", "event_type")
    out = _read(spark, _feed(_timed_steps(rows), build))
    return _zoneless(out.where(F.col("ts") < F.lit(MARKER_TIME)), "ts")


def _shuffled_steps(df: DataFrame, seconds: int, **others) -> list[DataFrame]:
    """Four steps in which rows come up to ``seconds`` out of order.

    A row's step goes by its time plus a delay of its own, so that rows next to
    each other in time are parted around each boundary.
    """
    low, high = df.agg(F.min("ts"), F.max("ts")).first()
    late = F.pmod(F.xxhash64("ts"), F.lit(seconds))
    arrival = F.col("ts") + F.make_dt_interval(secs=late)
    steps = []
    for k in range(4):
        begin, end = (low + (high - low) * share / 4 for share in (k, k + 1))
        inside = F.lit(True) if k == 0 else arrival > begin
        steps.append(df.where(inside if k == 3 else inside & (arrival <= end)))
    return [*steps, _marker(df, "ts", **others)]


@query
def stream_login_fail(spark, folder):
    def build(rows):
        failed = F.col("event_type") == "error"
        return st.repeated_failures(rows, "user_id", "ts", failed, "1 hour", "1 day")

    rows = tb.events(spark, folder).select("ts", "user_id", "event_type")
    out = _read(spark, _feed(_shuffled_steps(rows, 86_400, event_type="error"), build))
    return _zoneless(out, "previous_ts", "ts")


@query
def stream_rising_alert(spark, folder):
    def build(rows):
        return st.rising_alerts(rows, "user_id", "ts", "value", "6 hours", delay="1 day")

    rows = tb.events(spark, folder).select("ts", "user_id", "value")
    steps = _shuffled_steps(rows, 86_400, value=0)
    out = _read(spark, _feed(steps, build))
    return _zoneless(out, "deadline")


@query
def stream_order_outcome(spark, folder):
    """Outcomes, and the early reports of partners that come after the limit."""

    def build(rows):
        return st.order_outcomes(rows, "ts", "30 days", "3650 days")

    log = tb.order_log(spark, folder).withColumn(
        "ts", F.timestamp_seconds(F.col("event_time") * 86_400)
    )
    out = _read(spark, _feed(_timed_steps(log), build))
    day = 86_400
    return out.select(
        "order_id",
        "outcome",
        F.floor(F.unix_seconds("created") / day).alias("created"),
        F.floor(F.unix_seconds("paid") / day).alias("paid"),
    )


@query
def stream_late_windows(spark, folder):
    """Windows that fire at their end and again for each row up to a day late."""

    def build(rows):
        return st.late_windows(rows, ["event_type"], "ts", "1 hour", "0 seconds", "1 day")

    rows = tb.events(spark, folder).select("ts", "event_type")
    out = _read(spark, _feed(_shuffled_steps(rows, 86_400), build))
    last = out.groupBy("event_type", "window_end").agg(F.max("cnt").alias("cnt"))
    return _zoneless(last, "window_end")


@query
def stream_side_output(spark, folder):
    """Rows over a threshold go to a folder of their own as well."""

    def build(rows):
        return side_output(rows, F.col("value") > 300, "alarm")

    def split(path):
        parts = {None: st.folder_sink(f"{path}/main"), "alarm": st.folder_sink(f"{path}/alarm")}
        return fan_out(parts)

    rows = tb.events(spark, folder).select("event_id", "value")
    path = _feed(_halves(rows, "event_id"), build, writer=split)
    main = _read(spark, f"{path}/main").select("event_id", "value")
    alarm = _read(spark, f"{path}/alarm").select("event_id", "value")
    tag = F.lit(None).cast("string")
    return main.withColumn("tag", tag).union(alarm.withColumn("tag", F.lit("alarm")))


@query
def stream_first_timer(spark, folder):
    def build(rows):
        return st.first_timer(rows, ["user_id"], "ts", "5 seconds", "1 day")

    rows = tb.events(spark, folder).select("ts", "user_id")
    out = _read(spark, _feed(_shuffled_steps(rows, 86_400), build))
    return _zoneless(out, "fires_at")


@query
def stream_top_items(spark, folder):
    """The ranking as a stream, which a folder sink writes like any other."""

    def build(rows):
        timed = st.with_event_time(rows, "ts")
        counts = st.sliding(timed, "ts", "1 hour", "5 minutes", ["user_id"])
        return st.top_items(counts, 3, "cnt", ["user_id"])

    rows = tb.events(spark, folder).where(F.col("event_type") == "view")
    out = _read(spark, _feed(_timed_steps(rows.select("ts", "user_id")), build))
    return _zoneless(out, "window_end").select("window_end", "rk", "user_id", "cnt")


@query
def stream_closed_windows(spark, folder):
    """All windows of a stream that ended: those written, and those still open in its state. No marker row is fed."""
    sums = {"cnt": ("count", None), "cents": ("sum", "cents"), "most": ("max", "cents")}

    def build(rows):
        timed = st.with_event_time(rows, "ts", "10 minutes")
        return st.tumbling(timed, "ts", "1 day", ["event_type"], sums)

    rows = tb.events(spark, folder).select("ts", "event_type", tb.cents())
    out = _feed(_halves(rows, "ts"), build)
    left = st.open_windows(spark, f"{out.removesuffix('/out')}/progress", ["event_type"], sums)
    written = _read(spark, out)
    return _zoneless(written.unionByName(left), "window_start", "window_end")


@query
def stream_uv_sliding(spark, folder):
    """Visitors of each sliding hour of a stream, from sketches."""

    def build(rows):
        timed = st.with_event_time(rows, "ts")
        return st.sliding(timed, "ts", "1 hour", "5 minutes", (), {"uv": distinct_estimate("user_id")})

    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    out = _read(spark, _feed(_timed_steps(views.select("ts", "user_id")), build))
    return _zoneless(out, "window_start", "window_end")


@query
def stream_order_pairs(spark, folder):
    """Creates and pays as two streams, joined within a time bound."""
    log = tb.order_log(spark, folder).withColumn("ts", F.timestamp_seconds(F.col("event_time") * 86_400))
    log = log.select("order_id", "event_type", "ts")
    sides = [_timed_steps(log.where(F.col("event_type") == kind).drop("event_type")) for kind in ("create", "pay")]
    path = run_folder(spark, "stream")
    for steps in zip(*sides):
        streams = []
        for k, step in enumerate(steps):
            step.write.mode("append").parquet(f"{path}/in{k}")
            streams.append(spark.readStream.schema(step.schema).parquet(f"{path}/in{k}"))
        joined = st.order_pairs(*streams, "order_id", "ts", "30 days", "3650 days")
        st.drain(joined.writeStream.foreachBatch(st.folder_sink(f"{path}/out")), f"{path}/progress")
    day = 86_400
    # The marker rows have no key.
    return _read(spark, f"{path}/out").where("order_id is not null").select(
        "order_id",
        "outcome",
        F.floor(F.unix_seconds("created") / day).alias("created"),
        F.floor(F.unix_seconds("paid") / day).alias("paid"),
    )


@query
def stream_dropped_rows(spark, folder):
    """How many rows a stream drops when the later half of the events comes first, and what the watermark is then."""
    rows = tb.events(spark, folder).select("ts", "event_id")
    path = run_folder(spark, "stream")
    found = None
    for step in reversed(_halves(rows, "ts")):
        step.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(step.schema).parquet(f"{path}/in")
        stream = st.distinct_rows(stream, "ts", ["event_id"])
        query = st.drain(stream.writeStream.foreachBatch(st.folder_sink(f"{path}/out")), f"{path}/progress")
        report = st.progress_table(spark, query)
        found = report if found is None else found.union(report)
    kept = _read(spark, f"{path}/out").agg(F.count(F.lit(1)).alias("rows_kept"))
    dropped = found.agg(F.sum("rows_dropped").alias("rows_dropped"), F.max("watermark").alias("watermark"))
    return _zoneless(kept.join(dropped, F.lit(True)), "watermark")
