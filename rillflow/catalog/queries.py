"""Batch queries on the supplied tables, one per operator or job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow import operators as op
from rillflow import sources as src
from rillflow.catalog import tables as tb
from rillflow.functions import Rule, window_start
from rillflow.plans import visitors_per_window
from rillflow.sinks import kafka_records, latest_per_key, to_documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- jobs: counts ---------------------------------------------------------------


@query
def word_count(spark, folder):
    words = op.words(tb.document_lines(spark, folder))
    return words.groupBy("word").agg(F.sum("one").alias("cnt"))


@query
def pv_total(spark, folder):
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    return views.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@query
def pv_running(spark, folder):
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    views = views.select("event_type", "event_id")
    return op.rolling_count(views, ["event_type"], ["event_id"])


@query
def uv_exact(spark, folder):
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    return views.agg(F.countDistinct("user_id").alias("uv"))


@query
def uv_approx(spark, folder):
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    error = 0.05
    exact = F.countDistinct("user_id")
    about = F.approx_count_distinct("user_id", error)
    # Three standard errors; the estimate itself depends on the hash.
    close = F.abs(about - exact) <= 3 * error * exact
    return views.agg(exact.alias("uv"), close.alias("within_bound"))


# --- row-wise operators ---------------------------------------------------------


@query
def project_map(spark, folder):
    return op.project(
        tb.events(spark, folder),
        event_id=F.col("event_id"),
        kind=F.upper("event_type"),
        one=F.lit(1),
    )


@query
def even_filter(spark, folder):
    return tb.events(spark, folder).where(F.col("event_id") % 2 == 0).select("event_id")


@query
def flatmap_filter(spark, folder):
    return op.keep_and_map(
        tb.events(spark, folder),
        F.col("event_type") == "view",
        event_id=F.col("event_id"),
        one=F.lit(1),
    )


@query
def explode_list(spark, folder):
    vectors = tb.table(spark, folder, "embeddings").select("vec_id", "embedding")
    return op.unnest(vectors, "embedding", "x")


@query
def key_repartition(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "user_id")
    return op.partition_by(rows, "user_id")


@query
def random_repartition(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "user_id")
    return op.redistribute(rows, spark.sparkContext.defaultParallelism)


@query
def partition_map(spark, folder):
    def tripled(factor, task, batch):
        return batch.assign(tripled=batch["event_id"] * factor)

    rows = tb.events(spark, folder).select("event_id")
    return op.map_partitions(
        rows, lambda: 3, tripled, "event_id bigint, tripled bigint"
    )


@query
def level_labels(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "value")
    labelled = op.label(rows, op.level_cases("value", 50, 80))
    return labelled.select("event_id", F.col("labels")[0].alias("label"))


@query
def split_select(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "value")
    labelled = op.label(rows, op.level_cases("value", 50, 80))
    return op.select_label(labelled, "warn").select("event_id", "value")


@query
def multi_label_split(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "value")
    cases = [("low", F.col("value") < 80), ("mid", F.col("value").between(50, 200))]
    labelled = op.label(rows, cases, otherwise="rest", first_only=False)
    return labelled.select("event_id", F.concat_ws("+", "labels").alias("labels"))


@query
def union_x10(spark, folder):
    ids = tb.events(spark, folder)
    streams = [
        ids.where(F.col("event_type") == kind).select("event_id")
        for kind in ("view", "click", "error", "signup", "purchase", "view")
    ]
    return op.project(op.union(*streams), x10=F.col("event_id") * 10)


@query
def connect_map(spark, folder):
    rows = tb.events(spark, folder)
    nations = tb.table(spark, folder, "nation")
    return op.connect(
        rows,
        nations,
        F.concat_ws("/", F.col("event_id").cast("string"), "event_type"),
        F.col("n_nationkey") + 10,
    )


@query
def key_process(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", "event_type")
    return op.describe_keyed(rows, "user_id")


@query
def threshold_alarm(spark, folder):
    rows = tb.events(spark, folder).select("event_id", "value")
    return op.side_output(rows, F.col("value") > 300, "alarm")


@query
def pattern_match(spark, folder):
    kind, value = F.col("event_type"), F.col("value")
    rule = (
        Rule("start").where(kind == "purchase").where(value >= 50).or_(kind == "view")
    )
    rows = tb.events(spark, folder).select("event_id", "event_type", "value")
    matched = rule.matches(rows)
    event = F.col("match")["start"][0]
    return matched.select(
        event["event_id"].alias("event_id"), event["event_type"].alias("event_type")
    )


# --- parsers --------------------------------------------------------------------


@query
def parse_sensor_lines(spark, folder):
    return src.parse_sensor(tb.sensor_lines(spark, folder))


@query
def parse_behavior_lines(spark, folder):
    return src.parse_user_behavior(tb.behavior_lines(spark, folder))


@query
def parse_ad_click_lines(spark, folder):
    return src.parse_ad_click(tb.ad_click_lines(spark, folder))


@query
def parse_login_lines(spark, folder):
    return src.parse_login(tb.login_lines(spark, folder))


@query
def parse_order_lines(spark, folder):
    return src.parse_order(tb.order_lines(spark, folder))


@query
def parse_access_log_lines(spark, folder):
    parsed = src.parse_access_log(tb.access_log_lines(spark, folder))
    return parsed.withColumn("event_time", F.unix_seconds("event_time"))


# --- rolling aggregates ---------------------------------------------------------


@query
def rolling_sum(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    return op.rolling_sum(rows, ["user_id"], ["event_id"], "cents").drop("cents")


@query
def rolling_sum_one_type(spark, folder):
    rows = tb.events(spark, folder).select("event_type", "event_id", tb.cents())
    out = op.rolling_sum(rows, ["event_type"], ["event_id"], "cents")
    return out.drop("cents")


@query
def rolling_count(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id")
    return op.rolling_count(rows, ["user_id"], ["event_id"])


@query
def rolling_max(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", "value")
    out = op.rolling_max(rows, ["user_id"], ["event_id"], "value")
    return out.withColumnRenamed("event_id", "first_event_id")


@query
def rolling_reduce(spark, folder):
    rows = tb.events(spark, folder).select(
        "user_id", "event_id", "event_type", tb.cents()
    )
    return op.rolling_reduce(
        rows, ["user_id"], ["event_id"], "cents", {"event_type": "reduced"}
    )


@query
def rolling_own_reduce(spark, folder):
    """A checksum of each type's amounts so far, which depends on their order: multiply by a base and add."""
    modulus = 1_000_003

    def folded(left, right):
        (total, power), (value, base) = left, right
        return ((total * base + value) % modulus, power * base % modulus)

    rows = tb.events(spark, folder).select("event_type", "event_id", tb.cents())
    rows = rows.select(
        "event_type",
        "event_id",
        F.pmod("cents", F.lit(modulus)).alias("checksum"),
        F.lit(31).cast("bigint").alias("power"),
    )
    out = op.running_reduce(rows, ["event_type"], ["event_id"], ["checksum", "power"], folded)
    return out.drop("power")


@query
def own_accumulator(spark, folder):
    """The gap between the two largest different amounts of a type and day: an accumulator in code."""
    largest = op.Accumulator(
        values=["cents"],
        state="top array<bigint>",
        returns="gap bigint",
        create=lambda: ([],),
        add=lambda acc, v: (sorted({*acc[0], v}, reverse=True)[:2],),
        merge=lambda a, b: (sorted({*a[0], *b[0]}, reverse=True)[:2],),
        result=lambda acc: (acc[0][0] - acc[0][1] if len(acc[0]) == 2 else None,),
    )
    rows = tb.events(spark, folder).select("event_type", F.to_date("ts").alias("day"), tb.cents())
    return op.accumulate(rows, ["event_type", "day"], largest)


# --- windows --------------------------------------------------------------------


@query
def uv_sliding(spark, folder):
    """Visitors of each sliding hour, from sketches."""
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    return visitors_per_window(views.select("ts", "user_id"), "ts", "1 hour", "5 minutes")


@query
def longest_run(spark, folder):
    """The longest run of events of one type in a day, and its type: code over all rows of a window."""

    def run(key, batches):
        best = length = 0
        last = kind = None
        for batch in batches:
            for event_type in batch.column("event_type").to_pylist():
                length = length + 1 if event_type == last else 1
                last = event_type
                if length > best:
                    best, kind = length, event_type
        yield best, kind

    rows = tb.events(spark, folder).select("ts", "event_id", "event_type")
    return op.per_window(rows, "ts", "1 day", [], ["ts", "event_id"], run, "longest int, event_type string")


@query
def tumbling_count(spark, folder):
    return op.tumbling(tb.events(spark, folder), "ts", "1 day", ["user_id"])


@query
def tumbling_sum(spark, folder):
    rows = tb.events(spark, folder).select("ts", "event_type", tb.cents())
    sums = {"cents": ("sum", "cents"), "most": ("max", "cents")}
    return op.tumbling(rows, "ts", "1 hour", ["event_type"], sums)


@query
def window_all(spark, folder):
    return op.tumbling(tb.events(spark, folder), "ts", "1 hour")


@query
def window_start_rule(spark, folder):
    rows = tb.events(spark, folder).select("event_id")
    return rows.withColumn("window_start", window_start("event_id", 7))


@query
def sliding_counts(spark, folder):
    rows = tb.events(spark, folder)
    return op.sliding(rows, "ts", "1 hour", "5 minutes", ["event_type"])


@query
def sliding_uneven(spark, folder):
    rows = tb.events(spark, folder)
    return op.sliding(rows, "ts", "50 minutes", "20 minutes", ["event_type"])


@query
def sliding_mean(spark, folder):
    """An aggregate in parts: sums and counts per pane, divided at the end."""
    rows = tb.events(spark, folder).select("ts", "event_type", tb.cents())

    def added(both):
        return F.struct(F.sum(both["total"]).alias("total"), F.sum(both["n"]).alias("n"))

    mean = op.OwnAggregate(
        F.struct(F.sum("cents").alias("total"), F.count("cents").alias("n")),
        added,
        lambda both: both["total"] / both["n"],
    )
    return op.sliding(rows, "ts", "1 hour", "5 minutes", ["event_type"], {"mean": mean})


@query
def session_counts(spark, folder):
    return op.session(tb.events(spark, folder), "ts", "3 hours", ["user_id"])


@query
def session_one_type(spark, folder):
    rows = tb.events(spark, folder)
    return op.session(rows, "ts", "30 minutes", ["event_type"])


@query
def count_window_tumbling(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    sums = {"cents": ("sum", "cents")}
    return op.count_window(rows, ["user_id"], ["event_id"], 3, aggregates=sums)


@query
def count_window_sliding(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    sums = {"cents": ("sum", "cents")}
    return op.count_window(rows, ["user_id"], ["event_id"], 3, 2, aggregates=sums)


@query
def count_window_all(spark, folder):
    rows = tb.events(spark, folder).select("event_id", tb.cents())
    sums = {"cents": ("sum", "cents")}
    return op.count_window(
        rows, [], ["event_id"], 100, aggregates=sums
    )


# --- jobs: hot lists ------------------------------------------------------------


def _top3(counts, *keys):
    return op.top_n(counts, 3, "cnt", keys).select("window_end", "rk", *keys, "cnt")


@query
def hot_items(spark, folder):
    views = tb.events(spark, folder).where(F.col("event_type") == "view")
    counts = op.sliding(views, "ts", "1 hour", "5 minutes", ["user_id"])
    return _top3(counts, "user_id")


@query
def hot_pages(spark, folder):
    rows = tb.events(spark, folder)
    counts = op.sliding(rows, "ts", "10 minutes", "5 seconds", ["event_type"])
    return _top3(counts, "event_type")


@query
def hot_ads_by_province(spark, folder):
    rows = tb.events(spark, folder)
    counts = op.sliding(rows, "ts", "10 minutes", "5 seconds", ["event_type", "user_id"])
    return _top3(counts, "event_type", "user_id")


@query
def hot_by_user(spark, folder):
    rows = tb.events(spark, folder)
    counts = op.sliding(rows, "ts", "1 hour", "5 minutes", ["user_id", "event_type"])
    return _top3(counts, "user_id", "event_type")


# --- jobs: detection ------------------------------------------------------------


def _clicks(spark, folder):
    return tb.events(spark, folder).select("event_id", "ts", "user_id", "event_type")


@query
def blacklist_pass(spark, folder):
    return op.blacklist_pass(
        _clicks(spark, folder), ["user_id", "event_type"], "ts", ["event_id"], 2
    )


@query
def blacklist_alert(spark, folder):
    return op.blacklist_alerts(
        _clicks(spark, folder), ["user_id", "event_type"], "ts", ["event_id"], 2
    ).drop("day")


@query
def blacklist_hot_ads(spark, folder):
    keys = ["user_id", "event_type"]
    passed = op.blacklist_pass(_clicks(spark, folder), keys, "ts", ["event_id"], 2)
    counts = op.sliding(passed, "ts", "1 hour", "5 minutes", keys)
    return _top3(counts, *keys)


@query
def login_fail(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", "ts", "event_type")
    return op.repeated_failures(
        rows, "user_id", "ts", F.col("event_type") == "error", "1 hour"
    ).select("user_id", "previous_ts", "ts")


@query
def order_outcome(spark, folder):
    log = tb.order_log(spark, folder)
    return op.order_outcomes(log, ["event_type", "event_time"], limit=30)


@query
def rising_alert(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "ts", "value")
    return op.rising_alerts(rows, "user_id", "ts", "value", "6 hours")


@query
def rising_alert_one_type(spark, folder):
    rows = tb.events(spark, folder).select("event_type", "ts", "value")
    return op.rising_alerts(
        rows, "event_type", "ts", "value", "20 minutes"
    )


@query
def first_timer(spark, folder):
    rows = tb.events(spark, folder)
    fires = F.min("ts") + F.expr("INTERVAL 5 SECONDS")
    return rows.groupBy("user_id").agg(fires.alias("fires_at"))


# --- what the sinks write -------------------------------------------------------


@query
def latest_value(spark, folder):
    rows = tb.events(spark, folder).select("user_id", "event_id", tb.cents())
    return latest_per_key(rows, "user_id", "cents", ["event_id"])


@query
def json_documents(spark, folder):
    return to_documents(tb.events(spark, folder), "event_type")


@query
def kafka_values(spark, folder):
    return kafka_records(tb.events(spark, folder), "event_id")
