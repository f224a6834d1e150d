from rillflow.streaming.bounded import open_windows, progress_table
from rillflow.streaming.joins import order_pairs
from rillflow.streaming.ranking import top_items
from rillflow.streaming.run import drain, folder_sink, top_n_sink, upsert_sink
from rillflow.streaming.stateful import (
    count_window,
    daily_limit,
    first_timer,
    keyed_process,
    late_windows,
    order_outcomes,
    repeated_failures,
    rising_alerts,
    rolling_reduce,
    with_watermark_time,
)
from rillflow.streaming.windows import (
    distinct_rows,
    late_updates,
    running_totals,
    session,
    sliding,
    tumbling,
    with_event_time,
    with_processing_time,
)

__all__ = [
    "count_window",
    "daily_limit",
    "distinct_rows",
    "drain",
    "first_timer",
    "folder_sink",
    "late_updates",
    "keyed_process",
    "late_windows",
    "open_windows",
    "order_outcomes",
    "order_pairs",
    "progress_table",
    "repeated_failures",
    "rising_alerts",
    "rolling_reduce",
    "running_totals",
    "session",
    "sliding",
    "top_items",
    "top_n_sink",
    "tumbling",
    "upsert_sink",
    "with_event_time",
    "with_processing_time",
    "with_watermark_time",
]
