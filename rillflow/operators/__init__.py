from rillflow.operators.accumulators import Accumulator, accumulate, per_window
from rillflow.operators.detect import (
    blacklist,
    blacklist_alerts,
    blacklist_pass,
    order_outcomes,
    repeated_failures,
)
from rillflow.operators.reduce import running_reduce
from rillflow.operators.rising import rising_alerts
from rillflow.operators.rolling import (
    rolling_count,
    rolling_max,
    rolling_min,
    rolling_reduce,
    rolling_sum,
)
from rillflow.operators.skew import Limits, with_running
from rillflow.operators.topn import report, top_n
from rillflow.operators.transforms import (
    connect,
    describe_keyed,
    keep_and_map,
    label,
    level_cases,
    map_partitions,
    partition_by,
    project,
    redistribute,
    select_label,
    side_output,
    spread,
    union,
    unnest,
    words,
)
from rillflow.operators.windows import (
    OwnAggregate,
    count_window,
    distinct_estimate,
    session,
    sliding,
    tumbling,
)

__all__ = [
    "Accumulator",
    "Limits",
    "OwnAggregate",
    "accumulate",
    "blacklist",
    "blacklist_alerts",
    "blacklist_pass",
    "connect",
    "count_window",
    "describe_keyed",
    "distinct_estimate",
    "keep_and_map",
    "label",
    "level_cases",
    "map_partitions",
    "order_outcomes",
    "partition_by",
    "per_window",
    "project",
    "redistribute",
    "repeated_failures",
    "report",
    "rising_alerts",
    "rolling_count",
    "rolling_max",
    "rolling_min",
    "rolling_reduce",
    "rolling_sum",
    "running_reduce",
    "select_label",
    "session",
    "side_output",
    "sliding",
    "spread",
    "top_n",
    "tumbling",
    "union",
    "unnest",
    "with_running",
    "words",
]
