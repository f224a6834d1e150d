from rillflow.sources.lines import (
    kafka_lines,
    kafka_options,
    kafka_values,
    rows,
    socket_lines,
    text_lines,
    text_stream,
)
from rillflow.sources.parse import (
    parse_access_log,
    parse_ad_click,
    parse_login,
    parse_order,
    parse_sensor,
    parse_user_behavior,
)

__all__ = [
    "kafka_lines",
    "kafka_options",
    "kafka_values",
    "parse_access_log",
    "parse_ad_click",
    "parse_login",
    "parse_order",
    "parse_sensor",
    "parse_user_behavior",
    "rows",
    "socket_lines",
    "text_lines",
    "text_stream",
]
