from rillflow.functions.rules import Rule
from rillflow.functions.text import fields, to_text, tokens
from rillflow.functions.time import (
    day_of,
    duration_us,
    event_time,
    from_micros,
    interval,
    micros,
    window_start,
)

__all__ = [
    "Rule",
    "day_of",
    "duration_us",
    "event_time",
    "fields",
    "from_micros",
    "interval",
    "micros",
    "to_text",
    "tokens",
    "window_start",
]
