"""Column expressions. Everything here stays inside the JVM."""

from .measures import (
    classify_sleep,
    local_timestamp,
    map_record_type,
    measure_value,
    minutes_between,
    round_half_away,
    source_priority,
    workout_number,
)
from .text import fixed1, grouped_int, or_na

__all__ = [
    "classify_sleep", "local_timestamp", "map_record_type", "measure_value",
    "minutes_between", "round_half_away", "source_priority", "workout_number",
    "fixed1", "grouped_int", "or_na",
]
