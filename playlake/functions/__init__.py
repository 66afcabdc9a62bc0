from .scalars import (
    blank_to_null,
    clip_text,
    full_name,
    nan_to_null,
    round_to_int,
    to_float,
    to_id,
)
from .time import event_date, event_time, time_parts, weekday

__all__ = [
    "blank_to_null", "clip_text", "event_date", "event_time", "full_name", "nan_to_null",
    "round_to_int", "time_parts", "to_float", "to_id", "weekday",
]
