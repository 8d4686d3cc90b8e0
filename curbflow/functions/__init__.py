from curbflow.functions.calendar import (
    day_of_week,
    is_weekend,
    request_date,
    to_calendar_date,
    window_label,
    window_start_date,
)
from curbflow.functions.text import MISSING_TEXT, UNKNOWN, cache_key, contains_text, known_text, same_text

__all__ = [
    "MISSING_TEXT", "UNKNOWN", "cache_key", "contains_text", "day_of_week", "is_weekend", "known_text",
    "request_date", "same_text", "to_calendar_date", "window_label", "window_start_date",
]
