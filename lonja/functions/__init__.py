"""Column-to-column cleansing expressions. All are built from Spark functions, so they stay in generated code."""

from .calendar import calendar_columns, day_from_text, event_instant, wall_clock
from .in_sql import register_functions
from .numbers import exact_price, price_value, whole_number
from .text import is_email, joined, lower_trim, shoe_size, title_trim, upper_trim

__all__ = [
    "calendar_columns",
    "day_from_text",
    "event_instant",
    "exact_price",
    "is_email",
    "joined",
    "lower_trim",
    "price_value",
    "register_functions",
    "shoe_size",
    "title_trim",
    "upper_trim",
    "wall_clock",
    "whole_number",
]
