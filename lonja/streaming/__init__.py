"""Live events: parsing, activity, stock alerts, the micro-batch that writes them, and windows of event time."""

from .live import LiveSinks, activity, parse_events, start, stock_alerts
from .windowed import WindowJobs, current_windows, once_only, sessions, windowed_activity

__all__ = [
    "LiveSinks",
    "WindowJobs",
    "activity",
    "current_windows",
    "once_only",
    "parse_events",
    "sessions",
    "start",
    "stock_alerts",
    "windowed_activity",
]
