"""Dates, instants and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# dd?MM?yyyy with the same separator twice; the separators are / - and .
DAY_FIRST_PATTERN = r"^(\d{2})([/.\-])(\d{2})\2(\d{4})$"
# what the pattern yyyy-MM-dd reads: years of four digits, or more with a sign
ISO_PATTERN = r"^(\d{4}-\d{2}-\d{2}|\+\d{5,6}-\d{2}-\d{2}|-(?!0+-)\d{4,6}-\d{2}-\d{2})\z"
# a time of day and, behind it, anything but more digits: an offset or the name of a zone
ZONE_PATTERN = r"^[^T ]+[T ][\d:.]+[^\d:.]"


def day_from_text(col: str) -> Column:
    """Date from ``yyyy-MM-dd``, ``dd/MM/yyyy``, ``dd-MM-yyyy`` or ``dd.MM.yyyy``; NULL for anything else.

    Day-first text is rewritten to ISO order, so every value is parsed once. What has that form is cast, which is several times as fast
    as parsing by a pattern; a cast alone would take other forms too.
    """
    text = F.trim(F.col(col).cast("string"))
    return F.regexp_extract(F.regexp_replace(text, DAY_FIRST_PATTERN, "$4-$3-$1"), ISO_PATTERN, 1).try_cast("date")


def event_instant(col: str, naive_zone: str = "UTC") -> Column:
    """Instant from any text that Spark reads as a timestamp. Text with an offset or a zone keeps it, text without is read
    in ``naive_zone``: it is written out as a full wall-clock time, since a zone may only follow full seconds."""
    text = F.trim(F.col(col))
    clock = text.try_cast("timestamp_ntz").cast("string")
    return F.try_to_timestamp(F.when(text.rlike(ZONE_PATTERN), text).otherwise(F.concat(clock, F.lit(naive_zone))))


def wall_clock(instant: Column, zone: str = "UTC") -> Column:
    """What a clock in ``zone`` shows at an instant, whatever the zone of the session is."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def calendar_columns(col: str) -> list[Column]:
    """Year, month, ISO week, weekday (1 = Sunday) and weekend flag of a date column."""
    day = F.col(col)
    return [
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.weekofyear(day).alias("semana"),
        F.dayofweek(day).alias("dia_semana"),
        F.dayofweek(day).isin(1, 7).alias("es_fin_de_semana"),
    ]
