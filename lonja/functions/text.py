"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES

# Prefixes in front of a shoe size; a size has one or two digits and may end in a half.
SIZE_PATTERN = r"^(?:(?:EU|TALLA|T|ESP)\.?\s*)?(\d{1,2}(?:[.,]5)?)$"


def lower_trim(col: str) -> Column:
    return F.lower(F.trim(F.col(col)))


def upper_trim(col: str) -> Column:
    return F.upper(F.trim(F.col(col)))


def title_trim(col: str) -> Column:
    """Every word capitalised, the rest in lower case (``initcap`` lowers the rest by itself)."""
    return F.initcap(F.trim(F.col(col)))


def is_email(col: str, pattern: str = DEFAULT_RULES.email_pattern) -> Column:
    return F.col(col).rlike(pattern)


def shoe_size(col: str) -> Column:
    """``EU 36``, `` T38 ``, ``37,5`` -> ``36``, ``38``, ``37.5``; anything else is NULL."""
    found = F.regexp_extract(upper_trim(col), SIZE_PATTERN, 1)
    return F.nullif(F.translate(found, ",", "."), F.lit(""))


def joined(col: str, separator: str = ",") -> Column:
    """Array to separated text; a NULL array gives an empty text."""
    return F.concat_ws(separator, F.col(col))
