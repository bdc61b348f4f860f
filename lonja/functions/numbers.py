"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import MONEY

# What may stand around the digits of a price.
CURRENCY_CODE = "EUR"
CURRENCY_SIGNS = "€$ "
# The last comma or dot is the decimal mark: a dot goes when the last mark is a comma, a comma when it is a dot.
GROUPING_PATTERN = r"\.(?=.*,[^.,]*$)|,(?=.*\.[^.,]*$)"
NUMBER_PATTERN = r"^[\s\u00a0]*([+-]?(?:\d+\.?\d*|\.\d+))[\s\u00a0]*$"
WHOLE_PATTERN = r"^([+-]?\d+)(?:\.\d*)?$"


def price_text(col: str) -> Column:
    """Canonical decimal text of a price, empty where the text is not a plain number (``nan``, ``1e3``, ``12 units``).

    Every step uses the one before exactly once: an expression that repeats its input is evaluated once per mention.
    """
    bare = F.translate(F.replace(F.upper(F.col(col)), F.lit(CURRENCY_CODE), F.lit("")), CURRENCY_SIGNS, "")
    one_mark = F.translate(F.regexp_replace(bare, GROUPING_PATTERN, ""), ",", ".")
    return F.regexp_extract(one_mark, NUMBER_PATTERN, 1)


def price_value(col: str) -> Column:
    """Price text as DOUBLE."""
    return price_text(col).try_cast("double")


def exact_price(col: str) -> Column:
    """Price text as exact money."""
    return price_text(col).try_cast(MONEY)


def whole_number(col: str, kind: str = "int") -> Column:
    """Integer from text: a fraction is cut off, any other text is NULL."""
    return F.regexp_extract(F.trim(F.col(col)), WHOLE_PATTERN, 1).try_cast(kind)
