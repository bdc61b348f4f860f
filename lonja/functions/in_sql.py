"""The cleansing expressions as functions of a session's SQL, made from the column functions themselves: one definition for both."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, SparkSession

from .calendar import day_from_text, event_instant
from .numbers import exact_price, price_value, whole_number
from .text import is_email, lower_trim, shoe_size, title_trim, upper_trim

FUNCTIONS: Mapping[str, Callable[[str], Column]] = {
    "clean_price": price_value,
    "exact_price": exact_price,
    "clean_number": whole_number,
    "clean_size": shoe_size,
    "clean_date": day_from_text,
    "clean_instant": event_instant,
    "is_email": is_email,
    "clean_lower": lower_trim,
    "clean_upper": upper_trim,
    "clean_title": title_trim,
}


def register_functions(spark: SparkSession, functions: Mapping[str, Callable[[str], Column]] = FUNCTIONS) -> list[str]:
    """Makes every function of text known to ``spark.sql`` until the session ends, and returns the names.

    Each becomes a temporary SQL function whose body is the text of the column expression, so Spark inlines it into the query: no
    Python and no UDF runs. Registering again replaces the functions.
    """
    argument = spark.createDataFrame([], "value STRING")
    for name, build in functions.items():
        resolved = argument.select(build("value"))
        body = resolved._jdf.queryExecution().analyzed().expressions().head().child().sql()
        kind = resolved.schema[0].dataType.simpleString()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS {kind} RETURN {body}")
    return list(functions)
