"""Keep one row per key.

``row_number() = 1`` is planned with a group limit before the shuffle: each task sends at most one row per key, so a
key that holds a third of all copies costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

_POSITION = "_position"


def _keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], ordered_by: set[str]) -> DataFrame:
    # The remaining columns break ties, so two runs never keep different rows.
    ties = [
        F.col(field.name).asc()
        for field in rows.schema.fields
        if field.name not in ordered_by and field.name not in keys and not isinstance(field.dataType, (MapType, VariantType))
    ]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return rows.withColumn(_POSITION, F.row_number().over(window)).where(F.col(_POSITION) == 1).drop(_POSITION)


def keep_latest(rows: DataFrame, keys: Sequence[str], by: str = "_ingested_at") -> DataFrame:
    """The row with the greatest ``by`` for each key."""
    return _keep_first(rows, keys, [F.col(by).desc()], {by})


def keep_earliest(rows: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``by`` columns for each key."""
    return _keep_first(rows, keys, [F.col(name).asc() for name in by], set(by))
