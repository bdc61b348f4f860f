"""Ranks and row numbers over a whole table, spread over many tasks.

A window without partitions, or with a few huge ones, sorts everything in one task. Here the rows are cut into ranges of
the order key, sorted inside each range and stored with their place: the number of the range and the position in it. The
ranges are Spark's own (bounds from a distributed sample, looked up by binary search, small ranges joined at run time),
and since the place is stored, a recomputed task or a second scan cannot cut other ranges. What is left is one row per
range with the number of rows before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import Stage

_ROWS = "_rank_rows"
_PLACE = "_rank_place"
_RANGE = "_rank_range"
_BEFORE = "_rank_before"
_LOCAL_BITS = 33  # of a generated id: the position in its task


def _placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` sorted by ``order`` over all tasks, stored, with range and position in it."""
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = Stage(rows.sparkSession, "ranges").keep(ranges.withColumn(_PLACE, F.monotonically_increasing_id()), "placed")
    return stored.withColumn(_RANGE, F.shiftright(_PLACE, _LOCAL_BITS)).withColumn(
        _PLACE, F.col(_PLACE).bitwiseAND((1 << _LOCAL_BITS) - 1)
    )


def _before(placed: DataFrame, size: Column) -> DataFrame:
    """Rows in the ranges before each range. One row per range goes into the window, none of the table's own."""
    totals = placed.groupBy(_RANGE).agg(size.alias(_ROWS))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_RANGE, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))


def numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the position in the order of the whole table as BIGINT, from 0. Rows with equal keys get theirs arbitrarily,
    and a key that many rows share should be made finer, since a range can only be cut between different keys."""
    placed = _placed(rows, order)
    found = placed.join(_before(placed, F.count(F.lit(1))), _RANGE)
    return found.withColumn(name, F.col(_BEFORE) + F.col(_PLACE)).drop(_RANGE, _PLACE, _BEFORE)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; keeps the key columns of the left side only."""
    renamed = right.select(*[F.col(name).alias(f"_r_{name}" if name in keys else name) for name in right.columns])
    match = [F.col(f"_l.{name}").eqNullSafe(F.col(f"_r._r_{name}")) for name in keys]
    return left.alias("_l").join(renamed.alias("_r"), match, how).drop(*[f"_r_{name}" for name in keys])


def _ranked(counted: DataFrame, value: str, name: str, by: Sequence[str]) -> DataFrame:
    """Ranks of counted values that are unique per group ``by``: all rows before the value, less those before its group."""
    placed = _placed(counted, [*[F.col(column).asc_nulls_first() for column in by], F.col(value).desc_nulls_last()])
    inside = Window.partitionBy(_RANGE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_rank_local", F.coalesce(F.sum(_ROWS).over(inside), F.lit(0)))
    ranked = local.join(_before(placed, F.sum(_ROWS)), _RANGE).select(
        *by, value, (F.col("_rank_local") + F.col(_BEFORE) + 1).alias(name)
    )
    if not by:
        return ranked
    first = ranked.groupBy(*by).agg(F.min(name).alias("_rank_first"))
    return _join_null_safe(ranked, first, by).select(*by, value, (F.col(name) - F.col("_rank_first") + 1).alias(name))


def ranks_within(rows: DataFrame, value: str, ranks: Mapping[str, Sequence[str]]) -> DataFrame:
    """``rank()`` by ``value`` descending (NULL last), once per entry of ``ranks``: column name to grouping columns (none =
    all rows). BIGINT.

    Works on the distinct values with their counts: equal values collapse before any shuffle, and the join that brings
    the ranks back has one row per value on one side, so a value shared by many rows can be split by adaptive execution.
    """
    groups = sorted({name for by in ranks.values() for name in by})
    counted = rows.groupBy(*groups, value).agg(F.count(F.lit(1)).alias(_ROWS))
    counted = Stage(rows.sparkSession, "ranges").keep(counted, "counted")
    found = counted.select(*groups, value)
    for name, by in ranks.items():
        values = counted
        if set(by) != set(groups):
            values = counted.groupBy(*by, value).agg(F.sum(_ROWS).alias(_ROWS))
        found = _join_null_safe(found, _ranked(values, value, name, by), [*by, value])
    return _join_null_safe(rows, found, [*groups, value], "left")


def rank_within(rows: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """``rank()`` by ``value`` descending inside the groups ``by`` (none = the whole table)."""
    return ranks_within(rows, value, {name: by})


def number_rows(rows: DataFrame, value: str, unique: Sequence[str], name: str) -> DataFrame:
    """``row_number()`` over the whole table by ``value`` descending; ``unique`` columns make the order total. BIGINT."""
    order = [F.col(value).desc_nulls_last(), *[F.col(column).asc_nulls_first() for column in unique]]
    return numbered(rows, order, name).withColumn(name, F.col(name) + 1)
