"""Validation that loses no row: every row is either accepted or rejected with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keep_one import keep_earliest

REASON = "motivo_rechazo"


@dataclass(frozen=True)
class Check:
    """A row passes when ``holds`` is TRUE. NULL counts as a failure."""

    reason: str
    holds: Column


@dataclass(frozen=True)
class Known:
    """A row stays when ``others`` has its key; it is rejected with ``reason`` when not. A NULL key is never known."""

    others: DataFrame
    key: str
    reason: str

    def kept(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.others.select(self.key), self.key, "left_semi").select(*rows.columns)

    def lost(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.others.select(self.key), self.key, "left_anti").select(*rows.columns)


@dataclass(frozen=True)
class First:
    """Of the rows of a key, the one with the smallest ``by`` stays, as ``keep_earliest`` chooses it; the others are rejected.

    The others are found without gathering a key's rows: equal rows are counted into one, the first of a key is a partial minimum, and
    the join that compares each row with it has one row per key on one side, so that a frequent key can be split.
    """

    keys: Sequence[str]
    by: Sequence[str]
    reason: str

    def kept(self, rows: DataFrame) -> DataFrame:
        return keep_earliest(rows, self.keys, self.by)

    def lost(self, rows: DataFrame) -> DataFrame:
        rest = [name for name in rows.columns if name not in self.keys and name not in self.by]
        counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times"))
        place = F.struct(*self.by, *rest)
        first = rows.groupBy(*self.keys).agg(F.min(place).alias("_first"))
        same = [F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) for key in self.keys]
        met = counted.withColumn("_place", place).alias("a").join(first.alias("b"), reduce(Column.__and__, same))
        again = F.col("_times") - F.when(F.col("_place").eqNullSafe(F.col("_first")), 1).otherwise(0)
        left = met.select(*[F.col(f"a.{name}").alias(name) for name in rows.columns], again.alias("_times")).where("_times > 0")
        return left.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).drop("_times")


@dataclass(frozen=True)
class Checked:
    """Rows tagged with the reason of their first failed check (NULL = none failed), and what else they have to meet.

    ``marked`` holds every input row once. ``accepted`` and ``rejected`` are filters over it, followed by the checks that need other
    rows (``further``, in their order: what one loses, the next does not see); together they hold every input row once. A job that
    writes both stages ``marked`` first (see ``with_marked``), so that the work before it is done once.
    """

    marked: DataFrame
    accepted_columns: Sequence[Column | str]
    rejected_columns: Sequence[Column | str]
    further: Sequence[Known | First] = ()

    @classmethod
    def by(
        cls,
        rows: DataFrame,
        checks: Sequence[Check],
        accepted: Sequence[Column | str],
        rejected: Sequence[Column | str],
        further: Sequence[Known | First] = (),
    ) -> Checked:
        failures = [F.when(~F.coalesce(check.holds, F.lit(False)), F.lit(check.reason)) for check in checks]
        return cls(rows.withColumn(REASON, F.coalesce(*failures)), accepted, rejected, further)

    def with_marked(self, marked: DataFrame) -> Checked:
        return Checked(marked, self.accepted_columns, self.rejected_columns, self.further)

    @property
    def _sound(self) -> DataFrame:
        return self.marked.where(F.col(REASON).isNull()).drop(REASON)

    @property
    def accepted(self) -> DataFrame:
        good = self._sound
        for check in self.further:
            good = check.kept(good)
        return good.select(*self.accepted_columns)

    def lost(self) -> list[DataFrame]:
        """The rejected rows of each step, all columns, with their reasons."""
        steps, good = [self.marked.where(F.col(REASON).isNotNull())], self._sound
        for check in self.further:
            steps.append(check.lost(good).withColumn(REASON, F.lit(check.reason)))
            good = check.kept(good)
        return steps

    @property
    def rejected(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [step.select(*self.rejected_columns, REASON) for step in self.lost()])


def evaluated_once(rows: DataFrame, through: Sequence[str] = ()) -> DataFrame:
    """The same rows, with the computed columns as the output of a generator. The columns in ``through`` pass beside it as they are, and
    are not read where nobody wants them.

    A filter on a computed column is otherwise merged with its formula, and the formula is evaluated in the filter and
    again in the projection. Worth it where the formulas are dear (text cleaning) and nearly all columns are needed.
    """
    computed = [name for name in rows.columns if name not in through]
    return rows.select(*through, F.inline(F.array(F.struct(*computed)))).select(*rows.columns)


def reject_summary(tables: Mapping[str, Checked]) -> DataFrame:
    """Rejected rows per table and reason. Each step is counted before the union, so little is shuffled."""
    counts = [
        step.groupBy(F.lit(name).alias("tabla"), REASON).agg(F.count(F.lit(1)).alias("filas"))
        for name, checked in tables.items()
        for step in checked.lost()
    ]
    return reduce(DataFrame.unionByName, counts)
