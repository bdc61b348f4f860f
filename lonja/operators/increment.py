"""Tables that are brought up to date by the days that are new, instead of being built from all days again.

A ``KeyedState`` holds the last version of every key of a source that comes in daily snapshots. An update reads the days behind the one
it stands at (a partition filter, so older days are neither listed nor read), keeps the last version per key among the stored rows and
the new ones, and writes the next version of the state beside the old one. A small marker, written last, says which version holds: a
run that dies before it leaves the old version in place, and running it again gives the same result. An update without a new day takes
the last day once more, on top of the state before it, since a day may be ingested again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .keep_one import keep_latest
from .staging import delete

_MARKER = "version INT, through DATE, base INT, base_through DATE"


@dataclass(frozen=True)
class KeyedState:
    """The last versions of a table's rows, in the folder ``path``.

    ``deletes`` tells that a snapshot is complete: a key that the last day lacks was deleted and goes, so the last day alone is read.
    Without it, a key stays as it was last seen.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    by: str = "_ingested_at"
    day: str = "_ingest_date"
    deletes: bool = False

    def _marker(self) -> Row | None:
        try:
            rows = self.spark.read.schema(_MARKER).json(f"{self.path}/marker").orderBy(F.desc("version")).head(1)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows[0] if rows else None

    def _version(self, number: int) -> str:
        return f"{self.path}/version={number}"

    @property
    def through(self) -> date | None:
        """The last day that is part of the state."""
        marker = self._marker()
        return marker.through if marker else None

    def rows(self) -> DataFrame:
        """One row per key, with the stamps of its last version."""
        marker = self._marker()
        if marker is None:
            raise LookupError(f"{self.path} holds no state yet")
        return self.spark.read.parquet(self._version(marker.version))

    def behind(self, snapshots: DataFrame, through: date | None) -> DataFrame:
        """The days after ``through``. It is a literal, which reaches the scan as a partition filter."""
        return snapshots if through is None else snapshots.where(F.col(self.day) > F.lit(through))

    def update(self, snapshots: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Brings the state up to date and returns it. ``columns`` are those to hold besides the keys (default: all)."""
        marker = self._marker()
        number, base, through = (marker.version, marker.version, marker.through) if marker else (0, 0, None)
        last = self.behind(snapshots, through).agg(F.max(self.day)).first()[0]
        if last is None:
            if marker is None:
                raise LookupError("there is no day to start from")
            base, through, last = marker.base, marker.base_through, marker.through
        stamps = [self.by, self.day]
        held = [*self.keys, *(columns or [c for c in snapshots.columns if c not in (*self.keys, *stamps)]), *stamps]
        fresh = self.behind(snapshots, through).select(*held)
        if self.deletes:
            fresh = fresh.where(F.col(self.day) == F.lit(last))
        elif base:
            fresh = self.spark.read.parquet(self._version(base)).select(*held).unionByName(fresh)
        keep_latest(fresh, self.keys, self.by).write.mode("overwrite").parquet(self._version(number + 1))
        step = self.spark.createDataFrame([(number + 1, last, base, through)], _MARKER)
        step.coalesce(1).write.mode("append").json(f"{self.path}/marker")
        for old in range(max(1, number - 1), number + 1):
            if old != base:  # the marker before this one named it
                delete(self.spark, self._version(old))
        return self.rows()
