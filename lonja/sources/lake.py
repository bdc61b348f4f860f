"""Lake layout. Locations are URIs in plain text, so that an object store works like a local folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingTable(LookupError):
    """A layer was read before it was written."""


@dataclass(frozen=True)
class Lake:
    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, *parts: str) -> str:
        return self._under("bronze", *parts)

    def silver(self, *parts: str) -> str:
        return self._under("silver", *parts)

    def rejects(self, *parts: str) -> str:
        return self._under("silver", "rechazados", *parts)

    def gold(self, *parts: str) -> str:
        return self._under("gold", *parts)

    def checkpoint(self, *parts: str) -> str:
        return self._under("_checkpoints", *parts)

    def state(self, *parts: str) -> str:
        return self._under("_state", *parts)

    def metadata(self, *parts: str) -> str:
        return self._under("_metadata", *parts)


def read_table(spark: SparkSession, path: str, hint: str) -> DataFrame:
    """A Parquet table; ``hint`` tells which step writes it when it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingTable(f"{path} does not exist yet: {hint}") from problem
        raise


def read_if_present(read, *args) -> DataFrame | None:
    """``read(*args)``, or None when its files were never ingested (optional sources)."""
    try:
        return read(*args)
    except MissingTable:
        return None
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_snapshots(spark: SparkSession, lake: Lake, table: str, latest_only: bool = False) -> DataFrame:
    """All ingest days of a database table, or only the last one (a partition filter)."""
    rows = read_table(spark, lake.bronze("postgres", table), "run the ingest step first")
    if not latest_only:
        return rows
    last_day = rows.agg(F.max("_ingest_date"))
    return rows.where(F.col("_ingest_date") == last_day.scalar())
