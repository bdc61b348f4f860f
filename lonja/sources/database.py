"""Database tables over JDBC, read by many tasks at once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a table is cut into parallel reads: ``tasks`` ranges of an integer, date or timestamp column."""

    column: str
    tasks: int = 32


@dataclass(frozen=True)
class Database:
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size), **self.properties}

    def split_options(self, split: Split, low, high) -> dict[str, str]:
        return {
            "partitionColumn": split.column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(split.tasks),
        }

    def read(self, spark: SparkSession, table: str, split: Split | None = None) -> DataFrame:
        """The whole table. With ``split`` the database answers one MIN/MAX query and then ranged reads."""
        reader = spark.read.format("jdbc").options(**self.options(table))
        if split is None:
            return reader.load()
        extent = f"(SELECT MIN({split.column}) AS low, MAX({split.column}) AS high FROM {table}) extent"
        low, high = spark.read.format("jdbc").options(**self.options(extent)).load().first()
        if low is None:
            return reader.load()
        return reader.options(**self.split_options(split, low, high)).load()
