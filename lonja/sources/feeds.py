"""Raw file feeds and the event topic, all with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Defaults of the event topic.
KAFKA_DEFAULTS = {
    "subscribe": "eventos-web",
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
}


def named_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """CSV files bound by the names in their header, all fields as text: the declared columns in their order (NULL where
    the header lacks one), then all others.

    The header is read from one file. A file whose header differs is an error, never a mix-up of columns.
    """
    try:
        rows = spark.read.options(header=True, enforceSchema=False).csv(path)
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            raise
        return spark.read.schema(schema).csv(path)
    declared = schemas.field_names(schema)
    found = {name.strip().lower(): name for name in rows.columns}
    chosen = [
        (F.col(f"`{found[name]}`") if name in found else F.lit(None).cast("string")).alias(name) for name in declared
    ]
    others = [F.col(f"`{name}`") for key, name in found.items() if key not in declared]
    return rows.select(*chosen, *others)


def _csv(spark: SparkSession, path: str, schema: str, landed: bool) -> DataFrame:
    """A landed copy starts with the declared columns, whatever other columns its files have."""
    if landed:
        return spark.read.schema(schema).options(header=True).csv(path)
    return named_csv(spark, path, schema).select(*schemas.field_names(schema))


def read_sales_history(spark: SparkSession, path: str, landed: bool = False) -> DataFrame:
    return _csv(spark, path, schemas.SALES_HISTORY, landed)


def read_returns_history(spark: SparkSession, path: str, landed: bool = False) -> DataFrame:
    return _csv(spark, path, schemas.RETURNS_HISTORY, landed)


def read_suppliers(spark: SparkSession, path: str | Sequence[str], landed: bool = False) -> DataFrame:
    """Suppliers come as one JSON array per file; the landed copy has one supplier per line."""
    return spark.read.schema(schemas.SUPPLIERS).option("multiLine", not landed).json(path)


def read_event_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """JSON lines of several folders (backfill and stream copy) as one scan. A broken line becomes an all-NULL row.

    The folders are partitioned in different ways, which does not matter here: all files below them are read.
    """
    return spark.read.schema(schemas.EVENT).option("recursiveFileLookup", True).json(list(paths))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).json(path)


def kafka_events(spark: SparkSession, servers: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The event topic as a stream (needs the Kafka connector on the class path)."""
    chosen = {**KAFKA_DEFAULTS, **(options or {}), "kafka.bootstrap.servers": servers}
    return spark.readStream.format("kafka").options(**chosen).load()


def text_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same event records as text files, for replays: a stream with a ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
