"""Bronze: data as it came, plus when and from where."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .feeds import named_csv


def stamped(rows: DataFrame, source: str, at: datetime | None = None) -> DataFrame:
    """Adds ``_ingested_at``, ``_source`` and ``_ingest_date``. Pass ``at`` to make a run reproducible."""
    instant = F.lit(at) if at else F.current_timestamp()
    return rows.select(
        "*",
        instant.cast("timestamp").alias("_ingested_at"),
        F.lit(source).alias("_source"),
        F.to_date(instant.cast("timestamp")).alias("_ingest_date"),
    )


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Replaces the ingest days present in ``rows`` and leaves all others alone, so a day can be ingested again."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_ingest_date")
        .parquet(path)
    )


def _by_file(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_name").alias("_archivo"))


def land_csv(spark: SparkSession, source: str | Sequence[str], target: str, schema: str) -> None:
    """CSV files with a header to the lake, all fields as text, one folder per file: the declared columns first, by name."""
    rows = _by_file(named_csv(spark, source, schema))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .partitionBy("_archivo")
        .csv(target)
    )


def land_lines(spark: SparkSession, source: str | Sequence[str], target: str) -> None:
    """Line-oriented text (JSON lines) to the lake unchanged, one folder per file."""
    rows = _by_file(spark.read.text(source))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_archivo")
        .text(target)
    )


def land_json_array(spark: SparkSession, source: str | Sequence[str], target: str) -> None:
    """Supplier files (one JSON array each) to the lake as JSON lines, one folder per file."""
    rows = _by_file(spark.read.schema(schemas.SUPPLIERS).option("multiLine", True).json(source))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy("_archivo")
        .json(target)
    )


def land_catalog(spark: SparkSession, source: str, target: str, provider: str, at: datetime | None = None) -> None:
    """Catalogue files of an external provider (JSON lines, one file per category) to the lake, tagged with their origin.

    Each run replaces the one before. The category is the name of the file without its ending.
    """
    category = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    provided = [name for name in schemas.field_names(schemas.CATALOG) if not name.startswith("_")]
    tagged = spark.read.schema(schemas.CATALOG).json(source).select(
        *provided,
        category.alias("_categoria_api"),
        F.concat(F.lit("/products/category/"), category).alias("_endpoint"),
    )
    stamps = stamped(tagged, f"api:{provider}", at).withColumns(
        {
            "_ingested_at": F.date_format("_ingested_at", "yyyy-MM-dd'T'HH:mm:ss"),
            "_ingest_date": F.col("_ingest_date").cast("string"),
        }
    )
    stamps.write.mode("overwrite").json(target)


def file_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path, size and time of raw files, and their name and address as ``_metadata`` gives them in a scan. Only the listing is read,
    never their content."""
    return spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("archivo"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"),
        F.col("_metadata.file_name").alias("nombre"),
        F.col("_metadata.file_path").alias("url"),
    )


def file_manifest(rows: DataFrame) -> DataFrame:
    """What was read: one row per input file of a file-based table, with its size, time and number of records."""
    return rows.groupBy(
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modificado"),
    ).agg(F.count(F.lit(1)).alias("registros"))
