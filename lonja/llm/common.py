"""What several operators share: reading a document table, the hold-out rule, batches of Arrow rows."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators.staging import Stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` only, so that no further column of ``docs`` can clash with those an operator adds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def placed(docs: DataFrame, stage: Stage, name: str) -> DataFrame:
    """``docs`` with every row's place, written once: another scan of the files can be split differently and number them differently."""
    return stage.keep(docs.withColumn(name, F.monotonically_increasing_id()), "placed")


def identified(docs: DataFrame, stage: Stage, file: str, row: str) -> DataFrame:
    """``docs`` with two numbers that tell every row apart, the same in every scan: of rows read from Parquet files as they are, the file
    (a 64-bit hash of its path) and the row's index in it. Rows that come from anything else are numbered and stored."""
    kinds = set(re.findall(r"(?m)^[^\w\n]*(\w+)", docs._jdf.queryExecution().analyzed().toString()))
    if kinds <= {"Relation", "Project", "Filter", "SubqueryAlias"} and docs.inputFiles():
        try:
            return docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
        except AnalysisException:  # not Parquet, or a view that hides where its rows come from
            pass
    return placed(docs, stage, row).withColumn(file, F.lit(0).cast("long"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


class Hashes(dict):
    """64-bit hash of a word, kept for the next time it is met, by one task and for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 16:
            self[word] = value
        return value


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def set_smaller_batches(spark: SparkSession, rows: int) -> None:
    """From here on the session's jobs hand at most ``rows`` rows at once to Python workers."""
    before = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(rows, before) if before > 0 else rows))


@contextmanager
def smaller_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs inside hand ``rows`` rows at once to Python workers instead of 10,000: for rows that may be long."""
    before = spark.conf.get(_BATCH)
    set_smaller_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def give_back_memory() -> None:
    """Python workers live on from task to task; what a task has freed goes back to the machine at its end."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def batches(rows: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``work`` turns each Arrow batch into dicts of columns, in Python workers."""
    arrow = pa.schema([(f.name, _KINDS[f.dataType.simpleString()]) for f in _schema(schema)])

    def over(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in incoming:
                for columns in work(batch):
                    yield pa.RecordBatch.from_arrays([_column(columns[f.name], f.type) for f in arrow], schema=arrow)
        finally:
            give_back_memory()

    return rows.mapInArrow(over, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


_KINDS = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    "double": pa.float64(), "float": pa.float32(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()),
}
