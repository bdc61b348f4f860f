"""Micro-batch folders of a streaming sink, joined into a few files per day.

A stream writes one folder per micro-batch, for ever. ``compact`` rewrites the finished ones (all but the newest, which may be replayed)
by day and says so in a marker, written last; then it removes the folders it has read. ``read_stream`` reads both forms: what the marker
names, and of each stream the micro-batches behind it. So readers see every row once at any moment, also between the marker and the
removal, and a run that dies before the marker leaves only files that nobody reads. Spark's readers skip the joined form when they
read the table's folder itself, since its name starts with an underscore.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import delete

_MARKER = "version INT, folder STRING, corrida STRING, lote BIGINT"
_BATCH = ["corrida", "lote"]


def _missing(problem: AnalysisException) -> bool:
    return problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _joined(spark: SparkSession, path: str) -> tuple[int, str | None, list[Row]]:
    """Version, folder, and per stream the last micro-batch that the folder holds. One row per stream and compaction is read."""
    try:
        rows = spark.read.schema(_MARKER).json(f"{path}/_joined/marker")
        last = rows.agg(F.max("version")).first()[0]
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        last = None
    if last is None:
        return 0, None, []
    held = rows.where(F.col("version") == last).collect()
    return last, held[0].folder, held


def _open_batches(spark: SparkSession, path: str, held: list[Row]) -> DataFrame | None:
    """The micro-batches that no joined folder holds."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        return None
    rows = rows.withColumn("corrida", F.col("corrida").cast("string")).withColumn("lote", F.col("lote").cast("long"))
    for one in held:
        rows = rows.where((F.col("corrida") != one.corrida) | (F.col("lote") > one.lote))
    return rows


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a streaming table, joined or not, with ``corrida`` and ``lote``."""
    _, folder, held = _joined(spark, path)
    rows = _open_batches(spark, path, held)
    if folder is None:
        if rows is None:
            raise LookupError(f"{path} holds no micro-batches")
        return rows
    joined = spark.read.parquet(f"{path}/_joined/{folder}").drop("_dia")
    return joined if rows is None else joined.unionByName(rows, allowMissingColumns=True)


def compact(spark: SparkSession, path: str, day: Column, keep: int = 1) -> int:
    """Joins all but the ``keep`` newest micro-batches of each stream; returns how many were joined. ``day`` says by what rows are laid out.

    The joined form is written anew each time, so run it seldom (once a day); its files are as large as adaptive execution makes them."""
    if keep < 1:
        raise ValueError("the newest micro-batch may still be replayed: keep at least one")
    version, folder, held = _joined(spark, path)
    rows = _open_batches(spark, path, held)
    if rows is None:
        return 0
    listed = [(r.corrida, r.lote) for r in rows.select(*_BATCH).distinct().collect()]  # names of folders, not rows
    finished = {}
    for stream in {stream for stream, _ in listed}:
        numbers = sorted(number for name, number in listed if name == stream)
        if len(numbers) > keep:
            finished[stream] = numbers[:-keep]
    if not finished:
        return 0
    through = {**{one.corrida: one.lote for one in held}, **{stream: numbers[-1] for stream, numbers in finished.items()}}
    old = rows.where(" OR ".join(f"(corrida = {_quoted(stream)} AND lote <= {numbers[-1]})" for stream, numbers in finished.items()))
    if folder is not None:
        old = old.unionByName(spark.read.parquet(f"{path}/_joined/{folder}").drop("_dia"), allowMissingColumns=True)
    target = uuid.uuid4().hex
    old.withColumn("_dia", day).hint("rebalance", "_dia").write.partitionBy("_dia").parquet(f"{path}/_joined/{target}")
    marker = spark.createDataFrame([(version + 1, target, stream, number) for stream, number in through.items()], _MARKER)
    marker.coalesce(1).write.mode("append").json(f"{path}/_joined/marker")
    clean(spark, path)
    if folder is not None:
        delete(spark, f"{path}/_joined/{folder}")
    return sum(map(len, finished.values()))


def clean(spark: SparkSession, path: str) -> None:
    """Removes the folders of micro-batches that a joined folder holds, also those that an earlier run had no time to remove."""
    _, _, held = _joined(spark, path)
    try:
        listed = spark.read.parquet(path).select(F.col("corrida").cast("string"), F.col("lote").cast("long")).distinct().collect()
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        return
    through = {one.corrida: one.lote for one in held}
    for stream, number in listed:
        if number <= through.get(stream, -1):
            delete(spark, f"{path}/corrida={stream}/lote={number}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
