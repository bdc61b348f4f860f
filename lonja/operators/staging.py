"""Tables written once and read by several consumers, in a folder that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


# A builder that uses an intermediate table several times hands it to a ``Keep`` under a name and goes on with the
# result. ``Stage.keep`` writes it, ``not_kept`` leaves it lazy.
Keep = Callable[[DataFrame, str], DataFrame]


def not_kept(rows: DataFrame, name: str) -> DataFrame:
    return rows


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_lonja_stages"
    if folder.startswith(("file:", "/")) and not context.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir: the warehouse is a local folder")
    return folder


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder on any file system; nothing happens where there is none."""
    located, files = _located(spark, path)
    files.delete(located, True)


class Stage:
    """A private subfolder of the shared folder, removed at the end of the session, or of the ``with`` block."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
        path, files = _located(spark, self.path)
        files.deleteOnExit(path)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """Writes ``rows`` and returns the written table: a lost executor costs a re-read, not a recomputation."""
        rows.write.mode("overwrite").parquet(self.at(name))
        return self.spark.read.schema(rows.schema).parquet(self.at(name))

    def remove(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_) -> None:
        self.remove()
