"""Landing by manifest: only raw files that are new or have changed are copied to Bronze.

The manifest is a log beside the landed tables. A landing compares the listing of the raw files (path, size and time; no content) with
what the log holds last for each path, hands the others to a landing function, and appends them to the log when their copy is complete,
with the number of records that were found in them. A run that dies before that is made good by the next one: its files are not in the
log, so they are landed again, and since a copy has one folder per file that is replaced, nothing is there twice.

A raw file that has vanished keeps its copy: Bronze is the history of what came. If the landed table itself is gone, all files are landed.

Copies are told apart by the file's name, so files of the same name in different folders are always landed together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import delete
from .lake import read_if_present
from .landing import file_listing, stamped

MANIFEST = (
    "familia STRING, archivo STRING, bytes BIGINT, modificado TIMESTAMP, registros BIGINT, "
    "_ingested_at TIMESTAMP, _source STRING, _ingest_date DATE"
)
_VERSION = ["archivo", "bytes", "modificado"]


@dataclass(frozen=True)
class Family:
    """Raw files of one kind: where they are, where their copy goes, how they are copied, and how they are read to count records."""

    name: str
    source: str
    target: str
    land: Callable[[SparkSession, Sequence[str], str], None]
    read: Callable[[SparkSession, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Manifest:
    spark: SparkSession
    path: str

    def log(self) -> DataFrame:
        """All versions of all files that were ever landed."""
        found = read_if_present(self.spark.read.schema(MANIFEST).parquet, self.path)
        return self.spark.createDataFrame([], MANIFEST) if found is None else found

    def current(self) -> DataFrame:
        """The last landed version of every file."""
        fields = [name for name in self.log().columns if name not in ("familia", "archivo")]
        last = F.max_by(F.struct(*fields), F.struct("_ingested_at", "modificado"))
        return self.log().groupBy("familia", "archivo").agg(last.alias("last")).select("familia", "archivo", "last.*")

    def fresh(self, family: Family) -> DataFrame:
        """Files of ``family`` that are to be landed, with their size and time, name and address as scans tell them."""
        listing = file_listing(self.spark, [family.source])
        if read_if_present(self.spark.read.text, family.target) is None:
            return listing
        landed = self.current().where(F.col("familia") == family.name).select(*_VERSION)
        names = listing.join(landed, _VERSION, "left_anti").select("nombre").distinct()
        return listing.join(names, "nombre", "left_semi")

    def land(self, family: Family, at: datetime | None = None) -> int:
        """Copies what is new or changed and returns the number of files.

        The paths of these files go through the driver, as those of every scan do in Spark's own file index; no content does.
        """
        fresh = self.fresh(family)
        rows = fresh.collect()
        if not rows:
            return 0
        paths = [row.archivo for row in rows]
        family.land(self.spark, paths, family.target)
        listed = self.spark.createDataFrame(rows, fresh.schema)
        counted = family.read(self.spark, paths).groupBy(F.col("_metadata.file_path").alias("url")).agg(F.count(F.lit(1)).alias("registros"))
        found = listed.join(counted, "url", "left").withColumn("registros", F.coalesce("registros", F.lit(0)))
        found = self.spark.createDataFrame(found.collect(), found.schema)
        self._clear_empty(family, found)
        records = stamped(found.select(F.lit(family.name).alias("familia"), *_VERSION, "registros"), "raw", at)
        records.coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)

    def _clear_empty(self, family: Family, found: DataFrame) -> None:
        """A file that has no record any more replaces no folder when it is copied: its old copy is removed here."""
        names = found.groupBy("nombre").agg(F.sum("registros").alias("n")).where("n = 0").select("nombre")
        empty = [row.nombre for row in names.collect()]
        present = read_if_present(self.spark.read.text, family.target) if empty else None
        if present is None or "_archivo" not in present.columns:
            return
        folders = present.where(F.col("_archivo").cast("string").isin(empty)).select("_metadata.file_path").distinct()
        for folder in {row.file_path.rsplit("/", 1)[0] for row in folders.collect()}:
            delete(self.spark, unquote(folder))
