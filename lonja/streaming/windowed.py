"""Activity by window of event time, over events that are counted once, and distinct sessions that can be united.

Two jobs, one behind the other. The first drops repeated events, whatever micro-batches they come in, and appends the rest to a folder of
its own. Its state is one row per event id, until the watermark has passed the event by ``late``. The second reads that folder and
keeps running totals per window and event type until the watermark has closed the window. It writes what changed in each micro-batch,
so a total is there at once and is replaced by later ones; ``current_windows`` picks the last.

Both jobs keep their state in Spark's state store; where it outgrows the executors' memory, set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import lower_trim
from ..operators import keep_latest
from ..rules import DEFAULT_RULES, ShopRules
from ..sources import Lake
from .live import SKETCH_BITS, parse_events, replace_batch


def once_only(events: DataFrame, late: str) -> DataFrame:
    """The first copy of every event of a stream. Copies are recognised if they come at most ``late`` (in event time) after each other.
    Events without an id or a time cannot be told apart or dated and are left out; the raw copy has them."""
    told_apart = events.where(F.col("ts").isNotNull() & (F.trim("event_id") != ""))
    return told_apart.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def windowed_activity(events: DataFrame, every: str, late: str) -> DataFrame:
    """Events, units, time span and a sketch of the sessions per window and event type. An event that comes more than ``late`` after the
    newest one finds its window closed and is not counted."""
    window = F.window("ts", every)
    totals = (
        events.where(F.col("ts").isNotNull())
        .withWatermark("ts", late)
        .groupBy(window.alias("ventana"), lower_trim("event_type").alias("event_type"))
        .agg(
            F.count(F.lit(1)).alias("eventos"),
            F.sum("cantidad").alias("unidades"),
            F.min("ts").alias("primero_ts"),
            F.max("ts").alias("ultimo_ts"),
            F.hll_sketch_agg("session_id", SKETCH_BITS).alias("sesiones_boceto"),
        )
    )
    return totals.select(F.col("ventana.start").alias("desde"), F.col("ventana.end").alias("hasta"), *totals.columns[1:])


def current_windows(written: DataFrame) -> DataFrame:
    """The last total of every window of a stream, of what its micro-batches wrote."""
    return keep_latest(written, ["corrida", "desde", "event_type"], "lote").drop("lote")


def sessions(written: DataFrame, *by: str) -> DataFrame:
    """Distinct sessions (approximate) over micro-batches, windows or event types: sketches can be united, counts cannot."""
    return written.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sesiones_boceto")).alias("sesiones"))


@dataclass(frozen=True)
class WindowJobs:
    """The two jobs of one stream. ``every=None`` for a trigger works off what is there and stops."""

    lake: Lake
    stream: str = "web"
    window: str = "1 hour"
    late: str = "2 hours"
    rules: ShopRules = DEFAULT_RULES

    @property
    def events(self) -> str:
        return self.lake.bronze("eventos_web_unicos", self.stream)

    @property
    def windows(self) -> str:
        return self.lake.gold("gold_actividad_ventanas")

    def start_once(self, records: DataFrame, every: str | None = "10 seconds") -> StreamingQuery:
        names = schemas.field_names(schemas.EVENT)
        unique = once_only(parse_events(records, self.rules).select(*names), self.late)
        return (
            unique.writeStream.format("parquet")
            .option("checkpointLocation", self.lake.checkpoint("eventos_web_unicos", self.stream))
            .trigger(**_trigger(every))
            .start(self.events)
        )

    def start_windows(self, spark: SparkSession, every: str | None = "10 seconds", files_per_trigger: int | None = None) -> StreamingQuery:
        reader = spark.readStream.schema(spark.read.parquet(self.events).schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)

        def write(batch: DataFrame, batch_id: int) -> None:
            replace_batch(batch, self.windows, self.stream, batch_id, "parquet")

        return (
            windowed_activity(reader.parquet(self.events), self.window, self.late)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", self.lake.checkpoint("actividad_ventanas", self.stream))
            .trigger(**_trigger(every))
            .start()
        )


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}
