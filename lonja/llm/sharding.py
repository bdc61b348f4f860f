"""Sharding by balanced label propagation.

Documents are linked through hubs: all members of a hub are linked with each other, so that a large group needs no pairs.
Every document starts in a shard given by the hash of its id. Hubs larger than a shard's even share are laid out first, over as many
whole shards as they fill, and take no part in the rounds. In each round a hub's shards are counted, its members want to go where most
of them are, and every shard takes in what its quota (an even share of the other rows and a twentieth) has room for: wishes are granted
by the hash of the hub, so that a hub moves as a whole if it moves, and a shard that gets more wishes than room grants that share of
them. A hub that is refused in all rounds gets the shard of its largest part as its home all the same, so no hub stays scattered. Finally
the rows are laid out by shard and hub and cut into shards whose row counts differ by one at most (the law ``rows``). A hub lies in one
piece there and is split only where a cut falls into it: of the hubs that fit in a shard, at most one for each of the cuts.

Only the counts per shard (shards x shards numbers) reach the driver. The rows of a hub are never brought together: they
are counted by partial sums, and the layout is a sort by range that splits within a hub.

Defined cases: a null text has size 1, checksum 0 and no hub (no links); an empty text is a text like any other; repeated
rows and rows with a null id are placed one by one; an empty table gives an empty result; with fewer rows than shards
some shards stay empty; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import table, texts
from lonja.operators.ranking import numbered
from lonja.operators.staging import Stage

SHARDS = 16
ROUNDS = 4


def _shard_of(position: Column, rows: int, shards: int) -> Column:
    """Of the rows numbered from 0, the first ``rows % shards`` shards get one more than the others."""
    small, more = divmod(rows, shards)
    edge = more * (small + 1)
    late = more + F.floor((position - edge) / max(small, 1))
    return F.when(position < edge, F.floor(position / (small + 1))).otherwise(late).cast("int")


def _first_of(shard: Column, rows: int, shards: int) -> Column:
    small, more = divmod(rows, shards)
    return shard * small + F.least(shard, F.lit(more))


def propagate(members: DataFrame, stage: Stage, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Home shard of every hub with more than one member: hub, home. ``members`` has hub and shard, one row per document. Hubs larger
    than a shard have the home -1, ahead of all shards.

    The state is one row per hub and shard with its number of members, for hubs with more than one member."""
    counted = stage.keep(members.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n")), "counted")
    sizes = counted.groupBy("hub").agg(F.sum("n").alias("all"))
    share = (counted.agg(F.sum("n")).first()[0] or 0) / shards
    # Fewer than ``shards`` hubs are larger than an even share, so the list is small.
    large = sizes.where((F.col("all") > share) & (F.col("all") > 1)).select("hub", F.lit(-1).alias("home"))
    large = stage.keep(large, "large")
    others = counted.join(F.broadcast(large), "hub", "left_anti")
    held = {r["shard"]: r["n"] for r in others.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    quota = sum(held.values()) / shards
    room = 1.05 * quota
    linked = others.join(sizes.where("all > 1").select("hub"), "hub")
    for number in range(rounds):
        linked = stage.keep(linked, f"hubs_{number}")
        # Where most members are; among equals by chance, anew in each round, so that no shard is asked for more than others.
        most = F.max_by("shard", F.struct("n", F.xxhash64("hub", "shard", F.lit(number)))).alias("home")
        wishes = linked.join(linked.groupBy("hub").agg(most), "hub")
        flow = wishes.where("home <> shard").groupBy("home", "shard").agg(F.sum("n").alias("n")).collect()
        come, leave = dict.fromkeys(range(shards), 0), dict.fromkeys(range(shards), 0)
        for r in flow:
            come[r["home"]] += r["n"]
            leave[r["shard"]] += r["n"]
        if not flow:
            break
        granted = [min(1.0, max(0.0, room - held.get(k, 0) + leave[k]) / come[k]) if come[k] else 0.0 for k in range(shards)]
        luck = F.pmod(F.xxhash64("hub", F.lit(number)), F.lit(1 << 20)) / (1 << 20)
        goes = (F.col("home") != F.col("shard")) & (luck < F.array(*map(F.lit, granted))[F.col("home")])
        moves = stage.keep(wishes.withColumn("goes", goes), f"moves_{number}")
        for r in moves.where("goes").groupBy("home", "shard").agg(F.sum("n").alias("n")).collect():
            held[r["home"]] = held.get(r["home"], 0) + r["n"]
            held[r["shard"]] -= r["n"]
        linked = moves.groupBy("hub", F.expr("if(goes, home, shard)").alias("shard")).agg(F.sum("n").alias("n"))
    largest = F.max_by("shard", F.struct("n", F.xxhash64("hub", "shard"))).alias("home")
    return linked.groupBy("hub").agg(largest).unionByName(large)


def shard(docs: DataFrame, stage: Stage, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, hub, shard, slot for every row."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    hub = F.coalesce(F.md5(F.col("text").cast("binary")), F.concat(F.lit("none "), F.xxhash64("doc_id").cast("string")))
    # The place in the input tells equal rows apart, so that a range can be cut between them.
    rows = texts(docs).select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                              hub.alias("hub"), F.monotonically_increasing_id().alias("place"))
    rows = stage.keep(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards)).cast("int")), "members")
    homes = stage.keep(propagate(rows, stage, shards, rounds), "homes")
    wanted = rows.join(homes, "hub", "left").withColumn("shard", F.coalesce("home", "shard")).drop("home")
    order = [F.col(name).asc_nulls_first() for name in ("shard", "hub", "doc_id", "place")]
    laid, total = numbered(wanted, order, "position"), rows.count()
    laid = laid.withColumn("shard", _shard_of(F.col("position"), total, shards))
    slot = F.col("position") - _first_of(F.col("shard"), total, shards)
    return laid.select("doc_id", "size", "text_crc32", "hub", "shard", slot.cast("long").alias("slot"))


def op8_label_propagation(spark, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), Stage(spark, "sharding"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
