"""Benchmark decontamination by templates.

Text and benchmark are brought to templates: numbers become 0, names (capitalised words inside a sentence) 1, units after a
number 2; everything else is lower-cased and loses its punctuation. Windows of five template words are hashed and joined. The
matches of a document and an item that lie on one alignment (document position minus item position) must fill the slots
consistently: one value of the item stands for one value of the document and the other way round. Then the document is
contaminated if the windows found on consistent alignments are at least ``share`` of the item's. So a question with other
numbers or names is caught, and a chance meeting of templates is not.

Only DataFrame functions are used. The windows of the benchmark are counted; up to ``most_broadcast`` of them go to every
task (a fixed size), and no text or window of a document is shuffled. Beyond that the windows meet by a shuffled hash join
that adaptive execution can split. Windows of an item with fewer than three plain words match anything and are left out.

Defined cases: a null or empty text has no windows and is clean; an item with fewer than five words, or without a telling
window, is not searched for; a document that occurs in several rows is reported per row (``place``); equal items are reported
each; an empty documents or benchmark table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import placed, table, texts
from lonja.operators.staging import Stage

WINDOW = 5
SHARE = 0.5
# Units of measure and of money that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi miles mile inches inch feet foot yards metres meters kilometres kilometers mg g kg t lb lbs oz grams "
    "kilograms pounds ounces tons ml cl l litres liters gallons s sec seconds min minutes minute h hr hours hour days day weeks "
    "week months month years year usd eur gbp dollars dollar euros euro cents cent percent pct km/h mph kmh kb mb gb tb w kw kwh v"
).split()
NUMBER = r"[0-9]+(?:[.,:][0-9]+)*"
NAME = r"(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{Ll}+"
UNIT = rf"(?<=0|0 )(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?=\s|$)"
PUNCTUATION = "".join(c for c in string.punctuation if c not in "/%") + "…“”„‘’«»–—¿¡"
SLOTS = ("0", "1", "2", "02", "0%")


def _plain(text: Column) -> Column:
    """Lower-cased words without punctuation."""
    return F.split(F.trim(F.translate(F.lower(text), PUNCTUATION, "")), " +")


def _template(text: Column) -> Column:
    """The same words, with placeholders."""
    marked = F.regexp_replace(F.regexp_replace(text, NUMBER, "0"), NAME, "1")
    return F.split(F.trim(F.regexp_replace(F.translate(F.lower(marked), PUNCTUATION, ""), UNIT, "2")), " +")


def windows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per window: keys, position, window (hash of the template), slots (hashes of what placeholders stand for, else 0)."""
    text = F.translate(F.coalesce("text", F.lit("")), "\n\t\r\f\v", " " * 5)
    split = rows.select(*keys, _template(text).alias("template"), _plain(text).alias("plain"))
    slot = F.transform("template", lambda word, i: F.when(word.isin(*SLOTS), F.xxhash64(F.get("plain", i))).otherwise(F.lit(0).cast("long")))
    slotted = split.select(*keys, "template", slot.alias("slot"))

    def at(i: Column) -> Column:
        template, slots = F.slice("template", i, WINDOW), F.slice("slot", i, WINDOW)
        return F.struct((i - 1).alias("position"), F.xxhash64(template).alias("window"), slots.alias("slots"))

    # Short texts have null here, which gives no rows. A filter on the size would be pushed below and split the text twice.
    count = F.size("template") - WINDOW + 1
    every = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), at))
    return slotted.select(*keys, F.inline(every))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, stage: Stage, share: float = SHARE, most_broadcast: int = 1_000_000,
    place: str | None = None,
) -> DataFrame:
    """doc_id, place, item_id, found and all_windows (of the item), first_word, last_word (of the document), altered (slots differ).
    ``place`` is the column of stored rows that holds it; without one it tells rows apart within the result and means nothing beyond."""
    items = windows(benchmark.select("item_id", F.col("text").cast("string").alias("text")), ["item_id"])
    telling = F.size(F.filter("slots", lambda s: s == 0)) >= 3
    items = stage.keep(items.where(telling).withColumnsRenamed({"position": "item_position", "slots": "item_slots"}), "items")
    sizes = items.groupBy("item_id").agg(F.count_distinct("item_position").alias("all_windows"))
    small = items.count() <= most_broadcast
    of_docs = windows(texts(docs, (F.col(place) if place else F.monotonically_increasing_id()).alias("place")), ["doc_id", "place"])
    met = of_docs.join(F.broadcast(items) if small else items, "window")
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda pair: pair["slots"] != 0)
    met = met.select("doc_id", "place", "item_id", "item_position", "position", pairs.alias("pairs"))
    aligned = met.groupBy("place", "doc_id", "item_id", (F.col("position") - F.col("item_position")).alias("shift")).agg(
        F.collect_set("item_position").alias("found"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
        F.min("position").alias("first_word"),
        (F.max("position") + WINDOW - 1).alias("last_word"),
    )
    one_to_one = (F.size("pairs") == F.size(F.array_distinct("pairs.item_slots"))) & (
        F.size("pairs") == F.size(F.array_distinct("pairs.slots"))
    )
    altered = F.exists("pairs", lambda pair: pair["item_slots"] != pair["slots"])
    held = aligned.where(one_to_one).groupBy("place", "doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).cast("long").alias("found"),
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.bool_or(altered).alias("altered"),
    )
    # One row per item: as small as the items themselves.
    judged = held.join(F.broadcast(sizes) if small else sizes, "item_id")
    return judged.where((F.col("found") >= share * F.col("all_windows")) & (F.col("found") >= F.least(F.lit(3), "all_windows"))).select(
        "doc_id", "place", "item_id", "found", "all_windows", "first_word", "last_word", "altered"
    )


def clean(docs: DataFrame, benchmark: DataFrame, stage: Stage, share: float = SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of the benchmark."""
    numbered = placed(docs, stage, "_clean_place")
    found = contaminated(numbered, benchmark, stage, share, place="_clean_place")
    hits = stage.keep(found.select(F.col("place").alias("_clean_place")).distinct(), "hits")
    return numbered.join(hits, "_clean_place", "left_anti").drop("_clean_place")


def op9_template_decontamination(spark, sf_dir: str) -> DataFrame:
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Stage(spark, "templates"))
    return hits.drop("place")
