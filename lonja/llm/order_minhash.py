"""Document fingerprints by Order MinHash.

A text's tokens are its runs of non-white space, in pieces of at most sixteen characters. Its items are the runs of three tokens,
numbered by occurrence (the second time the same run occurs, it is another item). Every item has a hash; the hash's top bits deal the
items into ``BUCKETS`` buckets, so that one hash per item serves all sketches. Of each bucket the ``KEPT`` items with the smallest hashes
are taken in the order in which they stand in the text, and hashed together. So two texts share a bucket's value if they share its
smallest items and have them in the same order, which moving parts about undoes, as it should for edit distance.

Likeness is the share of equal values among the buckets that are not empty in both or in one of them.

Only column functions: arrays of numbers are sorted whole, and what is repeated in a text alone is looked at again to number it. The
next document (descending id) is found in one shuffle of the texts: ids are cut into blocks at sampled bounds (a number with a fixed
limit, looked up by binary search), each block is a window, and its last row finds the next block's first row as a guest.

Defined cases: a null text is the empty text; a text without tokens has an empty fingerprint, which is like another empty one (1)
and unlike all others (0); fewer than three tokens are one item; different runs
of a text whose 32-bit hashes are equal count as one run that occurs again, the same in equal texts; a place has room for every text; rows with equal ids follow each other by the hash of their text; a null
id comes last; a single row is its own next one; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.common import table, texts

TOKENS = 3
BUCKETS = 32
KEPT = 2
PLACE_BITS = 31  # of a packed item: its place in the text, all that an array can have; the 32 bits above are its hash
HASH_BITS = 63 - PLACE_BITS
MOST_BLOCKS = 1 << 16
ROWS_PER_BLOCK = 256


def _pack(value: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(value, 64 - HASH_BITS), PLACE_BITS).bitwiseOR(place.cast("long"))


def _hash(item: Column) -> Column:
    return F.shiftrightunsigned(item, PLACE_BITS)


def _bucket(item: Column) -> Column:
    return F.shiftrightunsigned(item, 63 - (BUCKETS.bit_length() - 1))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: an array with one number per non-empty bucket, its number above 32 bits of the hash, in bucket order. Each step
    is a column of its own, so that none is computed twice."""
    keep = rows.columns
    tokens, items, seen, every, few = (f"_{name}_{step}" for step in ("tokens", "items", "seen", "every", "few"))
    step = rows.withColumn(tokens, F.regexp_extract_all(F.col(text), F.lit(r"\S{1,16}"), F.lit(0)))
    last = F.greatest(F.size(tokens) - TOKENS + 1, F.lit(1))
    found = F.transform(F.sequence(F.lit(1), last), lambda i: _pack(F.xxhash64(F.slice(F.col(tokens), i, TOKENS)), i))
    step = step.withColumn(items, F.sort_array(F.when(F.size(tokens) > 0, found).otherwise(F.array().cast("array<bigint>"))))
    first = lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(F.col(items), i - 1)))
    step = step.withColumn(seen, F.filter(items, first))
    # Runs of equal hashes start where an item differs from the one before; the others in a run are numbered from there.
    places = F.sequence(F.lit(0), F.size(items) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (_hash(F.get(F.col(items), i)) != _hash(F.get(F.col(items), i - 1))))
    ends = F.concat(F.slice(starts, F.lit(2), F.size(items)), F.array(F.size(items)))
    runs = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda run: run["end"] - run["start"] > 1)

    def again(run: Column) -> Column:
        return F.transform(
            F.sequence(run["start"] + 1, run["end"] - 1),
            lambda i: _pack(
                F.xxhash64(_hash(F.get(F.col(items), i)), i - run["start"]), F.get(F.col(items), i).bitwiseAND((1 << PLACE_BITS) - 1)
            ),
        )

    repeated = F.sort_array(F.concat(F.col(seen), F.flatten(F.transform(runs, again))))
    step = step.withColumn(every, F.when(F.size(seen) == F.size(items), F.col(seen)).otherwise(repeated))
    smallest = lambda x, i: (i < KEPT) | (_bucket(x) != _bucket(F.get(F.col(every), i - KEPT)))
    step = step.withColumn(few, F.filter(every, smallest))

    def value(x: Column, i: Column) -> Column:
        other = F.get(F.col(few), i + 1)
        ordered = F.when(x.bitwiseAND((1 << PLACE_BITS) - 1) <= other.bitwiseAND((1 << PLACE_BITS) - 1), F.xxhash64(_hash(x), _hash(other)))
        pair = ordered.otherwise(F.xxhash64(_hash(other), _hash(x)))
        whole = F.when(_bucket(other) == _bucket(x), pair).otherwise(F.xxhash64(_hash(x)))
        opens = (i == 0) | (_bucket(x) != _bucket(F.get(F.col(few), i - 1)))
        return F.when(opens, F.shiftleft(_bucket(x), 32).bitwiseOR(F.shiftrightunsigned(whole, 32)))

    return step.select(*keep, F.filter(F.transform(few, value), lambda x: x.isNotNull()).alias(name))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    buckets = F.size(F.array_union(F.transform(one, lambda x: F.shiftright(x, 32)), F.transform(other, lambda x: F.shiftright(x, 32))))
    return F.when(buckets == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / buckets)


def _blocks(keys: DataFrame) -> tuple[Column, list[tuple[int, int, int]]]:
    """Block of a row's ``key``, and (key, block it is a guest of) of each block's first row. At most MOST_BLOCKS numbers are gathered."""
    rows = keys.count()
    wanted = min(MOST_BLOCKS, rows // ROWS_PER_BLOCK)
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    sample = keys.where(chance < F.lit(int((1 << 30) * min(1.0, 1.2 * wanted / max(rows, 1))))).distinct()
    bounds = sorted(r["key"] for r in sample.orderBy(F.xxhash64("key"), "key").limit(wanted).collect())
    block = F.lit(0)
    if bounds:
        steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))])
        limits = F.lit(bounds).cast("array<bigint>")
        further = lambda at, step: at + F.when(F.get(limits, at + step - 1) <= F.col("key"), step).otherwise(0)
        block = F.aggregate(steps, F.lit(0), further)
    heads = keys.select("key", block.alias("block")).groupBy("block").agg(F.max("key").alias("key")).orderBy(F.desc("block")).collect()
    hosts = [heads[i - 1]["block"] for i in range(len(heads))]  # the first row of all is a guest of the last block
    return block, [(r["key"], host) for r, host in zip(heads, hosts)]


def with_next(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) dealt out by block, in which each row but guests has its next one below it: adds block, guest, key."""
    keyed = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    block, guests = _blocks(keyed.select("key"))
    # One row per block, of which there are MOST_BLOCKS + 1 at most.
    guests = F.broadcast(rows.sparkSession.createDataFrame(guests, "head long, host int"))
    own = F.struct(block.cast("int").alias("block"), F.lit(False).alias("guest"))
    also = F.struct(F.col("host").alias("block"), F.lit(True).alias("guest"))
    placed = keyed.join(guests, F.col("key") == F.col("head"), "left").withColumn(
        "where", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, also)))
    )
    return placed.select("doc_id", "text", "key", "where.block", "where.guest").repartition("block")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (arrays), next_fingerprint for every row."""
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = with_fingerprint(with_next(rows), "text", "fingerprint")
    order = Window.partitionBy("block").orderBy("guest", F.desc("key"), F.xxhash64("text"))
    paired = placed.select(
        "doc_id", "text", "guest", "fingerprint",
        F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint"),
    ).where(~F.col("guest"))
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - half)
    edited = paired.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), half)))
    done = with_fingerprint(edited, "edited", "edited_fingerprint")
    return done.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "next_fingerprint",
    )


def op5_order_minhash(spark, sf_dir: str) -> DataFrame:
    found = fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
