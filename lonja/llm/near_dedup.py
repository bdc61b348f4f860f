"""Near duplicates: an inverted join over the coordinates of MinHash signatures.

A document's set holds the hashes of its distinct two-word shingles; equal sets become one node. A node's signature has
``COORDINATES`` values, of which two nodes with similarity s share s * COORDINATES on average. Nodes are posted under their values
and pairs that share at least ``MATCHES`` values are compared on their full sets. (At similarity 0.8, 64 values miss 38 matches with a
probability of about one in 30,000, at 0.85 below one in ten million.)

Prefix: a value that one node alone has cannot match. Of the s values that a node shares with others, two nodes with MATCHES common
values must meet under one of the s - MATCHES + 1 rarest; only these are posted, so long lists (common phrases) are hardly
touched. Skip: the values left out are not merged but looked up in the two nodes' value lists when a pair is counted.

Lists of at most ``SHORT`` nodes give all their pairs. A longer list is not paired out: its members are compared with ``CHOSEN`` of
them (the same for lists that share them), which joins most of a group of copies; then only lists that still hold several components
go on. After ``ROUNDS`` rounds, what is left is settled exactly: the members of the open lists are posted under the elements of their
full sets, the rarest first and no more than a link leaves room for. A pair of different components is compared only if, behind the
element where it meets, both sets are still long enough for a link. No link between components of these lists is lost.

Two exact tests keep pairs from the comparison, and lose none. Sizes: a link needs sets of which the smaller has at least four fifths
of the larger. Parity: each set has ``PARITY`` bits, each the parity of the number of its elements that fall there; what two sets have in
common cancels out, so they differ in at least as many elements as bits, and in a link no more than a ninth of both sizes differs.

The full sets are made once, for nodes that a comparison can need, and stored in buckets by node, so that comparing does not shuffle
them again.

Defined cases: a null text, or one without words, has no set, is linked with nothing and is kept; one word alone is the set of
that word; repeated rows have equal sets, hence one component; a row with a null id gets the component of its text; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import Hashes, batches, placed, smaller_batches, table, texts
from lonja.llm.components import stars
from lonja.operators.staging import Stage

COORDINATES = 64
MATCHES = 38
SHORT = 16
CHOSEN = 3
ROUNDS = 1
PARITY = 512
SLICE = 250  # rows a task works on at once

_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 2**63, COORDINATES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64)[:, None]


def shingles(text: str | None, hashes: Hashes | None = None) -> np.ndarray:
    """Sorted hashes of the distinct pairs of neighbouring words; of a single word, its own."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space alone
    values = np.fromiter(map((Hashes() if hashes is None else hashes).__getitem__, words), np.uint64, len(words))
    if len(words) > 1:
        second = values[1:]
        values = values[:-1] * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(32)
    return np.unique(values)


def signature(values: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 4096):
        mixed = values[None, start : start + 4096] * _FACTORS + _TERMS
        mixed ^= mixed >> np.uint64(31)
        least = np.minimum(least, mixed.min(1))
    return least


def parity(values: np.ndarray) -> np.ndarray:
    """For each of PARITY bits, whether an odd number of the hashes falls there."""
    counts = np.bincount((values % np.uint64(PARITY)).astype(np.int64), minlength=PARITY)
    return np.packbits(counts % 2 == 1).view(np.int64)


def _signed(batch: pa.RecordBatch, hashes: Hashes) -> Iterator[dict]:
    for start in range(0, batch.num_rows, SLICE):
        part = batch.slice(start, SLICE)
        sizes, digests, values, bits = [], [], [], []
        for text in part.column(2):
            found = shingles(text.as_py(), hashes)
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            values.append(signature(found).view(np.int64) if len(found) else None)
            bits.append(parity(found) if len(found) else None)
        yield {
            "place": part.column(0), "doc_id": part.column(1), "n_shingles": sizes, "digest": digests, "signature": values, "parity": bits
        }


def _sets(batch: pa.RecordBatch, hashes: Hashes) -> Iterator[dict]:
    for start in range(0, batch.num_rows, SLICE):
        part = batch.slice(start, SLICE)
        yield {"node": part.column(0), "hashes": [shingles(text.as_py(), hashes).tobytes() for text in part.column(1)]}


def _elements(batch: pa.RecordBatch) -> Iterator[dict]:
    for start in range(0, batch.num_rows, 500):
        part = batch.slice(start, 500)
        sets = [np.frombuffer(hashes, np.int64) for hashes in part.column(1).to_pylist()]
        sizes = np.array([len(one) for one in sets], np.int64)
        nodes = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
        yield {"node": nodes, "n": np.repeat(sizes, sizes), "element": np.concatenate(sets)}


def _compared(batch: pa.RecordBatch) -> Iterator[dict]:
    linked = []
    for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
        common = len(np.intersect1d(x, y, assume_unique=True))
        linked.append(100 * common >= 80 * (len(x) + len(y) - common))
    yield {"a": batch.column(0), "b": batch.column(1), "linked": linked}


_SIZES = "5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)"  # of sets that can be linked
_PARITIES = f"9 * ({' + '.join(f'bit_count(a_parity[{i}] ^ b_parity[{i}])' for i in range(PARITY // 64))}) <= a_n + b_n"  # the same


class _Graph:
    """Postings, value lists and sets of the nodes that can be in a pair."""

    def __init__(self, nodes: DataFrame, rows: DataFrame, stage: Stage):
        self.stage = stage
        every = nodes.select("node", "n_shingles", F.explode("signature").alias("key"))
        shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        lists = every.join(shared, "key").groupBy("node", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
        lists = lists.where(F.size("keys") >= MATCHES).join(nodes.select("node", "parity"), "node")
        self.lists = stage.keep(lists, "lists")
        prefix = F.slice("keys", 1, F.size("keys") - MATCHES + 1)
        posted = self.lists.select("node", "n_shingles", F.explode(prefix["key"]).alias("key"))
        sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("posted")).where("posted > 1")
        self.posted = stage.keep(posted.join(sizes, "key"), "postings")
        self.long = self.posted.where(F.col("posted") > SHORT).drop("posted")
        self.rows, self.sets = rows, None
        self.name = "near_sets_" + uuid.uuid4().hex

    def short_pairs(self) -> DataFrame:
        short = self.posted.where(F.col("posted") <= SHORT).drop("posted")
        a, b = (short.select("key", F.col("node").alias(x), F.col("n_shingles").alias(f"{x}_n")) for x in ("a", "b"))
        return a.join(b, "key").where(f"a < b AND {_SIZES}").select("a", "b")

    def _keep_sets(self, counted: DataFrame) -> DataFrame:
        """Sets of the nodes of these pairs and of all members of long lists: later pairs are among them. Rows and nodes are dealt out
        to the buckets before they are joined, so the text moves once."""
        nodes = counted.select(F.col("a").alias("node")).union(counted.select("b")).union(self.long.select("node"))
        session = self.rows.sparkSession
        number = int(session.conf.get("spark.sql.shuffle.partitions"))
        rows = self.rows.withColumnRenamed("place", "node").repartition(number, "node")
        needed = rows.join(nodes.distinct().repartition(number, "node"), "node", "left_semi")
        name = self.name
        made = batches(needed.select("node", "text"), partial(_sets, hashes=Hashes()), "node long, hashes binary")
        made.write.bucketBy(number, "node").option("path", self.stage.at(name)).saveAsTable(name)
        return session.table(name)

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of candidate pairs, those that share enough values and whose sets are similar enough."""
        carried = {"n": "n_shingles", "parity": "parity", "keys": "keys.key"}
        one, other = (
            self.lists.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{to}") for to, c in carried.items()]) for x in ("a", "b")
        )
        counted = pairs.distinct().join(one, "a").join(other, "b").where(_PARITIES)
        counted = counted.where(F.size(F.array_intersect("a_keys", "b_keys")) >= MATCHES).select("a", "b")
        counted = self.stage.keep(counted, f"{name}_counted")
        self.sets = self.sets or self._keep_sets(counted)
        return self.linked(counted)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Of pairs of nodes whose sets are stored, those that are similar enough."""
        one = self.sets.select(F.col("node").alias("a"), F.col("hashes").alias("a_set"))
        other = self.sets.select(F.col("node").alias("b"), F.col("hashes").alias("b_set"))
        both = pairs.join(one, "a").join(other, "b").select("a", "b", "a_set", "b_set")
        return batches(both, _compared, "a long, b long, linked boolean").where("linked").select("a", "b")

    def possible_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of members of different components that can still be linked, by their full sets. A link of sets of n and m elements
        has at least 4/9 (n + m) in common, hence 4/5 of each; ``ahead`` are the elements of a set from the meeting place on that
        others have too, in the common order (rarest first)."""
        nodes = self.stage.keep(members.select("node", "component").distinct(), "open_nodes")
        sets = self.sets.join(nodes, "node", "left_semi").select("node", "hashes")
        every = batches(sets, _elements, "node long, n long, element long")
        often = every.groupBy("element").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
        lists = every.join(often, "element").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "element"))).alias("shared"))
        spare = F.expr("CAST(size(shared) - (4 * n + 4) DIV 5 AS INT)")
        first = lists.where(spare >= 0).withColumn("room", spare + 1).withColumn("size", F.size("shared"))
        first = first.select("node", "n", "size", F.posexplode(F.slice("shared", 1, F.col("room"))).alias("place", "item"))
        posted = first.select("node", "n", (F.col("size") - F.col("place")).alias("ahead"), F.col("item.element").alias("element"))
        nodes = nodes.join(self.lists.select("node", "parity"), "node")
        posted = self.stage.keep(posted.join(nodes, "node"), "open_postings")
        parts = posted.groupBy("element", "component").agg(F.count(F.lit(1)).alias("members"))
        largest = parts.groupBy("element").agg(F.max_by("component", F.struct("members", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"))
        several = posted.join(largest.where("parts > 1").drop("parts"), "element")
        kept = ("node", "n", "ahead", "component", "parity")
        a = several.where("component <> largest").select("element", *[F.col(c).alias(f"a_{c}") for c in kept])
        b = several.select("element", "largest", *[F.col(c).alias(f"b_{c}") for c in kept])
        enough = "9 * least(a_ahead, b_ahead) >= 4 * (a_n + b_n) AND " + _PARITIES
        pairs = a.join(b, "element").where(f"a_component <> b_component AND (b_component = largest OR a_node < b_node) AND {enough}")
        return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _with_chosen(members: DataFrame, free: DataFrame, number: int) -> DataFrame:
    """Pairs of each list's members with some of its ``free`` members, by the hash of the node."""
    node = F.struct("node", "component", "n_shingles")
    chosen = free.groupBy("key").agg(*[F.min_by(node, F.xxhash64("node", F.lit(number * CHOSEN + i))).alias(f"c{i}") for i in range(CHOSEN)])
    chosen = chosen.select("key", F.explode(F.array_distinct(F.array(*[f"c{i}" for i in range(CHOSEN)]))).alias("one"))
    sized = _SIZES.replace("a_n", "n_shingles").replace("b_n", "one.n_shingles")
    pairs = members.join(chosen, "key").where(f"component <> one.component AND {sized}")
    return pairs.select(F.least("node", "one.node").alias("a"), F.greatest("node", "one.node").alias("b"))


def _with_components(members: DataFrame, found: DataFrame) -> DataFrame:
    """Lists that hold several components, each member with its component."""
    named = members.select("key", "node", "n_shingles").join(found.select(F.col("a").alias("node"), F.col("b").alias("star")), "node", "left")
    named = named.select("key", "node", "n_shingles", F.coalesce("star", "node").alias("component"))
    open_lists = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return named.join(open_lists.select("key"), "key")


def components(nodes: DataFrame, rows: DataFrame, stage: Stage) -> DataFrame:
    """(a, b): node and smallest node of its component, for the nodes that are not the smallest of theirs. ``nodes`` has node,
    n_shingles, signature and parity, ``rows`` place and text."""
    graph = _Graph(nodes, rows, stage)
    members = graph.long.withColumn("component", F.col("node"))
    found = stars(graph.links(graph.short_pairs().unionByName(_with_chosen(members, members, 0)), "first"), stage, "first")
    members = stage.keep(_with_components(members, found), "long_0")
    for number in range(1, ROUNDS + 1):
        if members.isEmpty():
            break
        parts = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
        pairs = _with_chosen(members, members.join(largest, "key").where("component <> largest").drop("largest"), number)
        found = stars(found.unionByName(graph.links(pairs, f"round_{number}")), stage, f"round_{number}")
        members = stage.keep(_with_components(members, found), f"long_{number}")
    if not members.isEmpty():
        found = stars(found.unionByName(graph.linked(graph.possible_pairs(members))), stage, "last")
    rows.sparkSession.sql(f"DROP TABLE IF EXISTS {graph.name}")  # its files stay in the stage's folder and go with it
    return found


def near_duplicates(docs: DataFrame, stage: Stage, place: str | None = None) -> DataFrame:
    """place, doc_id, n_shingles, component_id, kept and component (a number of its own) for every row. ``place`` is the column of
    stored rows that holds it; without one, the rows are numbered and stored here."""
    if place is None:
        docs, place = placed(texts(docs), stage, "_near_place"), "_near_place"
    rows = texts(docs, F.col(place).alias("place")).select("place", "doc_id", "text")
    made = "place long, doc_id long, n_shingles long, digest binary, signature array<bigint>, parity array<bigint>"
    signed = batches(rows, partial(_signed, hashes=Hashes()), made)
    with smaller_batches(docs.sparkSession):
        signed = stage.keep(signed, "signed")
    nodes = signed.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("place").alias("node"), F.min("doc_id").alias("least_id"),
        *[F.any_value(c).alias(c) for c in ("n_shingles", "signature", "parity")],
    )
    nodes = stage.keep(nodes, "nodes")
    with smaller_batches(docs.sparkSession):
        found = components(nodes.select("node", "n_shingles", "signature", "parity"), rows.select("place", "text"), stage)
    named = nodes.select("digest", "node", "least_id").join(found.select(F.col("a").alias("node"), F.col("b").alias("star")), "node", "left")
    named = stage.keep(named.select("digest", "least_id", F.coalesce("star", "node").alias("component")), "named")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    slim = signed.select("place", "doc_id", "n_shingles", "digest")
    with_set = slim.join(named.join(ids, "component").select("digest", "component_id", "component"), "digest").drop("digest")
    without = slim.where(F.col("digest").isNull()).select(
        "place", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("place").alias("component")
    )
    every = with_set.unionByName(without)
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, stage: Stage) -> DataFrame:
    """The rows of ``docs`` with one document of each group: that with the smallest id, of repeated rows the first."""
    numbered = placed(docs, stage, "_near_place")
    judged = near_duplicates(numbered, stage, "_near_place")
    stay = judged.groupBy("component").agg(F.min_by("place", F.struct(~F.col("kept"), "place")).alias("_near_place"))
    return numbered.join(stay.select("_near_place"), "_near_place", "left_semi").drop("_near_place")


def op3_signature_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Stage(spark, "near")).drop("place", "component")


# Exact: every pair of documents that share a shingle, counted on full sets. For small tables.
ORACLE_SQL = {
    "op3_signature_join": """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s
    FROM words
), content AS (SELECT list_sort(s) AS s, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY 1),
items AS (SELECT node, len(s) AS n, unnest(s) AS item FROM content),
often AS (SELECT item, count(*) AS df FROM items GROUP BY item),
ranked AS (
    SELECT i.node, i.n, i.item, row_number() OVER (PARTITION BY i.node ORDER BY o.df, i.item) AS r FROM items i JOIN often o USING (item)
), prefixes AS (SELECT * FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
candidates AS (
    SELECT DISTINCT a.node AS a, b.node AS b FROM prefixes a JOIN prefixes b ON a.item = b.item AND a.node < b.node
    WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS (
    SELECT c.a, c.b FROM candidates c JOIN content x ON x.node = c.a JOIN content y ON y.node = c.b
    WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node, node AS other FROM content UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON w.a = r.other),
found AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(f.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(f.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN content c ON c.s = list_sort(s.s) AND len(s.s) > 0 LEFT JOIN found f ON f.node = c.node""",
}
