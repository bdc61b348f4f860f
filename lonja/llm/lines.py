"""Substring deduplication by hashing lines and the sentences of long lines.

A text is cut into units: at every line break, and inside a line after a sentence end (after the full stops of Chinese and Japanese
also without a space). A whole line is a unit however short it is. Inside a line, sentences of fewer than ``least_words`` words are
put together; if that gives fewer still, the unit is compared together with the words of the next one (at the end of a line, of the
one before), which has a digest of its own words besides. Long sentences are cut further after words chosen by their hash. The cuts
depend on the words near them alone, so a passage gives the same units wherever it stands. A unit's digest is taken over its words,
lower-cased, without punctuation; a Chinese character or a kana counts as a word. A line without words is taken as it is. Digests are
grouped over the whole corpus; of each, the occurrence with the smallest (doc_id, offset) stays and all others are removed. What is
left keeps its text; the removed spans are given with their original offsets (in code points).

The shuffles carry digests and places, not texts: the groups are made by partial aggregation, so a unit that a third of all
documents hold sends one row per task; only digests that occur more than once are joined back, with one row per digest on
their side, so that the other side can be split. The text moves once, to meet its document's spans. Rows are known by their file and
their index in it, so texts are not written again to be numbered.

Defined cases: a null text stays null and has no units; a line of white space alone is no unit; repeats within a document count; repeated rows (equal id) are told apart
by their place in the files, and the first keeps its text; rows with a null id come last in the order; a text that loses all units is empty; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import batches, identified, table, texts
from lonja.operators.staging import Stage

LEAST_WORDS = 5
# A sentence of more words is cut further: where a piece has LEAST_PIECE words, after one word in ONE_IN, chosen by its hash.
LONG_SENTENCE = 24
LEAST_PIECE = 6
ONE_IN = 4
_SENTENCE = re.compile(r"[.!?…]+[\"')\]»”’]*(?:\s+|$)|[。！？｡]+[\"')\]»”’」』）]*\s*")
# A character of a script without spaces (kana, Chinese) is a word of its own.
_UNSPACED = "\u3041-\u3096\u30a1-\u30fa\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def _sentence(line: str, start: int, end: int) -> Iterator[tuple[int, int, list[str]]]:
    """A sentence as one piece, or a long one in pieces that end at words whose hash says so."""
    words = _WORD.findall(line, start, end)
    if len(words) <= LONG_SENTENCE:
        yield start, end, words
        return
    piece: list[str] = []
    for match in _WORD.finditer(line, start, end):
        piece.append(match.group())
        if len(piece) >= LEAST_PIECE and crc32(piece[-1].lower().encode()) % ONE_IN == 0:
            yield start, match.end(), piece
            start, piece = match.end(), []
    if start < end:
        yield start, end, piece


def _pieces(line: str) -> Iterator[tuple[int, int, list[str]]]:
    at = 0
    for match in _SENTENCE.finditer(line):
        yield from _sentence(line, at, match.end())
        at = match.end()
    if at < len(line):
        yield from _sentence(line, at, len(line))


def _line_units(line: str, start: int, least_words: int) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words to compare) of the units of one line; they cover it whole."""
    begin, held, before = 0, [], None
    for first, end, words in _pieces(line):
        if held and len(words) >= least_words:
            if before:
                yield before
            before = (start + begin, start + first, held + words)
            begin, held = first, []
        held = held + words if held else words
        if len(held) >= least_words:
            if before:
                yield before
            before = (start + begin, start + end, held)
            begin, held = end, []
    if before and not held:  # what has no words goes with the unit before
        yield before[0], start + len(line), before[2]
    elif before:
        yield before
        yield start + begin, start + len(line), before[2] + held
    elif line:
        yield start, start + len(line), held


def units(text: str, least_words: int = LEAST_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and digest of the units. ``least_words`` holds for sentences inside a line. A unit that is a whole line ends behind the
    line's break."""
    start = 0
    for line in text.split("\n"):
        stop = start + len(line)
        if not line.isspace():
            for begin, end, words in _line_units(line, start, least_words):
                whole = begin == start and end == stop < len(text)
                yield begin, end + whole, xxhash.xxh3_128_digest((" ".join(words) or line.strip()).lower())
        start = stop + 1


def repeats(rows: DataFrame, stage: Stage, least_words: int = LEAST_WORDS) -> DataFrame:
    """file, row, start, end of every unit but the first of its digest. ``rows`` has doc_id, text, file and row."""
    names = ("digest", "doc_id", "file", "row", "start", "end")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out = {name: [] for name in names}
        for doc_id, text, file, row in zip(*[c.to_pylist() for c in batch.columns]):
            for start, end, digest in units(text or "", least_words):
                for name, value in zip(names, (digest, doc_id, file, row, start, end)):
                    out[name].append(value)
            if len(out["start"]) >= 50_000:
                yield out
                out = {name: [] for name in names}
        yield out

    found = batches(rows, cut, "digest binary, doc_id long, file long, row long, start int, end int")
    found = stage.keep(found, "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row", "start")
    first = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first")).where("n > 1")
    first = stage.keep(first.select("digest", *[F.col(f"first.{name}").alias(f"first_{name}") for name in ("file", "row", "start")]), "first")
    later = "file <> first_file OR row <> first_row OR start <> first_start"
    return found.drop("doc_id").join(first, "digest").where(later).select("file", "row", "start", "end")


def drop_repeats(docs: DataFrame, stage: Stage, least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of ``docs`` with what is left of the text, and removed_spans: structs of start and end in text order, or null. What is
    left is the text without its spans. A column of ``docs`` that is called removed_spans is replaced.

    Rows are told apart by their file and place in it; only rows that do not come from files as they are are stored once more."""
    named = identified(docs, stage, "_lines_file", "_lines_row")
    rows = texts(named, F.col("_lines_file").alias("file"), F.col("_lines_row").alias("row"))
    spans = repeats(rows, stage, least_words).groupBy(F.col("file").alias("_lines_file"), F.col("row").alias("_lines_row"))
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_lines_spans"))
    joined = named.join(spans, ["_lines_file", "_lines_row"], "left").drop("_lines_file", "_lines_row")

    @F.arrow_udf("string")
    def left(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        rows = zip(text.to_pylist(), starts.to_pylist(), ends.to_pylist())
        return pa.array([t if t is None or s is None else _without(t, s, e) for t, s, e in rows], pa.string())

    cut = joined.withColumn("text", left(F.col("text").cast("string"), "_lines_spans.start", "_lines_spans.end"))
    return cut.withColumn("removed_spans", F.col("_lines_spans")).drop("_lines_spans")


def _without(text: str, starts: list[int], ends: list[int]) -> str:
    """The text between the spans."""
    parts, at = [], 0
    for start, end in zip(starts, ends):
        parts.append(text[at:start])
        at = end
    return "".join(parts) + text[at:]


def op10_line_hashing(spark, sf_dir: str) -> DataFrame:
    left = drop_repeats(texts(table(spark, sf_dir, "documents")), Stage(spark, "lines"))
    spans = F.coalesce("removed_spans", F.array().cast("array<struct<start:int,end:int>>"))
    return left.select("doc_id", "text", F.size(spans).alias("n_removed"), spans["start"].alias("removed_start"), spans["end"].alias("removed_end"))
