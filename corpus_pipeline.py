"""From raw documents to packed sequences: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's documents.
All stages but the last return the columns of documents; the last returns the pieces of the packed sequences with their ids.

What a stage stores in the shared folder serves until its result is written. The next stage begins with that result, so it removes what
the one before has stored for the same tables; the rest goes at the end of the session.

An executor's memory is shared by the JVM and by Python workers that live on from stage to stage. So from the first stage on rows go to
the workers and come back a thousand at once instead of ten thousand, in the session's setting, since a stage's result is computed
when it is written; and no worker keeps a stage's words or ids when a task is done.

Defined cases: a null text has no language and goes in the first stage, as do texts without a letter; of repeated rows one stays; rows
with a null id are documents like others; very long texts are worked on whole; further columns are handed on up to the last stage; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm import decontaminate, language, lines, near_dedup, packing
from lonja.llm.common import remainder, set_smaller_batches, table
from lonja.operators.staging import Stage

ROWS_AT_ONCE = 1000
_stored: dict[str, Stage] = {}


def _fresh(spark: SparkSession, sf_dir: str, purpose: str) -> Stage:
    """A place for what a stage stores; that of the stage before it is given up."""
    if sf_dir in _stored:
        _stored.pop(sf_dir).remove()
    _stored[sf_dir] = Stage(spark, purpose)
    return _stored[sf_dir]


def _in_small_batches(work):
    """A stage whose rows, which hold whole texts, go to Python workers ``ROWS_AT_ONCE`` at once, also when its result is written."""

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        set_smaller_batches(spark, ROWS_AT_ONCE)
        return work(spark, docs, sf_dir)

    return stage


@_in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language is in doubt, go."""
    codes = language.learn(docs.select("doc_id", "text", "lang"), remainder(F.col("doc_id"), 4) != 2)
    return language.identified(docs, codes)


@_in_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return near_dedup.one_of_each(docs, _fresh(spark, sf_dir, "near"))


@_in_small_batches
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines and sentences are cut out; a document that has nothing left goes. n_chars follows the text."""
    left = lines.drop_repeats(docs, _fresh(spark, sf_dir, "lines"))
    lost_all = F.col("removed_spans").isNotNull() & (F.trim(F.regexp_replace("text", r"\s", " ")) == "")
    return left.where(~F.coalesce(lost_all, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_in_small_batches
def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), _fresh(spark, sf_dir, "templates"))


@_in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, _fresh(spark, sf_dir, "packing")).drop("kind", "worker")


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("repeated passages", without_repeats),
    ("benchmark", without_leaks),
    ("packing", packed),
]

# Trained classifiers, signatures and a tokenizer are beyond SQL: tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = table(spark, sf_dir, "documents"), Stage(spark, "pipeline")
    for number, (_, work) in enumerate(STAGES):
        docs = stage.keep(work(spark, docs, sf_dir), f"stage_{number}")
    return docs
