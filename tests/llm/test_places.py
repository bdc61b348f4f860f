"""Scans of the input that are split differently from step to step, as when an executor is lost or registered in between."""

from collections import Counter
from itertools import cycle

import pytest

from lonja.llm import decontaminate, katz, lines, near_dedup
from lonja.operators import Stage

ITEM = "The old train with many seats leaves the small town and meets another near the river bridge"


def works(spark, stage):
    from pyspark.sql import functions as F

    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    return {
        "lines": lambda docs: lines.drop_repeats(docs, stage),
        "near": lambda docs: near_dedup.one_of_each(docs, stage),
        "benchmark": lambda docs: decontaminate.clean(docs, benchmark, stage),
        "katz": lambda docs: katz.score(docs, F.col("doc_id") % 3 > 0, stage).withColumn("score", F.round("score", 6)).withColumn("base_score", F.round("base_score", 6)),
    }


@pytest.mark.parametrize("name", ["lines", "near", "benchmark", "katz"])
def test_results_do_not_depend_on_how_a_scan_is_split(spark, stage, tmp_path, monkeypatch, name):
    texts = [f"own line {i} of words\n{ITEM if i % 7 == 3 else f'other {i} text'}\ncommon line {i % 40}" for i in range(120)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.repartition(12, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    work = works(spark, stage)[name]
    expected = Counter(map(str, work(docs).collect()))
    assert expected
    keep, sizes = Stage.keep, cycle(["64k", "5m", "128m"])

    def moved(self, rows, name):
        kept = keep(self, rows, name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        return kept

    monkeypatch.setattr(Stage, "keep", moved)
    try:
        assert Counter(map(str, work(docs).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
