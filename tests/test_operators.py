import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lonja.operators import (
    Check,
    Checked,
    Stage,
    evaluated_once,
    keep_earliest,
    keep_latest,
    number_rows,
    rank_within,
    ranks_within,
    reject_summary,
    shared_folder,
)


def checked(table):
    return Checked.by(table, [Check("negativo", F.col("x") > 0), Check("grande", F.col("x") < 100)], ["x"], ["x"])


def test_null_is_rejected_and_nothing_is_lost(rows):
    table = checked(rows("x DOUBLE", 5.0, None, -1.0, 500.0))
    assert [row.x for row in table.accepted.collect()] == [5.0]
    assert {tuple(row) for row in table.rejected.collect()} == {(None, "negativo"), (-1.0, "negativo"), (500.0, "grande")}


def test_reject_summary(rows):
    summary = reject_summary({"a": checked(rows("x INT", -1, -2, 3)), "b": checked(rows("x INT", 200))})
    assert {tuple(row) for row in summary.collect()} == {("a", "negativo", 2), ("b", "grande", 1)}


def test_evaluated_once_keeps_rows_and_stops_the_filter(rows, plan):
    table = rows("x STRING", "1", "2", None)
    typed = table.select(F.regexp_extract("x", r"(\d)", 1).try_cast("int").alias("n"))
    assert sorted(row.n or 0 for row in evaluated_once(typed).collect()) == [0, 1, 2]
    assert plan(typed.where("n > 1")).count("regexp_extract") > 1 or "LocalTableScan" in plan(typed.where("n > 1"))
    spread = table.repartition(2).select(F.regexp_extract("x", r"(\d)", 1).try_cast("int").alias("n"))
    assert plan(evaluated_once(spread).where("n > 1")).count("regexp_extract") == 1


def test_latest_version_wins_and_ties_have_one_answer(rows):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    table = rows(
        "id INT, v STRING, _ingested_at TIMESTAMP", (1, "old", early), (1, "new", late), (2, "b", late), (2, "a", late)
    )
    for again in (table, table.orderBy(F.desc("v")), table.repartition(3)):
        kept = {(row.id, row.v) for row in keep_latest(again, ["id"]).collect()}
        assert kept == {(1, "new"), (2, "a")}


def test_keeping_is_idempotent(rows):
    table = rows("id STRING, ts INT, v INT", ("e", 3, 1), ("e", 1, 2), ("f", 2, 3), ("e", 1, 9))
    once = keep_earliest(table, ["id"], ["ts"])
    assert {tuple(row) for row in once.collect()} == {("e", 1, 2), ("f", 2, 3)}
    assert sorted(keep_earliest(once, ["id"], ["ts"]).collect()) == sorted(once.collect())


def test_copies_are_dropped_before_the_shuffle(rows, plan):
    text = plan(keep_latest(rows("id INT, _ingested_at INT", (1, 1)).repartition(3), ["id"]))
    before_shuffle = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < before_shuffle


def brute_rank(values, group=lambda row: 0):
    def ahead(a, b):
        if a is None:
            return b is not None
        return b is not None and b > a

    return [1 + sum(group(o) == group(r) and ahead(r[1], o[1]) for o in values) for r in values]


@pytest.fixture
def skewed():
    """Every third value is the same, some are NULL, one group is a third of all rows, one group has no name."""
    rng = random.Random(7)
    return [
        (i, None if i % 50 == 0 else 10 if i % 3 == 0 else rng.randint(-40, 40), "a" if i % 3 == 1 else rng.choice(["b", "c", None]))
        for i in range(400)
    ]


def test_rank_over_the_whole_table(rows, skewed):
    ranked = rank_within(rows("i INT, v INT, g STRING", *skewed), "v", "r").collect()
    assert {row.i: row.r for row in ranked} == {row[0]: rank for row, rank in zip(skewed, brute_rank(skewed))}


def test_rank_inside_groups(rows, skewed):
    ranked = rank_within(rows("i INT, v INT, g STRING", *skewed), "v", "r", by=["g"]).collect()
    expected = brute_rank(skewed, group=lambda row: row[2])
    assert {row.i: row.r for row in ranked} == {row[0]: rank for row, rank in zip(skewed, expected)}
    assert len(ranked) == len(skewed)


def test_both_ranks_at_once(rows, skewed):
    table = rows("i INT, v INT, g STRING", *skewed)
    by_id = {row.i: row.r for row in ranks_within(table, "v", {"r": ["i"], "s": ["g"]}).collect()}
    assert set(by_id.values()) == {1}
    apart = ranks_within(table.withColumn("h", F.col("i") % 2), "v", {"here": ["g"], "half": ["h"]}).collect()
    halves = brute_rank(skewed, group=lambda row: row[0] % 2)
    assert {row.i: row.half for row in apart} == {row[0]: rank for row, rank in zip(skewed, halves)}
    ranked = ranks_within(table, "v", {"all": [], "here": ["g"]}).collect()
    here, everywhere = brute_rank(skewed, group=lambda row: row[2]), brute_rank(skewed)
    assert {row.i: (row.here, row["all"]) for row in ranked} == {
        row[0]: ranks for row, *ranks in zip(skewed, zip(here, everywhere)) for ranks in ranks
    }


def test_numbering_is_a_permutation_in_order(rows, skewed):
    numbered = number_rows(rows("i INT, v INT, g STRING", *skewed), "v", ["i"], "r").collect()
    expected = sorted(skewed, key=lambda row: (row[1] is None, -(row[1] or 0), row[0]))
    assert [row.i for row in sorted(numbered, key=lambda row: row.r)] == [row[0] for row in expected]
    assert sorted(row.r for row in numbered) == list(range(1, len(skewed) + 1))


def test_ranking_an_empty_table(rows):
    empty = rows("i INT, v INT", (1, 1)).where("i > 1")
    assert rank_within(empty, "v", "r").collect() == []
    assert number_rows(empty, "v", ["i"], "r").collect() == []


def test_ranking_sends_no_table_to_one_task(rows, skewed, plan):
    """Only the row counts of the ranges meet in one task, and no row is held against all ranges."""
    table = rows("i INT, v INT, g STRING", *skewed).repartition(4)
    for ranked in (rank_within(table, "v", "r"), number_rows(table, "v", ["i"], "r")):
        text = plan(ranked)
        assert "TakeOrderedAndProject" not in text and "filter(" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        for line in text.splitlines():
            assert "SinglePartition" not in line or "Exchange SinglePartition" in line, line
        assert text.count("Exchange SinglePartition") <= text.count("_rank_before")


def test_ranks_do_not_depend_on_the_number_of_ranges(spark, rows, skewed):
    table = rows("i INT, v INT, g STRING", *skewed)
    expected = {row.i: row.r for row in rank_within(table, "v", "r", ["g"]).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert {row.i: row.r for row in rank_within(table, "v", "r", ["g"]).collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stage_keeps_and_removes(spark, rows):
    with Stage(spark, "test") as stage:
        kept = stage.keep(rows("a INT, b STRING", (1, "x"), (2, None)), "t")
        assert {tuple(row) for row in kept.collect()} == {(1, "x"), (2, None)}
        assert stage.path.startswith(shared_folder(spark))
        files = spark.read.format("binaryFile").load(stage.at("t"))
        assert files.count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(stage.at("t"))
