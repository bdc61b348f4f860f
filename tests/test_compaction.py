"""Micro-batches joined by day: every row is seen once, before, between and after."""

import pytest
from pyspark.sql import functions as F

from lonja.streaming import compaction
from lonja.streaming.live import replace_batch

def day():
    return F.to_date("ts")


@pytest.fixture
def table(spark, rows, tmp_path):
    path = str(tmp_path / "table")

    def write(stream, *numbers, value=0):
        for number in numbers:
            batch = rows("ts TIMESTAMP, n INT").union(spark.sql(f"SELECT TIMESTAMP'2024-05-01 10:00:00' + make_dt_interval({number % 3}) AS ts, {number + value} AS n"))
            replace_batch(batch, path, stream, number, "parquet")
        return path

    return write


def seen(spark, path):
    return sorted((r.corrida, r.lote, r.n) for r in compaction.read_stream(spark, path).collect())


def test_fifty_batches_become_a_few_files(spark, table, tmp_path):
    path = table("web", *range(50))
    table("app", 0, 1)
    before = seen(spark, path)
    assert compaction.compact(spark, path, day()) == 50 and seen(spark, path) == before
    left = list((tmp_path / "table").rglob("part-*.parquet"))
    assert len(left) <= 2 + 3 * 2
    table("web", 50, 51)
    assert len(seen(spark, path)) == 54
    assert compaction.compact(spark, path, day()) == 2 and len(seen(spark, path)) == 54
    assert compaction.compact(spark, path, day()) == 0


def test_a_replay_of_the_last_batch_replaces_it(spark, table):
    path = table("web", 0, 1, 2)
    compaction.compact(spark, path, day())
    table("web", 2, value=100)
    assert seen(spark, path) == [("web", 0, 0), ("web", 1, 1), ("web", 2, 102)]


@pytest.mark.parametrize("at", ["before the marker", "before the removal"])
def test_a_run_that_dies_changes_nothing(spark, table, monkeypatch, at):
    path = table("web", 0, 1, 2, 3)
    before = seen(spark, path)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if at == "before the removal":
            patch.setattr(compaction, "clean", die)
        else:
            patch.setattr(type(spark), "createDataFrame", die)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, path, day())
    assert seen(spark, path) == before
    compaction.compact(spark, path, day())
    compaction.clean(spark, path)
    assert seen(spark, path) == before


def test_nothing_to_join(spark, tmp_path):
    path = str(tmp_path / "none")
    assert compaction.compact(spark, path, day()) == 0
    with pytest.raises(LookupError):
        compaction.read_stream(spark, path)
    with pytest.raises(ValueError):
        compaction.compact(spark, path, day(), keep=0)
