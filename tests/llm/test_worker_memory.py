"""What Python workers hold: rows come in small batches in all stages of the pipeline, and nothing of a task stays in its worker."""

import gc

import pyarrow as pa
import pytest

import corpus_pipeline
from lonja.llm import packing

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def batch_size(spark):
    before = spark.conf.get(BATCH)
    yield spark
    spark.conf.set(BATCH, before)


def sizes(rows):
    def count(incoming):
        for batch in incoming:
            yield pa.record_batch({"rows": pa.array([batch.num_rows], pa.int64())})

    return [r.rows for r in rows.mapInArrow(count, "rows long").collect()]


def test_a_stage_hands_over_few_rows_at_once(spark, batch_size):
    docs = spark.createDataFrame([(i, f"some words of text number {i}", "en", "s", 1) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.known_language(spark, docs, "unused").count() == 9
    assert max(sizes(spark.range(5000, numPartitions=1))) <= 1000


def test_a_smaller_setting_stays(spark, batch_size):
    spark.conf.set(BATCH, "100")
    docs = spark.createDataFrame([(1, "words", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.known_language(spark, docs, "unused")
    assert max(sizes(spark.range(500, numPartitions=1))) == 100


def test_no_worker_keeps_an_encoder(spark, stage):
    docs = spark.createDataFrame([(i, f"some words of text number {i}") for i in range(40)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs, stage).count()

    def encoders(incoming):
        list(incoming)
        found = sum(type(o).__name__ == "Encoder" for o in gc.get_objects())
        yield pa.record_batch({"n": pa.array([found], pa.int64())})

    assert [r.n for r in spark.range(8, numPartitions=4).mapInArrow(encoders, "n long").collect()] == [0] * 4
