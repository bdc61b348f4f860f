"""The corpus pipeline: each stage on what the one before kept, against plain versions where one exists."""

import os
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from lonja.llm import lines, near_dedup, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after every stage, from the documents on."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs.collect()]
    for number, (_, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, docs, SF_DIR).write.parquet(str(folder / str(number)))
        docs = spark.read.parquet(str(folder / str(number)))
        found.append(docs.collect())
    return found


def test_columns(kept):
    assert all(rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"] for rows in kept[:5])


def test_language_keeps_what_has_letters(kept):
    before, after = ({r.doc_id for r in rows} for rows in kept[:2])
    assert after <= before and len(after) > 0.98 * len(before)


def test_one_document_of_each_group(spark, kept, tmp_path):
    spark.createDataFrame(kept[1]).coalesce(1).write.parquet(str(tmp_path / "d"))
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
        expected = connection.execute(near_dedup.ORACLE_SQL["op3_signature_join"]).fetchdf()
    assert Counter(r.doc_id for r in kept[2]) == Counter(expected[expected.kept].doc_id.tolist())


def test_repeats_are_cut(kept):
    seen, expected = set(), {}
    for r in sorted(kept[2], key=lambda r: r.doc_id):
        starts, ends = [], []
        for start, end, digest in lines.units(r.text):
            if digest in seen:
                starts.append(start)
                ends.append(end)
            seen.add(digest)
        left = lines._without(r.text, starts, ends)
        if left.strip() or not starts:
            expected[r.doc_id] = left
    assert {r.doc_id: r.text for r in kept[3]} == expected
    assert all(r.n_chars == len(r.text) for r in kept[3])


def test_no_leaks_are_left(spark, kept):
    plain = lambda text: re.sub(r"[^\w ]", "", re.sub(r"\s+", " ", text.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in kept[3] if any(item in plain(r.text) for item in items)}
    gone = {r.doc_id for r in kept[3]} - {r.doc_id for r in kept[4]}
    assert leaks <= gone and len(gone) < 0.1 * len(kept[3])


def test_every_token_is_packed_once(kept):
    found = Counter()
    for r in kept[5]:
        found[r.doc_id] += r.length
    assert set(found) == {r.doc_id for r in kept[4]}
    assert all(found[r.doc_id] == r.doc_tokens for r in kept[5])


def test_run_gives_the_last_stage(spark, kept):
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(kept[5])


def test_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries()} == set(range(1, 11))


def test_near_duplicates_against_sql(spark):
    from check import compare, database

    verdict, _ = compare(spark, database(SF_DIR), SF_DIR, "op3_signature_join")
    assert verdict.startswith("ok"), verdict
