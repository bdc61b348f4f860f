import pytest

from lonja.operators import Stage

LONG = " ".join(f"word{i} of a very long text." for i in range(4000))

# Nulls, empty and long texts, ties, repeated rows, a null id, unspaced and accented text.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, "The quick brown fox jumps over the lazy dog and runs away."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, "ONE"),
    (8, "12 + 34 = 46"),
    (9, LONG),
    (10, LONG + " more"),
    (11, "ñandú  zwei\n\nÉTÉ <|endoftext|> 漢字かな交じり文 x"),
    (None, "a text without an id"),
    (None, None),
]


@pytest.fixture
def odd(spark):
    """Odd rows, with further columns whose names an operator may use itself."""
    rows = [(i, t, "en" if i and i % 2 else None, "s", 1.0, "x", 0, 7) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, place string, start int, n_chars long")


@pytest.fixture
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture
def stage(spark):
    with Stage(spark, "test") as stage:
        yield stage


@pytest.fixture
def written(spark, tmp_path):
    """A table as it is read from files, over several tasks."""

    def write(rows, name="rows", parts=3):
        path = str(tmp_path / f"{name}.parquet")
        rows.repartition(parts).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write
