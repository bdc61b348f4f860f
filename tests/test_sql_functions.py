import pytest

from lonja.functions import register_functions
from lonja.functions.in_sql import FUNCTIONS

# Values that the cleansing rules name, and what is not text of the kind at all.
VALUES = (
    None, "", " ", "1.234,50 EUR", "€1,50", "1,234.5", "12 units", "nan", "1e3", "-3", "+4.9", ".5", "EU 36", " T38 ", "37,5", "talla 40",
    "XL", "136", "2024-03-01", "05/11/2023", "05-11-2023", "05.11.2023", "05/11-2023", "31/02/2024", "2024-05-01T10:00:00",
    "2024-05-01T10:00:00Z", "2024-05-01 10:00:00 Etc/UTC", "ayer", "a@x.es", "a@x", " A@X.ES ", "don't \\d", "josé ÁLVAREZ", "\n", "😀",
)


@pytest.fixture(scope="module")
def known(spark):
    return register_functions(spark)


@pytest.mark.parametrize("name", FUNCTIONS)
def test_a_function_equals_its_column(spark, known, name):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i INT, text STRING")
    ours = spark.sql(f"SELECT i, {name}(text) AS found FROM {{rows}}", rows=rows)
    theirs = rows.select("i", FUNCTIONS[name]("text").alias("found"))
    assert ours.schema["found"].dataType == theirs.schema["found"].dataType
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_functions_are_inlined(spark, known, plan):
    used = plan(spark.sql("SELECT clean_price(CAST(id AS STRING)) AS p FROM range(3)"))
    assert "clean_price(" not in used.split("AS p")[0] and "Python" not in used


def test_registering_again_replaces(spark, known):
    assert register_functions(spark) == known
