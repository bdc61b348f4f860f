"""States that grow by ingest days, and rejects for what other rows hold."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lonja.operators import Check, Checked, First, KeyedState, Known, keep_latest
from lonja.operators.staging import delete
from lonja.operators.quality import REASON
from lonja.sources import stamped, write_snapshot

DAYS = [datetime(2024, 1, d, 8) for d in (1, 2, 3)]


@pytest.fixture
def bronze(spark, rows, tmp_path):
    """Writes the rows of a day and gives all days."""
    path = str(tmp_path / "bronze")

    def write(at, *values):
        write_snapshot(stamped(rows("id INT, x STRING", *values), "db", at), path)
        return spark.read.parquet(path)

    return write


def state_of(spark, tmp_path, **options):
    return KeyedState(spark, str(tmp_path / "state"), ["id"], **options)


def held(state):
    return {(r.id, r.x) for r in state.rows().collect()}


def test_a_state_is_what_all_days_give(spark, bronze, tmp_path):
    state = state_of(spark, tmp_path)
    with pytest.raises(LookupError):
        state.rows()
    days = [[(1, "a"), (2, "b"), (3, None)], [(2, "B"), (4, "d")], [(1, "A"), (5, "e"), (3, "c")]]
    for at, values in zip(DAYS, days):
        everything = bronze(at, *values)
        state.update(everything, ["x"])
        assert held(state) == {(r.id, r.x) for r in keep_latest(everything, ["id"]).collect()}
        assert state.through == at.date()


def test_the_third_run_reads_one_day(spark, bronze, tmp_path, plan):
    state = state_of(spark, tmp_path)
    for at in DAYS[:2]:
        state.update(bronze(at, (1, "a")))
    everything = bronze(DAYS[2], (1, "c"), (2, "d"))
    new = state.behind(everything, state.through)
    assert "PartitionFilters: [isnotnull(_ingest_date" in plan(new) and "2024-01-02" in plan(new)
    assert {r._ingest_date for r in new.collect()} == {date(2024, 1, 3)}


def test_a_day_that_is_ingested_again_replaces_what_it_gave(spark, bronze, tmp_path):
    state = state_of(spark, tmp_path)
    state.update(bronze(DAYS[0], (1, "a"), (2, "b")))
    state.update(bronze(DAYS[1], (1, "x"), (3, "wrong")))
    for _ in range(2):
        state.update(bronze(DAYS[1], (2, "y")))
        assert held(state) == {(1, "a"), (2, "y")}
    state.update(bronze(DAYS[2], (1, "z")))
    assert held(state) == {(1, "z"), (2, "y")}
    first = state_of(spark, tmp_path / "first")
    first.update(bronze(DAYS[0], (9, "q")).where("id = 9"))
    first.update(bronze(DAYS[0], (8, "r")).where("id = 8"))
    assert held(first) == {(8, "r")}


def test_a_run_that_died_changes_nothing(spark, bronze, tmp_path, rows):
    state = state_of(spark, tmp_path)
    state.update(bronze(DAYS[0], (1, "a")))
    rows("id INT, x STRING", (7, "half")).write.parquet(f"{state.path}/version=2")  # no marker was written
    assert held(state) == {(1, "a")}
    state.update(bronze(DAYS[1], (2, "b")))
    assert held(state) == {(1, "a"), (2, "b")}


def test_two_versions_are_kept(spark, bronze, tmp_path):
    state = state_of(spark, tmp_path)
    for at in DAYS:
        state.update(bronze(at, (1, "a")))
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("version")) == ["version=2", "version=3"]
    delete(spark, str(tmp_path / "nothing"))


def test_complete_days_delete(spark, bronze, tmp_path):
    state = state_of(spark, tmp_path, deletes=True)
    state.update(bronze(DAYS[0], (1, "a"), (2, "b")))
    state.update(bronze(DAYS[1], (2, "B"), (3, "c")))
    assert held(state) == {(2, "B"), (3, "c")}
    state.update(bronze(DAYS[1], (3, "c")))
    assert held(state) == {(3, "c")}


def test_nothing_is_lost_and_nothing_counted_twice(rows):
    data = rows(
        "id INT, mail STRING, day INT, ref INT",
        (1, "a", 2, 1), (2, "a", 1, 1), (3, "a", 1, 1), (3, "a", 1, 1), (4, "b", None, 2), (5, "b", 0, 9), (6, "c", 1, None), (7, None, 1, 1), (8, "d", 1, 3),
    )
    known = rows("ref INT", 1, 2)
    checked = Checked.by(
        data, [Check("no_mail", F.col("mail").isNotNull())], ["id", "mail"], ["id"],
        further=[Known(known, "ref", "unknown"), First(["mail"], ["day", "id"], "again")],
    )
    accepted, rejected = checked.accepted.collect(), checked.rejected.collect()
    assert sorted((r.id, r.mail) for r in accepted) == [(2, "a"), (4, "b")]
    assert sorted((r.id, r[REASON]) for r in rejected) == [
        (1, "again"), (3, "again"), (3, "again"), (5, "unknown"), (6, "unknown"), (7, "no_mail"), (8, "unknown"),
    ]
    assert len(accepted) + len(rejected) == data.count()


def test_the_first_is_found_without_gathering_a_key(rows, plan):
    tagged = First(["k"], ["t"], "again").lost(rows("k INT, t INT, x STRING", *[(1, i % 5, "x") for i in range(50)]))
    assert tagged.count() == 49 and "Window" not in plan(tagged)


@pytest.mark.parametrize("table", ["clientes", "productos", "variantes", "inventario", "pedidos", "detalle_pedido", "devoluciones", "historico_ventas", "historico_devoluciones", "eventos", "catalogo_externo"])
def test_accepted_and_rejected_are_the_input(spark, table):
    from lonja.testbed.queries import Shop

    checked = Shop(spark, "/root/testdata/sf0.001").checked[table]
    assert checked.accepted.count() + checked.rejected.count() == checked.marked.count() > 0
