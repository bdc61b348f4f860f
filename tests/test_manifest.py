import os
from datetime import datetime
from functools import partial

import pytest

from lonja import schemas
from lonja.sources import Family, Manifest, land_csv, land_lines
from lonja.sources.feeds import named_csv, read_returns_history

HEADER = "fecha,orden_ref,motivo\n"


@pytest.fixture
def landing(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    family = Family(
        "devoluciones", str(raw), str(tmp_path / "bronze"),
        partial(land_csv, schema=schemas.RETURNS_HISTORY), partial(named_csv, schema=schemas.RETURNS_HISTORY),
    )
    manifest = Manifest(spark, str(tmp_path / "manifest"))

    def put(name, *orders):
        (raw / name).parent.mkdir(exist_ok=True)
        (raw / name).write_text(HEADER + "".join(f"2024-01-01,{order},x\n" for order in orders))

    def held():
        rows = read_returns_history(spark, family.target, landed=True).collect()
        return sorted((row._archivo, row.orden_ref) for row in rows)

    return manifest, family, put, held


def copies(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "bronze").rglob("*.csv") if p.is_file()}


def test_only_new_and_changed_files_are_landed(landing, tmp_path):
    manifest, family, put, held = landing
    put("a.csv", 1, 2)
    put("b c.csv", 3)
    assert manifest.land(family) == 2
    before = copies(tmp_path)
    assert manifest.land(family) == 0 and copies(tmp_path) == before

    put("a.csv", 1, 4, 5)
    put("d.csv", 6)
    assert manifest.land(family) == 2
    assert held() == [("a.csv", "1"), ("a.csv", "4"), ("a.csv", "5"), ("b%20c.csv", "3"), ("d.csv", "6")]
    after = copies(tmp_path)
    untouched = [p for p in before if "b" in p.parent.name.removeprefix("_archivo=")[:1]]
    assert untouched and all(after[p] == before[p] for p in untouched)
    records = {row.archivo.rsplit("/", 1)[1]: row.registros for row in manifest.current().collect()}
    assert records == {"a.csv": 3, "b c.csv": 1, "d.csv": 1}
    assert manifest.log().count() == 4


def test_a_version_that_comes_back_is_landed_again(landing, tmp_path):
    manifest, family, put, held = landing
    file = tmp_path / "raw" / "a.csv"
    for order, time in (("1", 1_000), ("2", 2_000), ("1", 1_000)):
        put("a.csv", order)
        os.utime(file, (time, time))
        assert manifest.land(family) == 1
        assert held() == [("a.csv", order)]


def test_a_file_without_records_loses_its_old_copy(landing):
    manifest, family, put, held = landing
    put("a x.csv", 1)
    put("b.csv", 2)
    manifest.land(family)
    put("a x.csv")
    assert manifest.land(family) == 1
    assert held() == [("b.csv", "2")]
    assert {row.registros for row in manifest.current().collect()} == {0, 1}


def test_a_vanished_file_keeps_its_copy(landing, tmp_path):
    manifest, family, put, held = landing
    put("a.csv", 1)
    put("b.csv", 2)
    manifest.land(family)
    (tmp_path / "raw" / "a.csv").unlink()
    assert manifest.land(family) == 0
    assert held() == [("a.csv", "1"), ("b.csv", "2")]


def test_a_landing_that_dies_is_made_good(landing):
    manifest, family, put, held = landing
    put("a.csv", 1)
    manifest.land(family)
    put("b.csv", 2)

    def half(spark, paths, target):
        family.land(spark, paths, target)
        raise OSError("lost before the manifest was written")

    with pytest.raises(OSError):
        manifest.land(Family(family.name, family.source, family.target, half, family.read))
    assert manifest.log().count() == 1
    assert manifest.land(family) == 1
    assert held() == [("a.csv", "1"), ("b.csv", "2")]


def test_without_the_table_everything_is_landed(landing, tmp_path):
    manifest, family, put, held = landing
    put("a.csv", 1)
    manifest.land(family)
    other = Family(family.name, family.source, str(tmp_path / "elsewhere"), family.land, family.read)
    assert manifest.land(other) == 1


def test_families_do_not_share_versions(landing, spark, tmp_path):
    manifest, family, put, held = landing
    put("a.csv", 1)
    manifest.land(family, datetime(2024, 1, 1))
    lines = Family("lineas", family.source, str(tmp_path / "lines"), land_lines, lambda s, paths: s.read.text(paths))
    assert manifest.land(lines) == 1
    assert {(row.familia, row.registros) for row in manifest.current().collect()} == {("devoluciones", 1), ("lineas", 2)}
