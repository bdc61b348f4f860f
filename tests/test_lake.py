import argparse
import json
import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lonja import schemas
from lonja.__main__ import REPORT_OPTIONS, report_options
from lonja.plans import reports, runner
from lonja.rules import ShopRules
from lonja.settings import Settings
from lonja.sources import Database, Lake, MissingTable, Split, file_manifest, stamped, text_events, write_snapshot
from lonja.sources.feeds import read_returns_history, read_suppliers
from lonja.sources.landing import land_csv
from lonja.sources.lake import read_snapshots, read_table
from lonja.streaming import LiveSinks, start

DAY1, DAY2 = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8)


def test_object_store_addresses_stay_whole():
    lake = Lake("s3a://bucket/lake/")
    assert lake.silver("silver_pedidos") == "s3a://bucket/lake/silver/silver_pedidos"
    assert lake.rejects("pedidos") == "s3a://bucket/lake/silver/rechazados/pedidos"


def test_a_snapshot_replaces_only_its_day(spark, rows, tmp_path):
    lake = Lake(str(tmp_path))
    path = lake.bronze("postgres", "t")
    write_snapshot(stamped(rows("id INT", 1, 2, 3), "db:t", DAY1), path)
    write_snapshot(stamped(rows("id INT", 1, 2, 3, 4), "db:t", DAY2), path)
    write_snapshot(stamped(rows("id INT", 1, 9), "db:t", DAY2), path)
    days = {(str(row._ingest_date), row["count"]) for row in spark.read.parquet(path).groupBy("_ingest_date").count().collect()}
    assert days == {("2024-01-01", 3), ("2024-01-02", 2)}
    assert {row.id for row in read_snapshots(spark, lake, "t", latest_only=True).collect()} == {1, 9}
    assert spark.read.parquet(path).select("_source").distinct().first()[0] == "db:t"


def test_a_missing_layer_is_named(spark, tmp_path):
    with pytest.raises(MissingTable, match="run the ingest step first"):
        read_table(spark, str(tmp_path / "nothing"), "run the ingest step first")


def test_database_options():
    database = Database("jdbc:postgresql://db/shop", {"user": "u"})
    assert database.options("pedidos") == {
        "url": "jdbc:postgresql://db/shop", "dbtable": "pedidos", "fetchsize": "10000", "user": "u",
    }
    assert database.split_options(Split("id", 4), 1, 99) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "99", "numPartitions": "4",
    }


def test_manifest(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n{"x": 2}\n')
    (tmp_path / "b.json").write_text('{"x": 3}\n')
    manifest = file_manifest(spark.read.schema("x INT").json(str(tmp_path)))
    found = {row.archivo.rsplit("/", 1)[1]: (row.bytes, row.registros) for row in manifest.collect()}
    assert found == {"a.json": (18, 2), "b.json": (9, 1)}


class FakeDatabase:
    """Stands in for a database: no server may run in a test."""

    def __init__(self, tables):
        self.tables = tables

    def read(self, spark, table, split=None):
        return self.tables[table]


@pytest.fixture
def database(rows):
    at = datetime(2024, 3, 1, 10)
    return FakeDatabase(
        {
            "clientes": rows("id INT, nombre STRING, correo STRING, ciudad STRING, fecha_registro DATE", (1, "Ana", "a@x.es", "león", at.date()), (2, "B", "mal", None, at.date())),
            "productos": rows("id INT, nombre STRING, marca STRING, categoria STRING, precio DECIMAL(10,2)", (1, "Bota", "nike", "formal", Decimal(10)), (2, "Gratis", "nike", "formal", Decimal(0))),
            "variantes": rows("id INT, producto_id INT, talla STRING, color STRING, sku STRING", (1, 1, "EU 36", "rojo", "a"), (2, 2, "37", "azul", "b")),
            "inventario": rows("variante_id INT, stock_disponible INT, bodega STRING", (1, 3, "x"), (2, 50, "x")),
            "pedidos": rows("id INT, cliente_id INT, fecha TIMESTAMP, estado STRING, total DECIMAL(12,2)", (1, 1, at, "entregado", Decimal(20)), (2, 1, at, "raro", Decimal(20))),
            "detalle_pedido": rows("pedido_id INT, variante_id INT, cantidad INT, precio DECIMAL(10,2)", (1, 1, 2, Decimal(10)), (2, 1, 2, Decimal(10))),
            "pagos": rows("pedido_id INT, metodo STRING, estado STRING, monto DECIMAL(12,2)", (1, "t", "confirmado", Decimal(20))),
            "devoluciones": rows("pedido_id INT, motivo STRING, fecha DATE", (1, "talla", at.date())),
        }
    )


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    (folder / "historico_ventas").mkdir(parents=True)
    (folder / "eventos_web").mkdir()
    header = schemas.SALES_HISTORY.replace(" STRING", "").replace(" ", "")
    (folder / "historico_ventas" / "ventas_2023.csv").write_text(f"{header}\n05/11/2023,H-1, a ,2,\"€1,50\",web,león\nmal,H-2,a,1,1,web,x\n")
    (folder / "historico_ventas" / "ventas_2024.csv").write_text(f"{header}\n2024-03-01,H-3,A,1,5.00 EUR,app,x\n")
    (folder / "devoluciones_historicas.csv").write_text("fecha,orden_ref,motivo\n05.11.2023,H-1,Talla\nx,H-9,y\n")
    suppliers = [
        {"proveedor_id": " P1", "nombre": "Uno", "contacto": "c", "categorias": ["formal", "x"], "pais": " ES", "plazo_entrega_dias": 7},
        {"proveedor_id": "P2", "nombre": "Dos"},
    ]
    (folder / "proveedores.json").write_text(json.dumps(suppliers, indent=1))
    event = {"event_id": "e1", "event_type": "added_to_cart", "ts": "2024-05-01T10:00:00", "session_id": "s", "sku": "a", "producto_id": 1}
    (folder / "eventos_web" / "d1.json").write_text(json.dumps(event) + "\n{bad\n")
    return str(folder)


def test_whole_run(spark, database, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def ingest(at=DAY1):
        counts = runner.ingest_database(spark, database, lake, at)
        runner.ingest_files(spark, raw, lake)
        return counts

    # a live event, twice: once from the backfill's session that never buys, once repeated by the stream
    feed = tmp_path / "feed"
    feed.mkdir()
    live = {"event_id": "e2", "event_type": "product_viewed", "ts": "2024-05-02T10:00:00Z", "session_id": "s2"}
    (feed / "1.txt").write_text("\n".join([json.dumps(live)] * 2))
    start(text_events(spark, str(feed)), LiveSinks(lake), every=None).awaitTermination()

    counts = runner.run_batch(spark, lake, ingest)
    assert counts["bronze"]["pedidos"] == 2
    silver = counts["silver"]
    assert silver["silver_pedido_detalle"] == 1 and silver["silver_historico_ventas"] == 2
    assert silver["rechazados/pedidos"] == 1 and silver["rechazados/clientes"] == 1 and silver["rechazados/eventos"] == 2  # the broken line and the repeated event
    assert silver["silver_eventos_navegacion"] == 2  # backfill and stream, the repeated event once
    assert "silver_catalogo_externo" not in silver
    assert set(counts["gold"]) == set(runner.METRICS) - {"gold_catalogo_externo"}

    daily = {str(row.fecha): row.ingresos for row in spark.read.parquet(lake.gold("gold_ventas_diarias")).collect()}
    assert daily == {"2023-11-05": Decimal(3), "2024-03-01": Decimal(25)}
    assert spark.read.parquet(lake.gold("gold_carritos_abandonados")).first().nombre == "Bota"
    assert spark.read.parquet(lake.gold("gold_tasa_devolucion")).first().motivo_mas_frecuente == "talla"
    suppliers = {row.proveedor_id: row for row in spark.read.parquet(lake.silver("silver_proveedores")).collect()}
    assert suppliers["P1"].categorias == "formal,x" and suppliers["P1"].plazo_entrega_dias == 7 and suppliers["P2"].categorias == ""

    # a second day without the bad order: old rejects disappear, nothing is counted twice
    database.tables["pedidos"] = database.tables["pedidos"].withColumn("estado", F.lit("entregado"))
    again = runner.run_batch(spark, lake, lambda: ingest(DAY2))
    assert again["silver"]["rechazados/pedidos"] == 0
    assert spark.read.parquet(lake.rejects("pedidos")).count() == 0
    assert again["silver"]["silver_pedidos"] == 2 and again["silver"]["silver_historico_ventas"] == 2

    # the external catalogue arrives
    assert not runner.ingest_catalog(spark, f"{raw}/api_catalogo", lake, "https://example.com")
    (tmp_path / "raw" / "api_catalogo").mkdir()
    item = {"id": 1, "title": "Z", "brand": "b", "category": "c", "price": 5.5, "sku": "x"}
    (tmp_path / "raw" / "api_catalogo" / "mens-shoes.jsonl").write_text(json.dumps(item))
    for at in (DAY1, DAY2):
        assert runner.ingest_catalog(spark, f"{raw}/api_catalogo", lake, "https://example.com", at)
    assert runner.run_silver(spark, lake)["silver_catalogo_externo"] == 1
    landed = spark.read.parquet(lake.silver("silver_catalogo_externo")).first()
    assert (landed.categoria_origen, landed._source, landed._ingested_at) == ("mens-shoes", "api:https://example.com", "2024-01-02T08:00:00")
    assert runner.run_gold(spark, lake)["gold_catalogo_externo"] == 1
    assert spark.read.parquet(lake.bronze("_manifiesto")).count() == 5

    for name in reports.REPORTS:
        assert runner.report(spark, lake, name).columns
    kpis = runner.report(spark, lake, "kpis").first()
    assert (kpis.ingresos, kpis.dias_con_ventas, kpis.producto_estrella, kpis.stock_critico) == (Decimal(28), 2, "Bota", 1)
    assert runner.report(spark, lake, "range_summary", last="2023-12-31").first().ingresos == Decimal(3)
    assert [row.eventos for row in runner.report(spark, lake, "activity_by_events").collect()] == [2]
    assert runner.report(spark, lake, "stream_kpis").first().asDict() == {"eventos": 2, "alertas": 0, "agotados": 0}

    history = runner.report(spark, lake, "run_history").collect()
    assert [row.estado for row in history] == ["ok", "ok"] and history[0].filas_bronze == 14
    assert history[0].errores == 0 and history[0].filas_gold == sum(again["gold"].values())


def test_missing_raw_files_are_named(spark, tmp_path):
    with pytest.raises(MissingTable, match="raw files are missing"):
        runner.ingest_files(spark, str(tmp_path / "raw"), Lake(str(tmp_path / "lake")))


def test_a_failed_run_is_recorded(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(MissingTable):
        runner.run_batch(spark, lake)
    record = runner.read_runs(spark, lake).first()
    assert record.estado == "error" and record.error.startswith("MissingTable") and record.gold is None
    assert reports.run_history(runner.read_runs(spark, lake)).first().errores == 1


def test_supplier_array(spark, raw):
    assert read_suppliers(spark, f"{raw}/proveedores.json").count() == 2


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("orden_ref,fecha,nota\nH-1,2024-01-02,extra\n")
    landed = str(tmp_path / "landed")
    land_csv(spark, str(tmp_path / "raw"), landed, schemas.RETURNS_HISTORY)
    for rows in (
        read_returns_history(spark, str(tmp_path / "raw")),
        read_returns_history(spark, landed, landed=True).drop("_archivo"),
    ):
        assert [row.asDict() for row in rows.collect()] == [{"fecha": "2024-01-02", "orden_ref": "H-1", "motivo": None}]
    assert spark.read.option("header", True).csv(landed).first().nota == "extra"
    (tmp_path / "raw" / "b.csv").write_text("fecha,orden_ref,nota\n2024-01-03,H-2,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_returns_history(spark, str(tmp_path / "raw")).collect()


def test_a_folder_without_csv_files_is_empty(spark, tmp_path):
    assert read_returns_history(spark, str(tmp_path)).count() == 0


def test_the_event_backfill_may_be_missing(spark, raw, tmp_path):
    other = tmp_path / "other"
    shutil.copytree(raw, other, ignore=shutil.ignore_patterns("eventos_web"))
    lake = Lake(str(tmp_path / "lake"))
    runner.ingest_files(spark, str(other), lake)
    assert spark.read.parquet(lake.bronze("_manifiesto")).count() == 4


def test_exports_hold_all_rows(rows):
    carts = rows("carritos_abandonados INT, sku STRING", *[(i, str(i)) for i in range(150)])
    parsed = argparse.Namespace(name="abandoned_top", csv="out", **dict.fromkeys(REPORT_OPTIONS))
    assert reports.abandoned_top(carts, **report_options(parsed)).count() == 150
    parsed.k = 3
    assert reports.abandoned_top(carts, **report_options(parsed)).count() == 3
    parsed.brand = ["x"]
    with pytest.raises(ValueError, match="brands"):
        report_options(parsed)


def test_csv_export(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    reports.write_csv(rows("a INT, b STRING", (1, "x,y"), (2, None)), path)
    assert sorted(tuple(row) for row in spark.read.csv(path, header=True).fillna("").collect()) == [("1", "x,y"), ("2", "")]


def test_settings_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("LAKE_ROOT", "s3a://bucket/lake")
    monkeypatch.setenv("STOCK_UMBRAL", "3")
    settings = Settings.from_environment()
    assert settings.lake.gold("x") == "s3a://bucket/lake/gold/x" and settings.rules.stock_threshold == 3
    assert settings.database.url == "jdbc:postgresql://postgres:5432/shop"
    assert settings.topic == {"subscribe": "eventos-web", "startingOffsets": "latest"}


def test_rules_are_data():
    rules = ShopRules(stock_threshold=1)
    assert rules.critical_stock == 1 and ShopRules().critical_stock == 2
