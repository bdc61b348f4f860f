from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lonja import schemas
from lonja.operators import Stage
from lonja.plans import silver

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def values(df):
    return {tuple(row) for row in df.collect()}


def test_customers(rows):
    bronze = rows(
        "id INT, nombre STRING, correo STRING, ciudad STRING, fecha_registro DATE, _ingested_at TIMESTAMP",
        (1, " Ana ", " ANA@X.es", " SAN sebastián", date(2020, 1, 2), DAY2),
        (1, "viejo", "viejo@x.es", None, date(2020, 1, 2), DAY1),
        (2, "Ana bis", "ana@x.es", None, date(2020, 1, 1), DAY1),
        (3, "Sin", "sin-arroba", None, date(2020, 1, 1), DAY1),
        (4, "Nulo", None, None, date(2020, 1, 1), DAY1),
        (5, "Eva", "eva@x.es", None, date(2020, 5, 1), DAY1),
        (6, "Eva bis", "eva@x.es", None, date(2020, 5, 1), DAY1),
    )
    table = silver.customers(bronze)
    # the earlier registration stays; on the same day the lower id
    assert {row.id for row in table.accepted.collect()} == {2, 5}
    assert {(row.id, row.motivo_rechazo) for row in table.rejected.collect()} == {(3, "correo_inválido"), (4, "correo_inválido")}
    cleaned = table.marked.where("id = 1").first()
    assert (cleaned.nombre, cleaned.correo, cleaned.ciudad) == ("Ana", "ana@x.es", "San Sebastián")


def test_products(rows):
    bronze = rows(
        "id INT, nombre STRING, marca STRING, categoria STRING, precio DECIMAL(10,2), _ingested_at TIMESTAMP",
        (1, " Bota ", "NIKE air", " Formal", Decimal("10.50"), DAY1),
        (2, "Bota", "x", "formal", Decimal("0"), DAY1),
        (3, "Bota", "x", "formal", None, DAY1),
        (4, "  ", "x", "formal", Decimal("1"), DAY1),
        (5, "Bota", "x", "otra", Decimal("1"), DAY1),
        (6, "Bota", "x", None, Decimal("1"), DAY1),
        (7, None, "x", "formal", Decimal("1"), DAY1),
    )
    table = silver.products(bronze)
    assert values(table.accepted) == {(1, "Bota", "Nike Air", "formal", Decimal("10.5000"))}
    assert {row.id for row in table.rejected.collect()} == {2, 3, 4, 5, 6, 7}


@pytest.fixture
def variants(rows):
    return silver.variants(
        rows(
            "id INT, producto_id INT, talla STRING, color STRING, sku STRING, _ingested_at TIMESTAMP",
            (1, 10, "EU 36", " Rojo", " sku-1 ", DAY1),
            (2, 10, "XL", "Azul", "sku-2", DAY1),
            (3, 10, "37,5", "Azul", "  ", DAY1),
            (4, 10, "38", "Azul", None, DAY1),
            (5, 11, "T38", "AZUL", "sku-5", DAY1),
        )
    )


def test_variants(variants):
    assert values(variants.accepted) == {(1, 10, "36", "rojo", "SKU-1"), (5, 11, "38", "azul", "SKU-5")}
    # rejected rows show the size as it came
    assert values(variants.rejected) == {
        (2, 10, "XL", "azul", "SKU-2", "talla_invalida"),
        (3, 10, "37,5", "azul", "", "talla_invalida"),
        (4, 10, "38", "azul", None, "talla_invalida"),
    }


def test_inventory_of_known_variants(rows, variants):
    bronze = rows(
        "variante_id INT, stock_disponible INT, bodega STRING, _ingested_at TIMESTAMP",
        (1, 0, " bod-mad ", DAY1), (2, 9, "b", DAY1), (5, -1, "b", DAY1), (6, None, "b", DAY1),
    )
    table = silver.inventory(bronze, variants.accepted)
    assert values(table.accepted) == {(1, 0, "BOD-MAD")}
    assert {row.variante_id for row in table.rejected.collect()} == {5, 6}


@pytest.fixture
def orders(rows):
    at = datetime(2024, 3, 1, 10)
    return silver.orders(
        rows(
            "id INT, cliente_id INT, fecha TIMESTAMP, estado STRING, total DECIMAL(12,2), _ingested_at TIMESTAMP",
            (1, 7, at, " Entregado", Decimal(10), DAY2), (1, 7, at, "pendiente", Decimal(10), DAY1),
            (2, 7, at, "raro", Decimal(10), DAY1), (3, 7, None, "enviado", Decimal(10), DAY1),
            (4, 7, at, "enviado", Decimal(-1), DAY1), (5, 7, at, None, Decimal(1), DAY1),
            (6, 8, at, "ENVIADO", Decimal(0), DAY1), (8, 7, at, "enviado", None, DAY1),
        )
    )


def test_orders(orders):
    assert {(row.pedido_id, row.estado) for row in orders.accepted.collect()} == {(1, "entregado"), (6, "enviado")}
    assert {row.id for row in orders.rejected.collect()} == {2, 3, 4, 5, 8}


def test_order_view(rows, orders, variants):
    lines = silver.order_lines(
        rows(
            "pedido_id INT, variante_id INT, cantidad INT, precio DECIMAL(10,2), _ingested_at TIMESTAMP",
            (1, 1, 2, Decimal("5.25"), DAY2), (1, 1, 9, Decimal("5.25"), DAY1), (1, 2, 1, Decimal("1"), DAY1),
            (2, 1, 1, Decimal("1"), DAY1), (6, 5, 0, Decimal("1"), DAY1), (6, 1, 1, None, DAY1),
        )
    )
    paid = silver.payments(
        rows(
            "pedido_id INT, metodo STRING, estado STRING, monto DECIMAL(12,2), _ingested_at TIMESTAMP",
            (1, " Tarjeta", "CONFIRMADO ", Decimal("11.5"), DAY1),
        )
    )
    view = silver.order_view(orders.accepted, lines.accepted, paid, variants.accepted)
    found = {(row.pedido_id, row.variante_id): row for row in view.collect()}
    assert set(found) == {(1, 1), (1, 2)}
    assert found[1, 1].subtotal == Decimal("10.50") and found[1, 1].estado_pago == "confirmado"
    # a rejected variant leaves sku and product empty, the line stays
    assert found[1, 2].sku is None and found[1, 2].producto_id is None and found[1, 2].metodo_pago == "tarjeta"
    assert {(row.pedido_id, row.motivo_rechazo) for row in lines.rejected.collect()} == {(6, "cantidad_precio_invalido")}


def test_returns_of_known_orders(rows, orders):
    bronze = rows(
        "pedido_id INT, motivo STRING, fecha DATE, _ingested_at TIMESTAMP",
        (1, " Talla ", date(2024, 3, 2), DAY1), (2, "talla", date(2024, 3, 2), DAY1),
        (6, None, date(2024, 3, 2), DAY1), (3, "x", None, DAY1),
    )
    table = silver.returns(bronze, orders.accepted)
    assert values(table.accepted) == {(1, "talla", date(2024, 3, 2))}
    assert {row.pedido_id for row in table.rejected.collect()} == {3, 6}


def test_sales_history_keeps_repeated_references(rows):
    raw = rows(
        schemas.SALES_HISTORY,
        ("05/11/2023", "H-1", " sku-1", "2", "€1.234,50", " WEB", "SAN juan"),
        ("05/11/2023", "H-1", " sku-1", "2", "€1.234,50", " WEB", "SAN juan"),
        ("nunca", "H-2", "sku-1", "2", "1", "web", "x"),
        ("05/11/2023", "H-3", "sku-1", "0", "1", "web", "x"),
        ("05/11/2023", "H-4", "sku-1", "x", "1", "web", "x"),
        ("05/11/2023", "H-5", "sku-1", "1", "gratis", "web", "x"),
        ("05/11/2023", "H-6", " ", "1", "1", "web", "x"),
        ("05/11/2023", "H-7", None, "1", "1", "web", "x"),
    )
    table = silver.sales_history(raw)
    good = [tuple(row) for row in table.accepted.collect()]
    assert good == [
        (date(2023, 11, 5), "H-1", "SKU-1", 2, Decimal("1234.5000"), "web", "San Juan", Decimal("2469.0000"))
    ] * 2
    assert sorted(row.orden_ref for row in table.rejected.collect()) == [f"H-{i}" for i in range(2, 8)]


def test_returns_history(rows):
    raw = rows(schemas.RETURNS_HISTORY, ("2023-01-02", " H-1 ", " TALLA"), ("x", "H-2", "y"), ("2023-01-02", " ", "y"))
    table = silver.returns_history(raw)
    assert values(table.accepted) == {(date(2023, 1, 2), "H-1", "talla")}
    assert table.rejected.count() == 2


def event(**fields):
    names = schemas.field_names(schemas.EVENT)
    base = dict(event_id="e", event_type="order_placed", ts="2024-05-01T10:00:00", session_id="s")
    return tuple({**base, **fields}.get(name) for name in names)


def test_events_keep_the_first_copy(rows):
    raw = rows(
        schemas.EVENT,
        event(ts="2024-05-01T10:00:02"),
        event(event_id=" e "),
        event(event_id="a", event_type=" STOCK_LOW", sku=" x ", canal=" Web"),
        event(event_id="b", event_type="otro"),
        event(event_id="c", session_id=" "),
        event(event_id="d", ts="ayer"),
        event(event_id=None),
        event(event_id="", ts=None),
    )
    table = silver.events(raw)
    kept = {row.event_id: row for row in table.accepted.collect()}
    assert set(kept) == {"e", "a"}
    assert kept["e"].ts == datetime(2024, 5, 1, 10)
    assert (kept["a"].event_type, kept["a"].sku, kept["a"].canal) == ("stock_low", "X", "web")
    assert table.rejected.count() == 5


def test_external_catalog(rows):
    def item(**fields):
        base = dict(id="1", title=" Zapato", brand="NIKE", category="Mens", price="79.99", rating="4.5", stock="7", sku=" a ")
        return tuple({**base, **fields}.get(name) for name in schemas.field_names(schemas.CATALOG))

    raw = rows(
        schemas.CATALOG,
        item(tags=["x", "y"], _categoria_api="mens-shoes"),
        item(price="0"),
        item(price=None),
        item(title=" "),
        item(sku=None),
    )
    table = silver.external_catalog(raw)
    good = table.accepted.first()
    assert (good.api_id, good.titulo, good.marca, good.categoria) == (1, "Zapato", "Nike", "mens")
    assert (good.precio, good.rating, good.stock, good.sku, good.etiquetas) == (Decimal("79.9900"), 4.5, 7, "A", "x,y")
    assert good.categoria_origen == "mens-shoes"
    assert table.accepted.count() == 1 and table.rejected.count() == 4


def test_nothing_is_lost(variants, orders):
    for table in (variants, orders):
        assert table.accepted.count() + table.rejected.count() == table.marked.count()


def test_only_needed_columns_are_shuffled(rows, plan):
    bronze = rows(
        "pedido_id INT, metodo STRING, estado STRING, monto DECIMAL(12,2), extra STRING, _ingested_at TIMESTAMP",
        (1, "a", "b", Decimal(1), "unused", DAY1),
    ).repartition(2)
    shuffled = plan(silver.payments(bronze.where(F.col("monto") > 0))).split("hashpartitioning")[1]
    assert "extra" not in shuffled.split("Exchange RoundRobin")[0]


def test_a_hot_order_and_a_hot_variant_are_split(spark, plan, tmp_path):
    """A third of all lines in one order, and a third of one variant: adaptive execution cuts them into pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 30_000
        numbers = spark.range(n).repartition(8)
        lines = numbers.select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("pedido_id"),
            F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).alias("variante_id"),
            F.lit(1).alias("cantidad"),
            F.lit(2).cast("decimal(18,4)").alias("precio"),
            F.lit(2).cast("decimal(18,4)").alias("subtotal"),
        )
        orders = numbers.selectExpr("id AS pedido_id", "id AS cliente_id", "current_date() AS fecha", "'enviado' AS estado", "1 AS total")
        paid = numbers.selectExpr("id AS pedido_id", "'t' AS metodo_pago", "'confirmado' AS estado_pago", "1 AS monto")
        variants = numbers.selectExpr("id AS variante_id", "id AS producto_id", "'36' AS talla", "'rojo' AS color", "'s' AS sku")
        with Stage(spark, "test") as stage:
            kept = {name: stage.keep(df, name) for name, df in (("l", lines), ("o", orders), ("p", paid), ("v", variants))}
            view = silver.order_view(kept["o"], kept["l"], kept["p"], kept["v"], stage.keep)
            assert len(view.collect()) == n
            final = plan(view)
            assert final.count("SortMergeJoin(skew=true)") >= 2, final
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_history_cleans_only_what_is_wanted(rows, plan):
    """Columns that no check looks at are cleaned behind the checks, and not at all in a query that does not want them."""
    raw = rows(schemas.SALES_HISTORY, *[tuple("04/03/2024" if n == "fecha" else "7" if n != "sku" else " a " for n in schemas.field_names(schemas.SALES_HISTORY))])
    accepted = silver.sales_history(raw).accepted
    assert "initcap" in plan(accepted)
    assert "initcap" not in plan(accepted.select("fecha", "sku", "cantidad", "subtotal"))
    assert [tuple(r) for r in accepted.select("fecha", "sku", "cantidad").collect()] == [(date(2024, 3, 4), "A", 7)]
