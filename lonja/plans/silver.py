"""Silver: cleaned, validated, deduplicated tables.

Every builder takes the Bronze rows of its table and returns either a DataFrame or a ``Checked`` pair of accepted and
rejected rows. Builders neither read nor write. Only the columns that a table keeps reach the deduplication shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import schemas
from ..functions import (
    day_from_text,
    event_instant,
    exact_price,
    is_email,
    joined,
    lower_trim,
    shoe_size,
    title_trim,
    upper_trim,
    whole_number,
)
from ..operators import Check, Checked, First, Keep, Known, evaluated_once, keep_latest, not_kept
from ..rules import DEFAULT_RULES, MONEY, ShopRules


def _snapshot(bronze: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """The last ingested version of every key, with the columns the table needs. Rows without the stamp are such versions already."""
    if "_ingested_at" not in bronze.columns:
        return bronze.select(*keys, *columns)
    return keep_latest(bronze.select(*keys, *columns, "_ingested_at"), keys).drop("_ingested_at")


def _money(col: str) -> Column:
    return F.col(col).try_cast(MONEY).alias(col)


def _integer(col: str) -> Column:
    return F.col(col).try_cast("int").alias(col)


def _filled(col: str) -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")


def _day(rows: DataFrame, col: str) -> Column:
    text = isinstance(rows.schema[col].dataType, StringType)
    return (F.try_to_date(F.col(col)) if text else F.col(col).cast("date")).alias(col)


def _moment(rows: DataFrame, col: str) -> Column:
    text = isinstance(rows.schema[col].dataType, StringType)
    return (F.try_to_timestamp(F.col(col)) if text else F.col(col)).alias(col)


# --- database tables ---------------------------------------------------------------------------------------------


def customers(bronze: DataFrame, rules: ShopRules = DEFAULT_RULES) -> Checked:
    rows = _snapshot(bronze, ["id"], "nombre", "correo", "ciudad", "fecha_registro")
    clean = rows.select(
        "id",
        F.trim("nombre").alias("nombre"),
        lower_trim("correo").alias("correo"),
        title_trim("ciudad").alias("ciudad"),
        _day(rows, "fecha_registro"),
    )
    return Checked.by(
        clean,
        [Check("correo_inválido", is_email("correo", rules.email_pattern))],
        accepted=clean.columns,
        rejected=clean.columns,
        # one person registered twice under one address: the first registration stays
        further=[First(["correo"], ["fecha_registro", "id"], "correo_repetido")],
    )


def products(bronze: DataFrame, rules: ShopRules = DEFAULT_RULES) -> Checked:
    clean = _snapshot(bronze, ["id"], "nombre", "marca", "categoria", "precio").select(
        "id",
        F.trim("nombre").alias("nombre"),
        title_trim("marca").alias("marca"),
        lower_trim("categoria").alias("categoria"),
        _money("precio"),
    )
    sellable = (F.col("precio") > 0) & _filled("nombre") & F.col("categoria").isin(*rules.categories)
    return Checked.by(clean, [Check("precio_o_categoria_invalido", sellable)], clean.columns, clean.columns)


def variants(bronze: DataFrame) -> Checked:
    typed = _snapshot(bronze, ["id"], "producto_id", "talla", "color", "sku").select(
        "id",
        "producto_id",
        "talla",
        shoe_size("talla").alias("talla_std"),
        lower_trim("color").alias("color"),
        upper_trim("sku").alias("sku"),
    )
    clean = evaluated_once(typed)
    return Checked.by(
        clean,
        [Check("talla_invalida", F.col("talla_std").isNotNull() & _filled("sku"))],
        accepted=[
            F.col("id").alias("variante_id"),
            "producto_id",
            F.col("talla_std").alias("talla"),
            "color",
            "sku",
        ],
        rejected=["id", "producto_id", "talla", "color", "sku"],
    )


def inventory(bronze: DataFrame, valid_variants: DataFrame) -> Checked:
    """Stock of known variants."""
    clean = _snapshot(bronze, ["variante_id"], "stock_disponible", "bodega").select(
        "variante_id", _integer("stock_disponible"), upper_trim("bodega").alias("bodega")
    )
    return Checked.by(
        clean,
        [Check("stock_invalido", F.col("stock_disponible") >= 0)],
        clean.columns,
        clean.columns,
        further=[Known(valid_variants, "variante_id", "variante_desconocida")],
    )


def orders(bronze: DataFrame, rules: ShopRules = DEFAULT_RULES) -> Checked:
    rows = _snapshot(bronze, ["id"], "cliente_id", "fecha", "estado", "total")
    clean = rows.select("id", "cliente_id", _moment(rows, "fecha"), lower_trim("estado").alias("estado"), _money("total"))
    sound = F.col("fecha").isNotNull() & (F.col("total") >= 0) & F.col("estado").isin(*rules.order_states)
    return Checked.by(
        clean,
        [Check("estado_fecha_total_invalido", sound)],
        accepted=[F.col("id").alias("pedido_id"), "cliente_id", "fecha", "estado", "total"],
        rejected=clean.columns,
    )


def order_lines(bronze: DataFrame) -> Checked:
    clean = _snapshot(bronze, ["pedido_id", "variante_id"], "cantidad", "precio").select(
        "pedido_id",
        "variante_id",
        _integer("cantidad"),
        _money("precio"),
    )
    priced = clean.withColumn("subtotal", F.col("cantidad") * F.col("precio"))
    return Checked.by(
        priced,
        [Check("cantidad_precio_invalido", (F.col("cantidad") > 0) & (F.col("precio") > 0))],
        priced.columns,
        clean.columns,
    )


def payments(bronze: DataFrame) -> DataFrame:
    return _snapshot(bronze, ["pedido_id"], "metodo", "estado", "monto").select(
        "pedido_id",
        lower_trim("metodo").alias("metodo_pago"),
        lower_trim("estado").alias("estado_pago"),
        _money("monto"),
    )


def order_view(
    valid_orders: DataFrame,
    valid_lines: DataFrame,
    paid: DataFrame,
    valid_variants: DataFrame,
    keep: Keep = not_kept,
) -> DataFrame:
    """Orders, lines, payments and variants side by side: one row per order line.

    Orders and payments have one row per order and arrive partitioned by it, so they are put together first, without a
    further shuffle. The lines then meet them in one join, and the variants in another. No side is forced to be
    broadcast: Spark does it where the measured size allows. Where it does not, adaptive execution splits an order or
    a variant with very many lines, for which both inputs of a join have to be plain shuffles of stored rows: ``keep``
    stores the order heads.
    """
    heads = keep(valid_orders.join(paid, "pedido_id", "left"), "cabeceras")
    return (
        valid_lines.join(heads, "pedido_id")
        .join(valid_variants, "variante_id", "left")
        .select(
            "variante_id",
            "pedido_id",
            "cliente_id",
            "fecha",
            "estado",
            "total",
            "cantidad",
            "precio",
            "subtotal",
            "metodo_pago",
            "estado_pago",
            "monto",
            "producto_id",
            "talla",
            "color",
            "sku",
        )
    )


def returns(bronze: DataFrame, valid_orders: DataFrame) -> Checked:
    rows = _snapshot(bronze, ["pedido_id"], "motivo", "fecha")
    clean = rows.select("pedido_id", lower_trim("motivo").alias("motivo"), _day(rows, "fecha"))
    return Checked.by(
        clean,
        [Check("motivo_o_fecha_invalido", F.col("fecha").isNotNull() & F.col("motivo").isNotNull())],
        clean.columns,
        clean.columns,
        further=[Known(valid_orders, "pedido_id", "pedido_desconocido")],
    )


# --- files -------------------------------------------------------------------------------------------------------


def sales_history(raw: DataFrame) -> Checked:
    """Sales from before the shop had its database. Lines are not deduplicated: one reference may repeat."""
    typed = raw.select(
        day_from_text("fecha").alias("fecha"),
        "orden_ref",
        upper_trim("sku").alias("sku"),
        whole_number("cantidad").alias("cantidad"),
        exact_price("precio_unitario").alias("precio_unitario"),
        "canal",
        "ciudad",
    )
    # what no check looks at is cleaned behind them, and not at all where it is not wanted
    clean = (
        evaluated_once(typed, through=["orden_ref", "canal", "ciudad"])
        .withColumns({"canal": lower_trim("canal"), "ciudad": title_trim("ciudad")})
        .withColumn("subtotal", F.col("cantidad") * F.col("precio_unitario"))
    )
    sound = (
        F.col("fecha").isNotNull() & (F.col("cantidad") > 0) & (F.col("precio_unitario") > 0) & _filled("sku")
    )
    return Checked.by(
        clean,
        [Check("fecha_cantidad_precio_invalido", sound)],
        accepted=clean.columns,
        rejected=["fecha", "orden_ref", "sku", "cantidad", "precio_unitario"],
    )


def returns_history(raw: DataFrame) -> Checked:
    typed = raw.select(
        day_from_text("fecha").alias("fecha"), F.trim("orden_ref").alias("orden_ref"), lower_trim("motivo").alias("motivo")
    )
    clean = evaluated_once(typed)
    return Checked.by(
        clean,
        [Check("fecha_o_referencia_invalida", F.col("fecha").isNotNull() & _filled("orden_ref"))],
        clean.columns,
        clean.columns,
    )


def suppliers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("proveedor_id").alias("proveedor_id"),
        F.trim("nombre").alias("nombre"),
        "contacto",
        joined("categorias").alias("categorias"),
        F.trim("pais").alias("pais"),
        whole_number("plazo_entrega_dias").alias("plazo_entrega_dias"),
    )


def events(raw: DataFrame, rules: ShopRules = DEFAULT_RULES) -> Checked:
    """Web events of the backfill and of the stream copy; a repeated event keeps its first occurrence."""
    cleaned = {
        "ts": event_instant("ts", rules.naive_zone),
        "event_type": lower_trim("event_type"),
        "event_id": F.trim("event_id"),
        "session_id": F.trim("session_id"),
        "sku": upper_trim("sku"),
        "canal": lower_trim("canal"),
    }
    names = schemas.field_names(schemas.EVENT)
    clean = evaluated_once(raw.select(*[cleaned.get(name, F.col(name)).alias(name) for name in names]))
    sound = (
        _filled("event_id")
        & _filled("session_id")
        & F.col("ts").isNotNull()
        & F.col("event_type").isin(*rules.event_types)
    )
    return Checked.by(
        clean,
        [Check("evento_invalido", sound)],
        accepted=names,
        rejected=["event_id", "event_type", "ts", "session_id"],
        further=[First(["event_id"], ["ts"], "evento_repetido")],
    )


def external_catalog(raw: DataFrame) -> Checked:
    typed = raw.select(
        whole_number("id").alias("api_id"),
        F.trim("title").alias("titulo"),
        title_trim("brand").alias("marca"),
        lower_trim("category").alias("categoria"),
        F.col("price").try_cast(MONEY).alias("precio"),
        F.col("discountPercentage").try_cast("double").alias("descuento_pct"),
        F.col("rating").try_cast("double").alias("rating"),
        whole_number("stock").alias("stock"),
        upper_trim("sku").alias("sku"),
        joined("tags").alias("etiquetas"),
        F.col("_categoria_api").alias("categoria_origen"),
        "_source",
        "_ingested_at",
    )
    clean = evaluated_once(typed)
    sound = (F.col("precio") > 0) & _filled("titulo") & _filled("sku")
    return Checked.by(
        clean,
        [Check("catalogo_api_invalido", sound)],
        accepted=clean.columns,
        rejected=["api_id", "titulo", "marca", "precio", "sku"],
    )
