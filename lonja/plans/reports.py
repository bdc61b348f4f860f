"""Reports over Gold: the questions a dashboard asks. All are lazy; ``k=None`` gives a top-k report without its limit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, ShopRules


def _total(col: str, kind: str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0).cast(kind)).alias(col)


def kpis(daily: DataFrame, top: DataFrame, stock: DataFrame) -> DataFrame:
    """One row: income, units, days with sales, best product and number of variants in critical stock. ``top`` needs sku, nombre and
    ingresos, no ranks."""
    best = top.orderBy(F.col("ingresos").desc(), "sku").limit(1).select("nombre")
    critical = stock.agg(F.count(F.lit(1)))
    return daily.agg(
        _total("ingresos", "decimal(38,4)"),
        _total("unidades_vendidas", "bigint"),
        F.count(F.lit(1)).alias("dias_con_ventas"),
    ).select("*", best.scalar().alias("producto_estrella"), critical.scalar().alias("stock_critico"))


def date_range(daily: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Days from ``first`` to ``last``, both included; without a limit, all of them."""
    if first is not None:
        daily = daily.where(F.col("fecha") >= F.lit(first).cast("date"))
    return daily if last is None else daily.where(F.col("fecha") <= F.lit(last).cast("date"))


def range_summary(daily: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Income, units and income per day with sales inside a date range."""
    days = F.greatest(F.count(F.lit(1)), F.lit(1))
    return date_range(daily, first, last).agg(
        _total("ingresos", "decimal(38,4)"),
        _total("unidades_vendidas", "bigint"),
        (F.coalesce(F.sum("ingresos"), F.lit(0)).cast("double") / days).alias("ticket_medio_dia"),
    )


def monthly_sales(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes")).agg(
        F.sum("ingresos").alias("ingresos"), F.sum("unidades_vendidas").alias("unidades_vendidas")
    )


def _percent(rate: Column) -> Column:
    return F.round(rate * 100, 1)


def funnel_percent(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "orden", "etapa_nombre", "sesiones", "eventos", _percent(F.col("tasa_sobre_vistas")).alias("pct_sobre_vistas")
    )


def _chosen(rows: DataFrame, col: str, values: Sequence[str] | None) -> DataFrame:
    return rows if values is None else rows.where(F.col(col).isin(*values))


def _first(rows: DataFrame, k: int | None) -> DataFrame:
    return rows if k is None else rows.limit(k)


def top_products(
    top: DataFrame, k: int | None = 15, brands: Sequence[str] | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    """The ``k`` best products by income, of the chosen brands and categories."""
    picked = _chosen(_chosen(top, "marca", brands), "categoria", categories)
    best = _first(picked.orderBy(F.col("ingresos").desc(), "sku"), k)
    return best.select("nombre", "marca", "categoria", "unidades", "ingresos")


def income_by_category(
    top: DataFrame, brands: Sequence[str] | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    picked = _chosen(_chosen(top, "marca", brands), "categoria", categories)
    return picked.groupBy("categoria").agg(F.sum("ingresos").alias("ingresos"))


def demand_by(attributes: DataFrame, kind: str = "talla") -> DataFrame:
    """Demand by ``talla`` or by ``color``."""
    return attributes.where(F.col("tipo") == kind).select("valor", "unidades", "ingresos", "ranking")


def critical_stock(stock: DataFrame) -> DataFrame:
    """The whole table, the scarcest variants first."""
    return stock.orderBy("stock_disponible", "variante_id", "bodega")


def return_percent(rates: DataFrame) -> DataFrame:
    """Return rate in percent, and beside it the share of orders with the product that came back; most returns first."""
    per_order = F.when(
        F.col("pedidos_con_producto") > 0, F.col("devoluciones").cast("double") / F.col("pedidos_con_producto")
    )
    return rates.orderBy(F.col("devoluciones").desc(), "producto_id").select(
        "producto_id",
        "nombre",
        "unidades_vendidas",
        "devoluciones",
        _percent(F.coalesce("tasa_devolucion", F.lit(0.0))).alias("pct_devolucion"),
        per_order.alias("tasa_por_pedido"),
        "motivo_mas_frecuente",
    )


def segment_kpis(customers: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    """Number of customers, their spend and spend per order, for the chosen segments."""
    orders = F.greatest(F.coalesce(F.sum("pedidos"), F.lit(0)), F.lit(1))
    return _chosen(customers, "segmento", segments).agg(
        F.count(F.lit(1)).alias("clientes"),
        _total("gasto_total", "decimal(38,4)"),
        (F.coalesce(F.sum("gasto_total"), F.lit(0)).cast("double") / orders).alias("ticket_medio"),
    )


def spend_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segmento").agg(F.sum("gasto_total").alias("gasto_total"))


def top_customers(customers: DataFrame, k: int | None = 15, segments: Sequence[str] | None = None) -> DataFrame:
    best = _chosen(customers, "segmento", segments).orderBy(F.col("gasto_total").desc(), "cliente_id")
    return _first(best, k).select(
        "cliente_id", "nombre", "ciudad", "pedidos", "gasto_total", "ticket_promedio", "segmento"
    )


def abandoned_top(carts: DataFrame, k: int | None = 15) -> DataFrame:
    return _first(carts.orderBy(F.col("carritos_abandonados").desc(), F.col("sku").asc_nulls_last()), k)


def stream_kpis(activity: DataFrame, alerts: DataFrame, rules: ShopRules = DEFAULT_RULES) -> DataFrame:
    """Events seen live, alerts raised and alerts for sold-out products."""
    raised = alerts.agg(F.count(F.lit(1)))
    sold_out = alerts.where(F.col("severidad") == "agotado").agg(F.count(F.lit(1)))
    return activity.agg(_total("eventos", "bigint")).select(
        "eventos", raised.scalar().alias("alertas"), sold_out.scalar().alias("agotados")
    )


def activity_by_events(activity: DataFrame) -> DataFrame:
    return activity.orderBy(F.col("eventos").desc(), "event_type")


def latest_alerts(alerts: DataFrame, k: int | None = 20) -> DataFrame:
    newest = [F.col("ts").desc(), F.col("sku").asc_nulls_last(), F.col("stock_actual").asc_nulls_first()]
    return _first(alerts.orderBy(*newest), k).select("ts", "sku", "stock_actual", "umbral", "severidad")


def _weighted_price() -> Column:
    return F.try_divide(F.sum(F.col("precio_medio") * F.col("productos")).cast("double"), F.sum("productos"))


def external_kpis(benchmark: DataFrame) -> DataFrame:
    return benchmark.agg(
        _total("productos", "bigint"),
        _weighted_price().alias("precio_medio"),
        F.count_distinct("marca").alias("marcas"),
    )


def external_benchmark(benchmark: DataFrame) -> DataFrame:
    """The whole table, the groups with most products first."""
    return benchmark.orderBy(F.col("productos").desc(), "categoria", "marca", "categoria_origen")


def external_price_by_brand(benchmark: DataFrame) -> DataFrame:
    """Mean price of every brand, the dearest first."""
    prices = benchmark.groupBy("marca").agg(
        F.sum("productos").alias("productos"), _weighted_price().alias("precio_medio")
    )
    return prices.orderBy(F.col("precio_medio").desc(), "marca")


def _rows(layer: str) -> Column:
    return F.aggregate(F.map_values(layer), F.lit(0).cast("bigint"), lambda total, n: total + n).alias(f"filas_{layer}")


def run_history(runs: DataFrame, k: int | None = 8, kept: int = 50) -> DataFrame:
    """The newest ``k`` runs with their rows per layer, and the number of failed runs among the ``kept`` newest."""
    newest = runs.orderBy(F.col("inicio").desc(), F.col("fin").desc())
    failed = newest.limit(kept).where(F.col("estado") == "error").agg(F.count(F.lit(1)))
    return (
        _first(newest, k)
        .select("inicio", "fin", "duracion_s", "estado", *[_rows(layer) for layer in ("bronze", "silver", "gold")], "error")
        .withColumn("errores", failed.scalar())
    )


# Every report with the tables it reads; ``runs`` is the run log, the others are Gold tables.
REPORTS: Mapping[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "kpis": (kpis, ("gold_ventas_diarias", "gold_top_productos", "gold_stock_critico")),
    "range_summary": (range_summary, ("gold_ventas_diarias",)),
    "monthly_sales": (monthly_sales, ("gold_ventas_diarias",)),
    "funnel_percent": (funnel_percent, ("gold_embudo_conversion",)),
    "top_products": (top_products, ("gold_top_productos",)),
    "income_by_category": (income_by_category, ("gold_top_productos",)),
    "demand_by": (demand_by, ("gold_ventas_por_talla",)),
    "critical_stock": (critical_stock, ("gold_stock_critico",)),
    "return_percent": (return_percent, ("gold_tasa_devolucion",)),
    "segment_kpis": (segment_kpis, ("gold_clientes_valor",)),
    "spend_by_segment": (spend_by_segment, ("gold_clientes_valor",)),
    "top_customers": (top_customers, ("gold_clientes_valor",)),
    "abandoned_top": (abandoned_top, ("gold_carritos_abandonados",)),
    "stream_kpis": (stream_kpis, ("gold_actividad_stream", "gold_alertas")),
    "activity_by_events": (activity_by_events, ("gold_actividad_stream",)),
    "latest_alerts": (latest_alerts, ("gold_alertas",)),
    "external_kpis": (external_kpis, ("gold_catalogo_externo",)),
    "external_benchmark": (external_benchmark, ("gold_catalogo_externo",)),
    "external_price_by_brand": (external_price_by_brand, ("gold_catalogo_externo",)),
    "run_history": (run_history, ("runs",)),
}


def write_csv(rows: DataFrame, path: str) -> None:
    """Any report as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)
