"""The registered queries: one per operator or table, over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from .. import schemas, streaming
from ..functions import (
    calendar_columns,
    day_from_text,
    event_instant,
    is_email,
    lower_trim,
    price_value,
    register_functions,
    shoe_size,
    title_trim,
    wall_clock,
)
from ..operators import Checked, KeyedState, Stage, keep_earliest, keep_latest, reject_summary
from ..plans import gold, reports, silver
from ..sources import (
    Family,
    Lake,
    Manifest,
    file_manifest,
    land_csv,
    land_json_array,
    land_lines,
    read_event_files,
    read_returns_history,
    read_sales_history,
    read_suppliers,
    text_events,
    write_snapshot,
)
from ..sources.feeds import named_csv
from . import shop
from .shop import RULES

Query = Callable[[SparkSession, str], DataFrame]

# Micro-batches in which the streaming queries work off their lines.
BATCHES = 4


def presented(rows: DataFrame) -> DataFrame:
    """The output edge: exact money as DOUBLE, instants as UTC wall-clock time."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, TimestampType):
            column = wall_clock(column)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


class Shop:
    """All tables of the shop as lazy DataFrames over one set of benchmark tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def stage(self) -> Stage:
        return Stage(self.spark, "query")

    def raw(self, name: str) -> DataFrame:
        return getattr(shop, name)(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return shop.table(self.spark, self.sf_dir, name)

    # Silver, with rejects

    @cached_property
    def customers(self) -> Checked:
        return silver.customers(self.raw("clientes"), RULES)

    @cached_property
    def products(self) -> Checked:
        return silver.products(self.raw("productos"), RULES)

    @cached_property
    def variants(self) -> Checked:
        return silver.variants(self.raw("variantes"))

    @cached_property
    def inventory(self) -> Checked:
        return silver.inventory(self.raw("inventario"), self.variants.accepted)

    @cached_property
    def orders(self) -> Checked:
        return silver.orders(self.raw("pedidos"), RULES)

    @cached_property
    def order_lines(self) -> Checked:
        return silver.order_lines(self.raw("detalle_pedido"))

    @cached_property
    def returns(self) -> Checked:
        return silver.returns(self.raw("devoluciones"), self.orders.accepted)

    @cached_property
    def sales_history(self) -> Checked:
        return silver.sales_history(self.raw("ventas_historicas"))

    @cached_property
    def returns_history(self) -> Checked:
        return silver.returns_history(self.raw("devoluciones_historicas"))

    @cached_property
    def events(self) -> Checked:
        return silver.events(self.raw("events_raw"), RULES)

    @cached_property
    def external_catalog(self) -> Checked:
        return silver.external_catalog(self.raw("catalogo_api"))

    @cached_property
    def known_variants(self) -> DataFrame:
        """Valid variants, stored for queries that use them several times."""
        return self.stage.keep(self.variants.accepted, "variantes")

    def order_view_of(self, orders: DataFrame) -> DataFrame:
        return silver.order_view(
            orders,
            self.order_lines.accepted,
            silver.payments(self.raw("pagos")),
            self.known_variants,
            self.stage.keep,
        )

    @cached_property
    def order_view(self) -> DataFrame:
        return self.order_view_of(self.orders.accepted)

    @property
    def checked(self) -> dict[str, Checked]:
        return {
            "clientes": self.customers,
            "productos": self.products,
            "variantes": self.variants,
            "inventario": self.inventory,
            "pedidos": self.orders,
            "detalle_pedido": self.order_lines,
            "devoluciones": self.returns,
            "historico_ventas": self.sales_history,
            "historico_devoluciones": self.returns_history,
            "eventos": self.events,
            "catalogo_externo": self.external_catalog,
        }

    # Gold

    @cached_property
    def sales(self) -> DataFrame:
        return gold.unified_sales(self.order_view, self.sales_history.accepted, RULES)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily_sales(self.sales)

    @cached_property
    def top(self) -> DataFrame:
        return gold.top_products(
            self.sales, self.known_variants, self.products.accepted, RULES, keep=self.stage.keep
        )

    @cached_property
    def attributes(self) -> DataFrame:
        return gold.sales_by_attribute(self.sales, self.known_variants, keep=self.stage.keep)

    @cached_property
    def funnel(self) -> DataFrame:
        return gold.conversion_funnel(self.events.accepted, RULES)

    @cached_property
    def carts(self) -> DataFrame:
        return gold.abandoned_carts(self.events.accepted, self.variants.accepted, self.products.accepted, RULES)

    @cached_property
    def stock(self) -> DataFrame:
        inventory = silver.inventory(self.raw("inventario"), self.known_variants)
        return gold.critical_stock(inventory.accepted, self.known_variants, self.products.accepted, RULES)

    @cached_property
    def rates(self) -> DataFrame:
        orders = self.stage.keep(self.orders.accepted, "pedidos")  # for the order view and for the returns
        returns = silver.returns(self.raw("devoluciones"), orders)
        return gold.return_rate(
            self.order_view_of(orders), returns.accepted, self.products.accepted, RULES, keep=self.stage.keep
        )

    @cached_property
    def value(self) -> DataFrame:
        return gold.customer_value(self.order_view, self.customers.accepted, RULES, keep=self.stage.keep)

    @cached_property
    def benchmark(self) -> DataFrame:
        return gold.external_catalog_benchmark(self.external_catalog.accepted)

    # live

    @cached_property
    def live(self) -> DataFrame:
        return streaming.parse_events(self.raw("event_lines"), RULES)

    @cached_property
    def activity(self) -> DataFrame:
        return streaming.activity(self.live)

    @cached_property
    def alerts(self) -> DataFrame:
        return streaming.stock_alerts(self.live, RULES)


# --- cleansing and general operators ------------------------------------------------------------------------------

def clean_size(s: Shop) -> DataFrame:
    return s.raw("variantes").select("id", F.day("_ingest_date").alias("dia"), shoe_size("talla").alias("talla"))


def clean_date(s: Shop) -> DataFrame:
    return s.raw("ventas_historicas").select("orden_ref", day_from_text("fecha").alias("fecha"))


def clean_price(s: Shop) -> DataFrame:
    return s.raw("ventas_historicas").select("orden_ref", price_value("precio_unitario").alias("precio"))


def clean_email(s: Shop) -> DataFrame:
    cleaned = s.raw("clientes").select("id", F.day("_ingest_date").alias("dia"), lower_trim("correo").alias("correo"))
    return cleaned.withColumn("valido", F.coalesce(is_email("correo", RULES.email_pattern), F.lit(False)))


def clean_text(s: Shop) -> DataFrame:
    return s.raw("clientes").select(
        "id", F.day("_ingest_date").alias("dia"), F.trim("nombre").alias("nombre"), title_trim("ciudad").alias("ciudad")
    )


def calendar_attributes(s: Shop) -> DataFrame:
    days = s.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"))
    return days.select("*", *calendar_columns("fecha"))


def dedupe_latest_snapshot(s: Shop) -> DataFrame:
    latest = keep_latest(s.raw("pedidos").drop("_source"), ["id"])
    return latest.withColumn("estado", lower_trim("estado")).drop("_ingested_at")


def dedupe_earliest_event(s: Shop) -> DataFrame:
    first = keep_earliest(s.table("events").drop("props"), ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "ts", "event_id", "value")


# --- Bronze -------------------------------------------------------------------------------------------------------


def bronze_snapshot(s: Shop) -> DataFrame:
    """Two days written, the second one twice: the table holds each day once."""
    path = s.stage.at("pedidos")
    snapshots = s.raw("pedidos")
    write_snapshot(snapshots, path)
    write_snapshot(snapshots.where(F.col("_ingest_date") == F.lit("2024-01-02").cast("date")), path)
    return s.spark.read.parquet(path).drop("_ingested_at")


def bronze_manifest(s: Shop) -> DataFrame:
    """Files of the raw tables with their records, told per table (a table may have many files)."""
    found = [
        file_manifest(s.table(name)).select(F.lit(f"{name}.parquet").alias("archivo"), "registros")
        for name in ("customer", "part", "orders", "lineitem", "events")
    ]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("archivo").agg(F.sum("registros").alias("registros"))


def src_csv_history(s: Shop) -> DataFrame:
    """Sales history written as CSV files with another column order, landed in Bronze and read back by name."""
    raw, landed = s.stage.at("raw"), s.stage.at("bronze")
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    sales = s.raw("ventas_historicas")
    sales.select(*reversed(sales.columns)).write.options(header=True, **keep_spaces).csv(raw)
    land_csv(s.spark, raw, landed, schemas.SALES_HISTORY)
    return read_sales_history(s.spark, landed, landed=True).drop("_archivo").withColumn("precio_unitario", price_value("precio_unitario"))


def _texts_landed(s: Shop, family: str, schema: str) -> tuple[Manifest, Family]:
    place = partial(land_csv, schema=schema), partial(named_csv, schema=schema)
    return Manifest(s.spark, s.stage.at("manifest")), Family(family, s.stage.at(f"raw_{family}"), s.stage.at(f"bronze_{family}"), *place)


def bronze_landing(s: Shop) -> DataFrame:
    """Returns history as CSV files that come in twice, with a landing after each and one in between that finds nothing new: the manifest's
    records per landing, and the records of the landed copy of its files."""
    manifest, family = _texts_landed(s, "devoluciones", schemas.RETURNS_HISTORY)
    rows = s.raw("devoluciones_historicas")
    first = F.coalesce(F.col("motivo") != "DEFECTO", F.lit(True))
    for run, part in enumerate((rows.where(first), None, rows.where(~first)), 1):
        if part is not None:
            part.write.mode("append").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(family.source)
        manifest.land(family, datetime(2024, 1, run))
    names = F.element_at(F.split("archivo", "/"), -1)
    log = manifest.log().select(F.day("_ingested_at").alias("corrida"), "registros", names.alias("_archivo"))
    held = read_returns_history(s.spark, family.target, landed=True).groupBy("_archivo").agg(F.count(F.lit(1)).alias("n"))
    return log.join(held, "_archivo", "left").groupBy("corrida").agg(
        F.sum("registros").alias("registros"), F.sum("n").alias("en_bronze")
    )


def src_supplier_arrays(s: Shop) -> DataFrame:
    """Suppliers as files of one JSON array each (up to a thousand suppliers), landed as lines and read back."""
    raw, landed = s.stage.at("raw"), s.stage.at("bronze")
    makers = s.raw("proveedores").withColumn("part", F.floor(F.regexp_extract("proveedor_id", r"(\d+)", 1).cast("long") / 1000))
    arrays = makers.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*schemas.field_names(schemas.SUPPLIERS)))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(raw)
    land_json_array(s.spark, raw, landed)
    return silver.suppliers(read_suppliers(s.spark, landed, landed=True))


def src_event_files(s: Shop) -> DataFrame:
    """Events from two folders in one scan: a backfill of files that is landed by manifest, and the copy that the stream writes."""
    backfill, copied, raw = s.stage.at("bronze/historico"), s.stage.at("bronze/stream"), s.stage.at("raw")
    lines = s.raw("event_lines")
    old = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    lines.where(old).write.text(raw)
    manifest = Manifest(s.spark, s.stage.at("manifest"))
    manifest.land(Family("eventos_web", raw, backfill, land_lines, lambda spark, paths: spark.read.text(paths)))
    lines.where(~old).write.text(copied)
    return silver.events(read_event_files(s.spark, [backfill, copied]), RULES).accepted


def sql_cleaning(s: Shop) -> DataFrame:
    """The sales history cleaned in SQL, with the session's own functions."""
    register_functions(s.spark)
    return s.spark.sql(
        """SELECT orden_ref, clean_date(fecha) AS fecha, clean_upper(sku) AS sku, clean_number(cantidad) AS cantidad,
            clean_price(precio_unitario) AS precio, clean_lower(canal) AS canal FROM {sales}""",
        sales=s.raw("ventas_historicas"),
    )


def silver_orders_by_day(s: Shop, deletes: bool = False) -> DataFrame:
    """Orders that come in day by day: each day is written to Bronze and merged into the state. The last day is ingested twice."""
    path, snapshots = s.stage.at("bronze"), s.raw("pedidos")
    state = KeyedState(s.spark, s.stage.at("state"), ["id"], deletes=deletes)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        write_snapshot(snapshots.where(F.col("_ingest_date") == F.lit(day).cast("date")), path)
        state.update(s.spark.read.parquet(path), ["cliente_id", "fecha", "estado", "total"])
    return silver.orders(state.rows().drop("_ingested_at", "_ingest_date"), RULES).accepted


# --- streaming ----------------------------------------------------------------------------------------------------


def _replayed(s: Shop) -> Lake:
    """Runs the streaming job over the event lines in several micro-batches until all are worked off; the lake holds what it
    wrote. The events of a session are spread over the micro-batches."""
    lines, lake = s.stage.at("lines"), Lake(s.stage.at("lake"))
    files = max(int(s.spark.conf.get("spark.sql.shuffle.partitions")), BATCHES)
    s.raw("event_lines").repartition(files, "value").write.text(lines)
    records = text_events(s.spark, lines, files_per_trigger=-(-files // BATCHES))
    streaming.start(records, streaming.LiveSinks(lake, rules=RULES), every=None).awaitTermination()
    return lake


def _stream_copy(s: Shop, lake: Lake) -> DataFrame:
    copy = s.spark.read.schema(schemas.EVENT).json(lake.bronze("eventos_web", "stream")).select(*schemas.field_names(schemas.EVENT))
    return copy.withColumn("ts", event_instant("ts"))


def stream_parse_events(s: Shop) -> DataFrame:
    return s.live.select(*schemas.field_names(schemas.EVENT))


def stream_bronze_copy(s: Shop) -> DataFrame:
    return _stream_copy(s, _replayed(s))


def stream_activity(s: Shop) -> DataFrame:
    """The activity of all micro-batches: what can be added up is, the sessions are counted in the copy of the events."""
    lake = _replayed(s)
    totals = s.spark.read.parquet(lake.gold("gold_actividad_stream")).groupBy("event_type").agg(
        F.sum("eventos").alias("eventos"), F.min("primero_ts").alias("primero_ts"), F.max("ultimo_ts").alias("ultimo_ts")
    )
    counted = _stream_copy(s, lake).groupBy("event_type").agg(F.count_distinct("session_id").alias("sesiones"))
    return totals.join(counted, "event_type")


def stream_sessions_sketch(s: Shop) -> DataFrame:
    """Sessions that span micro-batches, from united sketches: within three percent of the exact number?"""
    lake = _replayed(s)
    united = streaming.sessions(s.spark.read.parquet(lake.gold("gold_actividad_stream")), "event_type")
    exact = _stream_copy(s, lake).groupBy("event_type").agg(F.count_distinct("session_id").alias("exacto"))
    near = F.abs(F.col("sesiones") - F.col("exacto")) <= 0.03 * F.col("exacto")
    return united.join(exact, "event_type").select("event_type", near.alias("cerca"))


def stream_activity_windowed(s: Shop) -> DataFrame:
    """Activity per hour. The second copies of purchases come in later micro-batches than the first and are not counted. The lines are in no
    order of time, so no event may count as late here."""
    lines = s.stage.at("lines")
    jobs = streaming.WindowJobs(Lake(s.stage.at("lake")), window="1 hour", late="36500 days", rules=RULES)
    for late, files in ((0, BATCHES), (2, 2)):
        shop.event_lines(s.spark, s.sf_dir, copies=(late,)).repartition(files, "value").write.mode("append").text(lines)
    jobs.start_once(text_events(s.spark, lines, files_per_trigger=2), every=None).awaitTermination()
    jobs.start_windows(s.spark, every=None, files_per_trigger=4 * BATCHES).awaitTermination()
    current = streaming.current_windows(s.spark.read.parquet(jobs.windows))
    return current.select("desde", "event_type", "eventos", "unidades", "primero_ts", "ultimo_ts")


def stream_stock_alerts(s: Shop) -> DataFrame:
    return s.spark.read.parquet(_replayed(s).gold("gold_alertas")).drop("procesado_en", "corrida", "lote")


# --- reports ------------------------------------------------------------------------------------------------------


def report_kpis(s: Shop) -> DataFrame:
    """Daily sales and best product come from the same sales, which are summed up once. One best product needs no ranks."""
    s.sales = s.stage.keep(s.sales, "ventas")
    sold = gold.product_sales(s.sales, s.known_variants, s.products.accepted).withColumn("nombre", F.coalesce("nombre", "sku"))
    return reports.kpis(s.daily, sold, s.stock)


# --- registry -----------------------------------------------------------------------------------------------------

_QUERIES: dict[str, Callable[[Shop], DataFrame]] = {
    "clean_size": clean_size,
    "clean_date": clean_date,
    "clean_price": clean_price,
    "clean_email": clean_email,
    "clean_text": clean_text,
    "calendar_attributes": calendar_attributes,
    "dedupe_latest_snapshot": dedupe_latest_snapshot,
    "dedupe_earliest_event": dedupe_earliest_event,
    "rejects_summary": lambda s: reject_summary(s.checked),
    "bronze_snapshot": bronze_snapshot,
    "bronze_manifest": bronze_manifest,
    "bronze_landing": bronze_landing,
    "src_csv_history": src_csv_history,
    "src_supplier_arrays": src_supplier_arrays,
    "src_event_files": src_event_files,
    "sql_cleaning": sql_cleaning,
    "rejects_customers": lambda s: s.customers.rejected,
    "rejects_products": lambda s: s.products.rejected,
    "rejects_variants": lambda s: s.variants.rejected,
    "rejects_inventory": lambda s: s.inventory.rejected,
    "rejects_orders": lambda s: s.orders.rejected,
    "rejects_order_lines": lambda s: s.order_lines.rejected,
    "rejects_returns": lambda s: s.returns.rejected,
    "rejects_sales_history": lambda s: s.sales_history.rejected,
    "rejects_returns_history": lambda s: s.returns_history.rejected,
    "rejects_events": lambda s: s.events.rejected,
    "rejects_external_catalog": lambda s: s.external_catalog.rejected,
    "silver_customers": lambda s: s.customers.accepted,
    "silver_products": lambda s: s.products.accepted,
    "silver_variants": lambda s: s.variants.accepted,
    "silver_inventory": lambda s: s.inventory.accepted,
    "silver_orders": lambda s: s.orders.accepted,
    "silver_orders_by_day": silver_orders_by_day,
    "silver_orders_deleted": lambda s: silver_orders_by_day(s, deletes=True),
    "silver_order_lines": lambda s: s.order_lines.accepted,
    "silver_order_view": lambda s: s.order_view,
    "silver_returns": lambda s: s.returns.accepted,
    "silver_sales_history": lambda s: s.sales_history.accepted,
    "silver_returns_history": lambda s: s.returns_history.accepted,
    "silver_suppliers": lambda s: silver.suppliers(s.raw("proveedores")),
    "silver_events": lambda s: s.events.accepted,
    "silver_external_catalog": lambda s: s.external_catalog.accepted,
    "gold_unified_sales": lambda s: s.sales,
    "gold_daily_sales": lambda s: s.daily,
    "gold_top_products": lambda s: s.top,
    "gold_sales_by_attribute": lambda s: s.attributes,
    "gold_conversion_funnel": lambda s: s.funnel,
    "gold_abandoned_carts": lambda s: s.carts,
    "gold_critical_stock": lambda s: s.stock,
    "gold_return_rate": lambda s: s.rates,
    "gold_customer_value": lambda s: s.value,
    "gold_external_catalog_benchmark": lambda s: s.benchmark,
    "stream_parse_events": stream_parse_events,
    "stream_bronze_copy": stream_bronze_copy,
    "stream_activity": stream_activity,
    "stream_sessions_sketch": stream_sessions_sketch,
    "stream_activity_windowed": stream_activity_windowed,
    "stream_stock_alerts": stream_stock_alerts,
    "report_kpis": report_kpis,
    "report_range_summary": lambda s: reports.range_summary(s.daily, "1996-01-01", "1997-12-31"),
    "report_monthly_sales": lambda s: reports.monthly_sales(s.daily),
    "report_funnel_pct": lambda s: reports.funnel_percent(s.funnel),
    "report_top_products": lambda s: reports.top_products(s.top),
    "report_income_by_category": lambda s: reports.income_by_category(s.top),
    "report_demand_by_size": lambda s: reports.demand_by(s.attributes, "talla"),
    "report_demand_by_color": lambda s: reports.demand_by(s.attributes, "color"),
    "report_top_products_filtered": lambda s: reports.top_products(s.top, None, categories=["economy", "medium"]),
    "report_critical_stock": lambda s: reports.critical_stock(s.stock),
    "report_return_pct": lambda s: reports.return_percent(s.rates),
    "report_segment_kpis": lambda s: reports.segment_kpis(s.value, ["frecuente", "recurrente"]),
    "report_spend_by_segment": lambda s: reports.spend_by_segment(s.value),
    "report_top_customers": lambda s: reports.top_customers(s.value),
    "report_abandoned_top": lambda s: reports.abandoned_top(s.carts),
    "report_stream_kpis": lambda s: reports.stream_kpis(s.activity, s.alerts, RULES),
    "report_latest_alerts": lambda s: reports.latest_alerts(s.alerts),
    "report_activity": lambda s: reports.activity_by_events(s.activity).drop("procesado_en"),
    "report_external_benchmark": lambda s: reports.external_benchmark(s.benchmark),
    "report_external_kpis": lambda s: reports.external_kpis(s.benchmark),
    "report_external_price_by_brand": lambda s: reports.external_price_by_brand(s.benchmark),
    "report_run_history": lambda s: reports.run_history(s.raw("runs")),
}


def _registered(build: Callable[[Shop], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(build(Shop(spark, sf_dir)))

    return query


def queries() -> dict[str, Query]:
    return {name: _registered(build) for name, build in _QUERIES.items()}
