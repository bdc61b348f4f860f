"""The batch run: Bronze to Silver to Gold, with a record of what happened."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import Checked, KeyedState, Stage
from ..rules import DEFAULT_RULES, ShopRules
from ..sources import Database, Family, Manifest, MissingTable, Split, stamped, write_snapshot
from ..sources.feeds import (
    named_csv,
    read_catalog,
    read_event_files,
    read_returns_history,
    read_sales_history,
    read_suppliers,
)
from ..sources.lake import Lake, read_if_present, read_snapshots, read_table
from ..sources.landing import file_listing, land_catalog, land_csv, land_json_array, land_lines
from . import gold, reports, silver

log = logging.getLogger(__name__)

# The database tables, and the columns by which large ones are read in parallel.
DATABASE_TABLES: Mapping[str, Split] = {
    "clientes": Split("id"),
    "productos": Split("id"),
    "variantes": Split("id"),
    "inventario": Split("variante_id"),
    "pedidos": Split("id"),
    "detalle_pedido": Split("pedido_id"),
    "pagos": Split("pedido_id"),
    "devoluciones": Split("pedido_id"),
}


# What Silver needs of them: keys and other columns.
TABLE_STATES: Mapping[str, tuple[list[str], list[str]]] = {
    "clientes": (["id"], ["nombre", "correo", "ciudad", "fecha_registro"]),
    "productos": (["id"], ["nombre", "marca", "categoria", "precio"]),
    "variantes": (["id"], ["producto_id", "talla", "color", "sku"]),
    "inventario": (["variante_id"], ["stock_disponible", "bodega"]),
    "pedidos": (["id"], ["cliente_id", "fecha", "estado", "total"]),
    "detalle_pedido": (["pedido_id", "variante_id"], ["cantidad", "precio"]),
    "pagos": (["pedido_id"], ["metodo", "estado", "monto"]),
    "devoluciones": (["pedido_id"], ["motivo", "fecha"]),
}


def _counted_write(rows: DataFrame, path: str) -> int:
    """Writes a table and tells its number of rows, counted while writing."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("filas")).write.mode("overwrite").parquet(path)
    return seen.get["filas"]


# --- Bronze ------------------------------------------------------------------------------------------------------


def ingest_database(spark: SparkSession, database: Database, lake: Lake, at: datetime | None = None) -> dict[str, int]:
    """Today's snapshot of every table; running it again replaces today's snapshot."""
    counts = {}
    for table, split in DATABASE_TABLES.items():
        seen = Observation()
        rows = stamped(database.read(spark, table, split), f"postgresql:{table}", at)
        write_snapshot(rows.observe(seen, F.count(F.lit(1)).alias("filas")), lake.bronze("postgres", table))
        counts[table] = seen.get["filas"]
    return counts


def ingest_files(spark: SparkSession, raw: str, lake: Lake, at: datetime | None = None) -> dict[str, int]:
    """What is new or has changed among the raw files to Bronze, each family in its own format; returns the files landed of each. The
    event backfill may be missing."""
    raw = raw.rstrip("/")
    families = [
        Family(
            "historico_ventas", f"{raw}/historico_ventas", lake.bronze("historico_ventas"),
            partial(land_csv, schema=schemas.SALES_HISTORY), partial(named_csv, schema=schemas.SALES_HISTORY),
        ),
        Family(
            "historico_devoluciones", f"{raw}/devoluciones_historicas.csv", lake.bronze("historico_devoluciones"),
            partial(land_csv, schema=schemas.RETURNS_HISTORY), partial(named_csv, schema=schemas.RETURNS_HISTORY),
        ),
        Family("proveedores", f"{raw}/proveedores.json", lake.bronze("proveedores"), land_json_array, read_suppliers),
    ]
    try:
        file_listing(spark, [family.source for family in families])
    except AnalysisException as problem:
        raise MissingTable(f"raw files are missing below {raw}: {problem.getMessage()}") from problem
    events = f"{raw}/eventos_web"
    if read_if_present(file_listing, spark, [events]) is None:
        log.warning("no event backfill below %s: events come from the stream alone", raw)
    else:
        backfill = lake.bronze("eventos_web", "historico")
        families.append(Family("eventos_web", events, backfill, land_lines, lambda session, paths: session.read.text(paths)))
    manifest = Manifest(spark, lake.bronze("_manifiesto"))
    return {family.name: manifest.land(family, at) for family in families}


def ingest_catalog(spark: SparkSession, source: str, lake: Lake, provider: str, at: datetime | None = None) -> bool:
    """The external catalogue is optional: whatever goes wrong with it, the run goes on without it."""
    try:
        land_catalog(spark, source, lake.bronze("api_catalogo"), provider, at)
    except Exception as problem:  # refused access and failed tasks have types of their own
        log.warning("external catalogue not ingested: %s", problem)
        return False
    return True


# --- Silver ------------------------------------------------------------------------------------------------------


def _event_folders(spark: SparkSession, lake: Lake) -> DataFrame:
    """Backfill and stream copy, whichever exist."""
    folders = [lake.bronze("eventos_web", name) for name in ("historico", "stream")]
    present = [path for path in folders if read_if_present(spark.read.text, path) is not None]
    if not present:
        raise MissingTable("no events in Bronze: run the ingest step or the stream first")
    return read_event_files(spark, present)


def _last_versions(spark: SparkSession, lake: Lake, table: str, deletes: bool) -> DataFrame:
    """The state of a database table after the days that are new to it."""
    keys, columns = TABLE_STATES[table]
    state = KeyedState(spark, lake.state(table), keys, deletes=deletes)
    return state.update(read_snapshots(spark, lake, table), columns).drop("_ingested_at", "_ingest_date")


def run_silver(
    spark: SparkSession, lake: Lake, rules: ShopRules = DEFAULT_RULES, incremental: bool = False, latest_only: bool = False
) -> dict[str, int]:
    """Builds and writes all Silver tables and their rejects; returns the rows per table.

    By default every run reads every ingest day of the database tables. ``incremental`` runs keep the last version of each row and read
    the days since the last run (the last day again where there is no new one). ``latest_only`` takes each day for a complete copy of
    its table: what the last day lacks was deleted.
    """
    counts: dict[str, int] = {}

    def bronze(table: str) -> DataFrame:
        if incremental:
            return _last_versions(spark, lake, table, latest_only)
        return read_snapshots(spark, lake, table, latest_only)

    def write(table: str, rows: DataFrame) -> DataFrame:
        counts[table] = _counted_write(rows, lake.silver(table))
        return spark.read.schema(rows.schema).parquet(lake.silver(table))

    with Stage(spark, "silver") as stage:

        def split(table: str, rejects: str, checked: Checked) -> DataFrame:
            """Cleans and tags once, then writes rejects (even none, so that old ones disappear) and valid rows."""
            tagged = checked.with_marked(stage.keep(checked.marked, table))
            counts[f"rechazados/{rejects}"] = _counted_write(tagged.rejected, lake.rejects(rejects))
            return write(table, tagged.accepted)

        split("silver_clientes", "clientes", silver.customers(bronze("clientes"), rules))
        split("silver_productos", "productos", silver.products(bronze("productos"), rules))
        variants = split("silver_variantes", "variantes", silver.variants(bronze("variantes")))
        split("silver_inventario", "inventario", silver.inventory(bronze("inventario"), variants))
        orders = split("silver_pedidos", "pedidos", silver.orders(bronze("pedidos"), rules))
        lines = silver.order_lines(bronze("detalle_pedido"))
        lines = lines.with_marked(stage.keep(lines.marked, "detalle_pedido"))
        counts["rechazados/detalle_pedido"] = _counted_write(lines.rejected, lake.rejects("detalle_pedido"))
        paid = silver.payments(bronze("pagos"))
        write("silver_pedido_detalle", silver.order_view(orders, lines.accepted, paid, variants, stage.keep))
        split("silver_devoluciones", "devoluciones", silver.returns(bronze("devoluciones"), orders))

        sales = read_sales_history(spark, lake.bronze("historico_ventas"), landed=True)
        split("silver_historico_ventas", "historico_ventas", silver.sales_history(sales))
        returned = read_returns_history(spark, lake.bronze("historico_devoluciones"), landed=True)
        split("silver_historico_devoluciones", "historico_devoluciones", silver.returns_history(returned))
        write("silver_proveedores", silver.suppliers(read_suppliers(spark, lake.bronze("proveedores"), landed=True)))
        split("silver_eventos_navegacion", "eventos", silver.events(_event_folders(spark, lake), rules))

        catalog = read_if_present(read_catalog, spark, lake.bronze("api_catalogo"))
        if catalog is None:
            log.warning("silver_catalogo_externo left out: the external catalogue was never ingested")
        else:
            split("silver_catalogo_externo", "catalogo_externo", silver.external_catalog(catalog))
    return counts


# --- Gold --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    """A Gold table: what it reads and how it is built.

    ``ruled`` builders take the business rules, ``kept`` ones a place for intermediate tables. An ``optional`` table is
    left out when an input is missing.
    """

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    ruled: bool = True
    kept: bool = False
    optional: bool = False


SALES = "ventas_unificadas"

METRICS: Mapping[str, Metric] = {
    "gold_ventas_diarias": Metric(gold.daily_sales, (SALES,), ruled=False),
    "gold_top_productos": Metric(gold.top_products, (SALES, "silver_variantes", "silver_productos"), kept=True),
    "gold_ventas_por_talla": Metric(gold.sales_by_attribute, (SALES, "silver_variantes"), ruled=False, kept=True),
    "gold_embudo_conversion": Metric(gold.conversion_funnel, ("silver_eventos_navegacion",)),
    "gold_carritos_abandonados": Metric(
        gold.abandoned_carts, ("silver_eventos_navegacion", "silver_variantes", "silver_productos")
    ),
    "gold_stock_critico": Metric(
        gold.critical_stock, ("silver_inventario", "silver_variantes", "silver_productos")
    ),
    "gold_tasa_devolucion": Metric(
        gold.return_rate, ("silver_pedido_detalle", "silver_devoluciones", "silver_productos")
    ),
    "gold_clientes_valor": Metric(gold.customer_value, ("silver_pedido_detalle", "silver_clientes"), kept=True),
    "gold_catalogo_externo": Metric(
        gold.external_catalog_benchmark, ("silver_catalogo_externo",), ruled=False, optional=True
    ),
}


def run_gold(spark: SparkSession, lake: Lake, rules: ShopRules = DEFAULT_RULES) -> dict[str, int]:
    """Builds and writes all Gold tables; returns the rows per table."""

    def table(name: str) -> DataFrame:
        return read_table(spark, lake.silver(name), "run the Silver step first")

    counts = {}
    with Stage(spark, "gold") as stage:
        # three metrics read the unified sales: summed up once
        sales = stage.keep(
            gold.unified_sales(table("silver_pedido_detalle"), table("silver_historico_ventas"), rules), SALES
        )
        for name, metric in METRICS.items():
            try:
                inputs = [sales if source == SALES else table(source) for source in metric.inputs]
            except MissingTable:
                if not metric.optional:
                    raise
                log.warning("%s left out: its source was never ingested", name)
                continue
            options = {"rules": rules} if metric.ruled else {}
            if metric.kept:
                options["keep"] = stage.keep
            counts[name] = _counted_write(metric.build(*inputs, **options), lake.gold(name))
    return counts


LIVE_TABLES = {"gold_actividad_stream": schemas.ACTIVITY, "gold_alertas": schemas.ALERTS}


def _report_input(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    if table == "runs":
        return read_runs(spark, lake)
    if table in LIVE_TABLES:
        written = read_if_present(spark.read.schema(LIVE_TABLES[table]).parquet, lake.gold(table))
        return spark.createDataFrame([], LIVE_TABLES[table]) if written is None else written
    return read_table(spark, lake.gold(table), "run the Gold step first")


def report(spark: SparkSession, lake: Lake, name: str, **options) -> DataFrame:
    """A report of ``reports.REPORTS`` over the tables in the lake. A stream that wrote nothing yet counts as empty."""
    build, tables = reports.REPORTS[name]
    return build(*[_report_input(spark, lake, table) for table in tables], **options)


# --- the run and its record --------------------------------------------------------------------------------------


def log_run(spark: SparkSession, lake: Lake, record: Mapping) -> None:
    names = schemas.field_names(schemas.RUN_LOG)
    row = [tuple(record.get(name) for name in names)]
    spark.createDataFrame(row, schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(lake.metadata("runs"))


def read_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.metadata("runs"), "no run was recorded")


def run_batch(
    spark: SparkSession,
    lake: Lake,
    ingest: Callable[[], Mapping[str, int]] | None = None,
    rules: ShopRules = DEFAULT_RULES,
    incremental: bool = False,
    latest_only: bool = False,
) -> dict[str, Mapping[str, int]]:
    """Ingest (if given), Silver (see ``run_silver`` for its options) and Gold. The run is recorded in the lake, also when it fails."""
    began, clock = datetime.now(), time.monotonic()
    record: dict = {"inicio": began, "estado": "error"}
    try:
        record["bronze"] = dict(ingest()) if ingest else {}
        record["silver"] = run_silver(spark, lake, rules, incremental, latest_only)
        record["gold"] = run_gold(spark, lake, rules)
        record["estado"] = "ok"
    except Exception as problem:
        record["error"] = f"{type(problem).__name__}: {problem}"[:500]
        raise
    finally:
        record["fin"] = datetime.now()
        record["duracion_s"] = round(time.monotonic() - clock, 1)
        log_run(spark, lake, record)
    return {layer: record[layer] for layer in ("bronze", "silver", "gold")}
