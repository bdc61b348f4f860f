"""Benchmark tables as the shop's raw inputs.

Each function reads whole tables and gives every row the shape, the dirt and the repeated versions that raw shop data
has. The formulas are deterministic; ``oracle.py`` states the same facts about the clean values, so that a query has to
clean its input to agree. Tables from the database come as snapshots of two days: a row whose key divides by 11 was
last seen on the first day, and on the first day every seventh row had an outdated value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..rules import ShopRules

RULES = ShopRules(categories=("economy", "standard", "medium", "large", "small"))

_DAYS = "IF(k % 11 = 0, array(1), array(1, 2))"
_OLD = "(dia = 1 AND k % 7 = 0)"
_SIZE = "CAST(36 + p_size % 8 AS STRING)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _snapshots(rows: DataFrame, key: str, columns: list[str], source: str) -> DataFrame:
    """Both days of a table. ``columns`` may use ``k`` (the key), ``dia`` (the day) and the columns of ``rows``."""
    days = rows.withColumn("k", F.col(key)).withColumn("dia", F.explode(F.expr(_DAYS)))
    return days.selectExpr(
        *columns,
        "IF(dia = 1, TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-02 00:00:00') AS _ingested_at",
        f"'postgresql:{source}' AS _source",
        "IF(dia = 1, DATE'2024-01-01', DATE'2024-01-02') AS _ingest_date",
    )


def _as_read(rows: DataFrame, *columns, others=()) -> DataFrame:
    """Computes generated columns once per row, as if they had been read from a file.

    Without this the optimizer would merge the generating formulas into every filter that comes later. ``others`` are columns that no
    filter uses: where a query does not want them, they are not made, as a file's columns are not read.
    """
    return rows.select(F.inline(F.array(F.struct(*columns))), *others)


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    return lines.select(F.inline(F.array(F.from_json("value", schema))))


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    address = "concat('c', IF(k % 50 = 1, k - 1, k), '@example.com')"
    return _snapshots(
        people,
        "c_custkey",
        [
            "k AS id",
            "concat('  ', c_name, ' ') AS nombre",
            f"""CASE WHEN k % 211 = 0 THEN NULL WHEN k % 97 = 0 THEN concat('sin-arroba-', k, '.example.com')
                WHEN k % 53 = 0 THEN concat('  ', upper({address}), ' ') ELSE {address} END AS correo""",
            f"CASE WHEN k % 31 = 0 THEN NULL WHEN {_OLD} THEN ' ANTIGUA ciudad' ELSE concat(' ', upper(n_name)) END AS ciudad",
            "date_add(DATE'2020-01-01', CAST(k % 1000 AS INT)) AS fecha_registro",
        ],
        "clientes",
    )


def productos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(
        table(spark, sf_dir, "part"),
        "p_partkey",
        [
            "k AS id",
            "IF(k % 89 = 0, '   ', concat('  ', p_name, ' ')) AS nombre",
            "upper(p_brand) AS marca",
            "concat(' ', p_type) AS categoria",
            f"""CAST(CASE WHEN k % 41 = 0 THEN 0 WHEN k % 83 = 0 THEN NULL
                WHEN {_OLD} THEN p_retailprice + 1 ELSE p_retailprice END AS DECIMAL(10, 2)) AS precio""",
        ],
        "productos",
    )


def variantes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(
        table(spark, sf_dir, "part"),
        "p_partkey",
        [
            "k AS id",
            "k - k % 4 AS producto_id",
            f"""CASE WHEN k % 37 = 0 THEN 'XL' WHEN k % 43 = 0 THEN concat('1', {_SIZE})
                WHEN k % 6 = 0 THEN {_SIZE} WHEN k % 6 = 1 THEN concat('EU ', {_SIZE})
                WHEN k % 6 = 2 THEN concat(' T', {_SIZE}, ' ') WHEN k % 6 = 3 THEN concat('talla ', {_SIZE})
                WHEN k % 6 = 4 THEN concat({_SIZE}, ',5') ELSE concat('esp.', {_SIZE}) END AS talla""",
            f"IF({_OLD}, 'gris', concat(' ', initcap(split_part(p_name, ' ', 1)))) AS color",
            "CASE WHEN k % 101 = 0 THEN '  ' WHEN k % 103 = 0 THEN NULL ELSE concat(' sku-', k, ' ') END AS sku",
        ],
        "variantes",
    )


def inventario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(
        table(spark, sf_dir, "part"),
        "p_partkey",
        [
            "k AS variante_id",
            f"IF(k % 61 = 0, NULL, CAST((k * 7) % 121 - 1 + IF({_OLD}, 1, 0) AS INT)) AS stock_disponible",
            "concat(' bod-', k % 3) AS bodega",
        ],
        "inventario",
    )


def pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        [
            "k AS id",
            "o_custkey AS cliente_id",
            "IF(k % 199 = 0, NULL, o_orderdate) AS fecha",
            f"""CASE WHEN k % 101 = 0 THEN 'perdido' WHEN k % 103 = 0 THEN NULL WHEN {_OLD} THEN 'pendiente'
                WHEN o_orderstatus = 'F' THEN ' Entregado' WHEN o_orderstatus = 'O' THEN 'CONFIRMADO '
                WHEN k % 3 = 0 THEN 'pendiente' WHEN k % 3 = 1 THEN ' enviado' ELSE 'Cancelado' END AS estado""",
            "CAST(IF(k % 107 = 0, -1, o_totalprice) AS DECIMAL(12, 2)) AS total",
        ],
        "pedidos",
    )


def detalle_pedido(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines. The table itself repeats (order, part): the line shipped last is the last version."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS pedido_id",
        "l_partkey AS variante_id",
        "CAST(IF(l_linenumber = 7 AND l_suppkey % 10 = 0, 0, l_quantity) AS INT) AS cantidad",
        "CAST(l_extendedprice AS DECIMAL(10, 2)) AS precio",
        "CAST(l_shipdate AS TIMESTAMP) AS _ingested_at",
        "'postgresql:detalle_pedido' AS _source",
        "CAST(l_shipdate AS DATE) AS _ingest_date",
    )


def pagos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        [
            "k AS pedido_id",
            "concat(' ', o_orderpriority) AS metodo",
            f"""CASE WHEN k % 33 = 0 THEN 'FALLIDO' WHEN {_OLD} THEN 'pendiente'
                WHEN o_orderstatus = 'P' THEN 'Pendiente ' ELSE ' Confirmado' END AS estado""",
            "CAST(o_totalprice AS DECIMAL(12, 2)) AS monto",
        ],
        "pagos",
    )


_REASON = "element_at(array(' Talla', 'DEFECTO', 'color ', 'Arrepentimiento', 'otro'), CAST(l_orderkey % 5 AS INT) + 1)"


def devoluciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One return per order that has a returned line."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    per_order = returned.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("fecha"))
    return _snapshots(
        per_order,
        "l_orderkey",
        [
            "k AS pedido_id",
            f"CASE WHEN k % 97 = 0 THEN NULL WHEN {_OLD} THEN 'otro' ELSE {_REASON} END AS motivo",
            "CAST(IF(k % 89 = 0, NULL, fecha) AS DATE) AS fecha",
        ],
        "devoluciones",
    )


_DATE_TEXT = """CASE WHEN l_suppkey % 50 = 0 THEN 'sin fecha'
    WHEN l_linenumber % 4 = 0 THEN date_format(l_shipdate, 'yyyy-MM-dd')
    WHEN l_linenumber % 4 = 1 THEN date_format(l_shipdate, 'dd/MM/yyyy')
    WHEN l_linenumber % 4 = 2 THEN date_format(l_shipdate, 'dd-MM-yyyy')
    ELSE date_format(l_shipdate, 'dd.MM.yyyy') END"""


def ventas_historicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales history as CSV text: four date styles and four price styles, with broken ones among them."""
    lines = table(spark, sf_dir, "lineitem").withColumn("plain", F.expr("CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) AS STRING)"))
    names = ["fecha", "orden_ref", "sku", "cantidad", "precio_unitario", "canal", "ciudad"]
    texts = [
        f"{_DATE_TEXT} AS fecha",
        "IF(l_partkey % 113 = 0, ' ', concat(' sku-', l_partkey)) AS sku",
        "IF(l_suppkey % 71 = 0, 'muchas', CAST(CAST(l_quantity AS INT) AS STRING)) AS cantidad",
        """CASE WHEN l_partkey % 4 = 0 THEN plain
            WHEN l_partkey % 4 = 1 THEN translate(format_number(CAST(plain AS DECIMAL(10, 2)), 2), ',.', '.,')
            WHEN l_partkey % 4 = 2 THEN concat('€', format_number(CAST(plain AS DECIMAL(10, 2)), 2))
            ELSE concat(plain, ' EUR') END AS precio_unitario""",
    ]
    others = [
        "concat('H-', l_orderkey) AS orden_ref",
        "IF(l_linestatus = 'F', ' Web', 'APP') AS canal",
        "concat(' VILLA ', l_suppkey % 7) AS ciudad",
    ]
    return _as_read(lines, *map(F.expr, texts), others=[*map(F.expr, others)]).select(*names)


def devoluciones_historicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    texts = [
        f"{_DATE_TEXT} AS fecha",
        "IF(l_partkey % 71 = 0, '  ', concat(' H-', l_orderkey, ' ')) AS orden_ref",
        f"{_REASON} AS motivo",
    ]
    return _as_read(returned, *map(F.expr, texts))


def proveedores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as JSON text, parsed with the declared schema."""
    companies = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    as_json = companies.selectExpr(
        """to_json(named_struct('proveedor_id', concat(' P-', s_suppkey), 'nombre', concat(s_name, ' '),
            'contacto', concat('ventas@', s_suppkey, '.example.com'),
            'categorias', CASE WHEN s_suppkey % 17 = 0 THEN NULL
                ELSE slice(array('formal', 'deportivo', 'sandalia'), 1, CAST(s_suppkey % 3 AS INT) + 1) END,
            'pais', concat(' ', n_name), 'plazo_entrega_dias', s_suppkey % 30)) AS value"""
    )
    return _parsed(as_json, schemas.SUPPLIERS)


_KIND = """CASE event_type WHEN 'view' THEN ' Product_Viewed' WHEN 'click' THEN 'added_to_cart'
    WHEN 'signup' THEN 'CHECKOUT_STARTED' WHEN 'purchase' THEN 'order_placed ' ELSE 'stock_low' END"""


def event_lines(spark: SparkSession, sf_dir: str, again: int = 10, copies: tuple[int, ...] = (0, 2)) -> DataFrame:
    """Events as JSON lines in ``value``: every ``again``-th purchase is sent twice, some lines and fields are broken. ``copies`` are the
    seconds by which the copies to give are late."""
    sent = (
        table(spark, sf_dir, "events")
        .withColumn("p", F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)"))
        .withColumn(
            "late",
            F.explode(F.expr(f"IF(event_type = 'purchase' AND event_id % {again} = 0, array(0, 2), array(0))")),
        )
        .where(F.col("late").isin(*copies))
        .withColumn("at", F.expr("ts + make_dt_interval(0, 0, 0, late)"))
    )
    stamp = "date_format(at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    zone = "element_at(array('', '+00:00', ' Etc/UTC', '+0:00', 'Z'), CAST(event_id % 5 AS INT) + 1)"
    return sent.selectExpr(
        f"""IF(event_id % 401 = 0, '{{bad', to_json(named_struct(
            'event_id', IF(event_id % 211 = 0, '  ', concat(' e-', event_id)),
            'event_type', IF(event_id % 307 = 0, 'otro', {_KIND}),
            'ts', CASE WHEN event_id % 503 = 0 THEN 'ayer' ELSE concat({stamp}, {zone}) END,
            'session_id', IF(event_id % 409 = 0, ' ', concat(user_id, '-', date_format(ts, 'yyyyMMdd'))),
            'user_id', IF(event_id % 10 < 3, NULL, user_id),
            'producto_id', IF(event_type IN ('view', 'click', 'error'), p - p % 4, NULL),
            'variante_id', IF(event_type IN ('view', 'click', 'error'), p, NULL),
            'sku', IF(event_type IN ('view', 'click', 'error') AND event_id % 83 != 0, concat(' sku-', p), NULL),
            'cantidad', IF(event_type = 'click' AND event_id % 3 != 0, CAST(1 + event_id % 4 AS INT), NULL),
            'monto', value,
            'stock_actual', IF(event_type = 'error' AND event_id % 29 != 0, CAST(floor(value) AS INT) % 9 - 1, NULL),
            'canal', IF(event_id % 2 = 0, ' Web', 'APP')))) AS value"""
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(event_lines(spark, sf_dir), schemas.EVENT)


def catalogo_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The external catalogue as JSON text, parsed with the declared schema."""
    as_json = table(spark, sf_dir, "part").selectExpr(
        """to_json(named_struct('id', p_partkey, 'title', concat(' ', p_name), 'brand', upper(p_brand),
            'category', concat(p_type, ' '), 'price', IF(p_partkey % 41 = 0, 0, p_retailprice),
            'discountPercentage', (p_partkey % 50) / 4, 'rating', (p_partkey % 50) / 10, 'stock', p_size,
            'sku', IF(p_partkey % 59 = 0, ' ', concat('ext-', p_partkey)),
            'tags', IF(p_partkey % 13 = 0, NULL, array('shoes', lower(p_type))),
            '_categoria_api', IF(p_partkey % 2 = 0, 'mens-shoes', 'womens-shoes'),
            '_source', 'api:https://example.com', '_endpoint', '/products',
            '_ingested_at', '2024-01-02T00:00:00', '_ingest_date', '2024-01-02')) AS value"""
    )
    return _parsed(as_json, schemas.CATALOG)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log with one run per day of order intake: rows per layer are that day's orders, parts of it failed."""
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").alias("inicio"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("o_orderstatus") == "F").alias("done"),
            F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        )
    )
    return per_day.selectExpr(
        "inicio",
        "inicio + make_dt_interval(0, 0, 0, n) AS fin",
        "CAST(n AS DOUBLE) AS duracion_s",
        "IF(done = 0, 'error', 'ok') AS estado",
        "map('pedidos', n) AS bronze",
        "map('silver_pedidos', done, 'silver_devoluciones', open) AS silver",
        "IF(done = 0, NULL, map('gold_ventas_diarias', done)) AS gold",
        "IF(done = 0, 'RuntimeError: nothing delivered', NULL) AS error",
    )
