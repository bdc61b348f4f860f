"""The registered queries once more, as SQL over the benchmark tables.

The SQL states the clean values directly (``shop.py`` dirties them, the queries clean them again), and which rows are
faulty by the formula that made them so, not by the rule that finds them.
"""

from __future__ import annotations

# --- clean shop tables -------------------------------------------------------------------------------------------

_MONEY = "DECIMAL(18, 2)"

PARTS = {
    # seen on both days, or on the first only
    "dias": "SELECT * FROM (VALUES (1), (2)) AS d(dia)",
    "clientes": """
        SELECT c_custkey AS id, c_name AS nombre,
            CASE WHEN c_custkey % 211 = 0 THEN NULL
                WHEN c_custkey % 97 = 0 THEN 'sin-arroba-' || c_custkey || '.example.com'
                WHEN c_custkey % 50 = 1 THEN 'c' || (c_custkey - 1) || '@example.com'
                ELSE 'c' || c_custkey || '@example.com' END AS correo,
            CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 77 = 0 THEN 'Antigua Ciudad'
                ELSE upper(n_name[1]) || lower(n_name[2:]) END AS ciudad,
            DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS fecha_registro,
            c_custkey % 211 <> 0 AND c_custkey % 97 <> 0 AS bueno
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "clientes_ok": """
        SELECT id, nombre, correo, ciudad, fecha_registro FROM (
            SELECT *, row_number() OVER (PARTITION BY correo ORDER BY fecha_registro, id) AS rn
            FROM clientes WHERE bueno) t WHERE rn = 1""",
    "productos": f"""
        SELECT p_partkey AS id, CASE WHEN p_partkey % 89 = 0 THEN '' ELSE p_name END AS nombre, p_brand AS marca,
            lower(p_type) AS categoria,
            CAST(CASE WHEN p_partkey % 41 = 0 THEN 0 WHEN p_partkey % 83 = 0 THEN NULL
                WHEN p_partkey % 77 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS {_MONEY}) AS precio,
            p_partkey % 41 <> 0 AND p_partkey % 83 <> 0 AND p_partkey % 89 <> 0 AND p_type <> 'PROMO' AS bueno
        FROM part""",
    "productos_ok": "SELECT id, nombre, marca, categoria, precio FROM productos WHERE bueno",
    "variantes": """
        SELECT p_partkey AS id, p_partkey - p_partkey % 4 AS producto_id,
            CAST(36 + p_size % 8 AS VARCHAR) AS numero,
            CASE WHEN p_partkey % 77 = 0 THEN 'gris' ELSE lower(split_part(p_name, ' ', 1)) END AS color,
            CASE WHEN p_partkey % 101 = 0 THEN '' WHEN p_partkey % 103 = 0 THEN NULL
                ELSE 'SKU-' || p_partkey END AS sku,
            p_partkey % 37 <> 0 AND p_partkey % 43 <> 0 AS talla_buena,
            p_partkey % 37 <> 0 AND p_partkey % 43 <> 0 AND p_partkey % 101 <> 0 AND p_partkey % 103 <> 0 AS bueno
        FROM part""",
    "variantes_ok": """
        SELECT id AS variante_id, producto_id, CASE WHEN id % 6 = 4 THEN numero || '.5' ELSE numero END AS talla,
            color, sku
        FROM variantes WHERE bueno""",
    "inventario": """
        SELECT p_partkey AS variante_id,
            CASE WHEN p_partkey % 61 = 0 THEN NULL
                ELSE CAST((p_partkey * 7) % 121 - 1 + (CASE WHEN p_partkey % 77 = 0 THEN 1 ELSE 0 END) AS INTEGER)
                END AS stock_disponible,
            'BOD-' || (p_partkey % 3) AS bodega
        FROM part""",
    "inventario_ok": """
        SELECT * FROM inventario
        WHERE stock_disponible >= 0 AND variante_id IN (SELECT variante_id FROM variantes_ok)""",
    "pedidos": f"""
        SELECT o_orderkey AS id, o_custkey AS cliente_id,
            CASE WHEN o_orderkey % 199 = 0 THEN NULL ELSE o_orderdate END AS fecha,
            CASE WHEN o_orderkey % 101 = 0 THEN 'perdido' WHEN o_orderkey % 103 = 0 THEN NULL
                WHEN o_orderkey % 77 = 0 THEN 'pendiente' WHEN o_orderstatus = 'F' THEN 'entregado'
                WHEN o_orderstatus = 'O' THEN 'confirmado' WHEN o_orderkey % 3 = 0 THEN 'pendiente'
                WHEN o_orderkey % 3 = 1 THEN 'enviado' ELSE 'cancelado' END AS estado,
            CAST(CASE WHEN o_orderkey % 107 = 0 THEN -1 ELSE o_totalprice END AS {_MONEY}) AS total,
            o_orderkey % 199 <> 0 AND o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0 AND o_orderkey % 107 <> 0 AS bueno
        FROM orders""",
    "pedidos_ok": "SELECT id AS pedido_id, cliente_id, fecha, estado, total FROM pedidos WHERE bueno",
    "lineas": f"""
        SELECT pedido_id, variante_id, cantidad, precio, cantidad * precio AS subtotal FROM (
            SELECT *, row_number() OVER (PARTITION BY pedido_id, variante_id
                ORDER BY l_shipdate DESC, cantidad, precio) AS rn
            FROM (SELECT l_orderkey AS pedido_id, l_partkey AS variante_id, l_shipdate,
                    CAST(CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN 0 ELSE l_quantity END AS INTEGER) AS cantidad,
                    CAST(l_extendedprice AS {_MONEY}) AS precio
                FROM lineitem) s) t
        WHERE rn = 1""",
    "lineas_ok": "SELECT * FROM lineas WHERE cantidad > 0 AND precio > 0",
    "pagos": f"""
        SELECT o_orderkey AS pedido_id, lower(o_orderpriority) AS metodo_pago,
            CASE WHEN o_orderkey % 33 = 0 THEN 'fallido' WHEN o_orderkey % 77 = 0 THEN 'pendiente'
                WHEN o_orderstatus = 'P' THEN 'pendiente' ELSE 'confirmado' END AS estado_pago,
            CAST(o_totalprice AS {_MONEY}) AS monto
        FROM orders""",
    "vista": """
        SELECT l.variante_id, l.pedido_id, p.cliente_id, p.fecha, p.estado, p.total, l.cantidad, l.precio, l.subtotal,
            g.metodo_pago, g.estado_pago, g.monto, v.producto_id, v.talla, v.color, v.sku
        FROM lineas_ok l JOIN pedidos_ok p ON l.pedido_id = p.pedido_id
        LEFT JOIN pagos g ON l.pedido_id = g.pedido_id
        LEFT JOIN variantes_ok v ON l.variante_id = v.variante_id""",
    "devoluciones": """
        SELECT l_orderkey AS pedido_id,
            CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 77 = 0 THEN 'otro'
                WHEN l_orderkey % 5 = 0 THEN 'talla' WHEN l_orderkey % 5 = 1 THEN 'defecto'
                WHEN l_orderkey % 5 = 2 THEN 'color' WHEN l_orderkey % 5 = 3 THEN 'arrepentimiento'
                ELSE 'otro' END AS motivo,
            CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(min(l_shipdate) AS DATE) END AS fecha
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
    "devoluciones_ok": """
        SELECT * FROM devoluciones
        WHERE pedido_id % 97 <> 0 AND pedido_id % 89 <> 0 AND pedido_id IN (SELECT pedido_id FROM pedidos_ok)""",
    "historico": f"""
        SELECT CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS fecha,
            'H-' || l_orderkey AS orden_ref,
            CASE WHEN l_partkey % 113 = 0 THEN '' ELSE 'SKU-' || l_partkey END AS sku,
            CASE WHEN l_suppkey % 71 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS cantidad,
            CAST(l_extendedprice AS {_MONEY}) AS precio_unitario,
            CASE WHEN l_linestatus = 'F' THEN 'web' ELSE 'app' END AS canal,
            'Villa ' || (l_suppkey % 7) AS ciudad,
            l_suppkey % 50 <> 0 AND l_suppkey % 71 <> 0 AND l_partkey % 113 <> 0
                AND l_quantity > 0 AND l_extendedprice > 0 AS bueno
        FROM lineitem""",
    "historico_ok": """
        SELECT fecha, orden_ref, sku, cantidad, precio_unitario, canal, ciudad, cantidad * precio_unitario AS subtotal
        FROM historico WHERE bueno""",
    "devueltas_antes": """
        SELECT CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS fecha,
            CASE WHEN l_partkey % 71 = 0 THEN '' ELSE 'H-' || l_orderkey END AS orden_ref,
            CASE WHEN l_orderkey % 5 = 0 THEN 'talla' WHEN l_orderkey % 5 = 1 THEN 'defecto'
                WHEN l_orderkey % 5 = 2 THEN 'color' WHEN l_orderkey % 5 = 3 THEN 'arrepentimiento'
                ELSE 'otro' END AS motivo,
            l_suppkey % 50 <> 0 AND l_partkey % 71 <> 0 AS bueno
        FROM lineitem WHERE l_returnflag = 'R'""",
    # what was sent: purchases whose id divides by ten twice, two seconds apart
    "enviados": """
        SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS p, ts + to_seconds(late) AS hora
        FROM (SELECT *, unnest(CASE WHEN event_type = 'purchase' AND event_id % 10 = 0 THEN [0, 2] ELSE [0] END) AS late
            FROM events) s""",
    "eventos": """
        SELECT event_id AS num, late, event_id % 401 <> 0 AS legible,
            event_id % 401 <> 0 AND event_id % 211 <> 0 AND event_id % 409 <> 0 AND event_id % 503 <> 0
                AND event_id % 307 <> 0 AS bueno,
            CASE WHEN event_id % 401 = 0 THEN NULL WHEN event_id % 211 = 0 THEN '' ELSE 'e-' || event_id END AS event_id,
            CASE WHEN event_id % 401 = 0 THEN NULL WHEN event_id % 307 = 0 THEN 'otro'
                WHEN event_type = 'view' THEN 'product_viewed' WHEN event_type = 'click' THEN 'added_to_cart'
                WHEN event_type = 'signup' THEN 'checkout_started' WHEN event_type = 'purchase' THEN 'order_placed'
                ELSE 'stock_low' END AS event_type,
            CASE WHEN event_id % 401 = 0 OR event_id % 503 = 0 THEN NULL ELSE hora END AS ts,
            CASE WHEN event_id % 401 = 0 THEN NULL WHEN event_id % 409 = 0 THEN ''
                ELSE user_id || '-' || strftime(ts, '%Y%m%d') END AS session_id,
            CASE WHEN event_id % 10 < 3 THEN NULL ELSE user_id END AS user_id,
            CASE WHEN event_type IN ('view', 'click', 'error') THEN p - p % 4 END AS producto_id,
            CASE WHEN event_type IN ('view', 'click', 'error') THEN p END AS variante_id,
            CASE WHEN event_type IN ('view', 'click', 'error') AND event_id % 83 <> 0 THEN 'SKU-' || p END AS sku,
            CASE WHEN event_type = 'click' AND event_id % 3 <> 0 THEN CAST(1 + event_id % 4 AS INTEGER) END AS cantidad,
            value AS monto, CAST(NULL AS VARCHAR) AS search_query,
            CASE WHEN event_type = 'error' AND event_id % 29 <> 0
                THEN CAST(CAST(floor(value) AS INTEGER) % 9 - 1 AS INTEGER) END AS stock_actual,
            CAST(NULL AS VARCHAR) AS motivo,
            CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'app' END AS canal
        FROM enviados""",
    # rejected for what other rows hold
    "clientes_repetidos": "SELECT * FROM clientes WHERE bueno AND id NOT IN (SELECT id FROM clientes_ok)",
    "inventario_sin_variante": """
        SELECT * FROM inventario
        WHERE stock_disponible >= 0 AND variante_id NOT IN (SELECT variante_id FROM variantes_ok)""",
    "devoluciones_sin_pedido": """
        SELECT * FROM devoluciones
        WHERE pedido_id % 97 <> 0 AND pedido_id % 89 <> 0 AND pedido_id NOT IN (SELECT pedido_id FROM pedidos_ok)""",
    # of two copies the earlier one stays
    "eventos_ok": "SELECT * FROM eventos WHERE bueno AND late = 0",
    # as a stream sees them: every readable line with an id, as it was written
    "vivos": """
        SELECT CASE WHEN num % 211 = 0 THEN '  ' ELSE ' ' || event_id END AS event_id,
            CASE event_type WHEN 'product_viewed' THEN ' Product_Viewed' WHEN 'checkout_started' THEN 'CHECKOUT_STARTED'
                WHEN 'order_placed' THEN 'order_placed ' ELSE event_type END AS event_type,
            ts, CASE WHEN num % 409 = 0 THEN ' ' ELSE session_id END AS session_id, user_id, producto_id,
            variante_id, CASE WHEN sku IS NOT NULL THEN ' ' || lower(sku) END AS sku, cantidad, monto, search_query,
            stock_actual, motivo, CASE WHEN canal = 'web' THEN ' Web' ELSE 'APP' END AS canal
        FROM eventos WHERE legible""",
    "alertas": """
        SELECT ts, sku, producto_id, variante_id, stock_actual, 5 AS umbral,
            CASE WHEN stock_actual <= 0 THEN 'agotado' WHEN stock_actual <= 2 THEN 'critico' ELSE 'bajo' END AS severidad
        FROM vivos WHERE event_type = 'stock_low'""",
    "actividad": """
        SELECT event_type, count(*) AS eventos, count(DISTINCT session_id) AS sesiones, min(ts) AS primero_ts,
            max(ts) AS ultimo_ts
        FROM vivos GROUP BY event_type""",
    "catalogo": f"""
        SELECT CAST(p_partkey AS INTEGER) AS api_id, p_name AS titulo, p_brand AS marca, lower(p_type) AS categoria,
            CAST(CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE p_retailprice END AS {_MONEY}) AS precio,
            CAST(p_partkey % 50 AS DOUBLE) / 4 AS descuento_pct, CAST(p_partkey % 50 AS DOUBLE) / 10 AS rating,
            p_size AS stock, CASE WHEN p_partkey % 59 = 0 THEN '' ELSE 'EXT-' || p_partkey END AS sku,
            CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 'shoes,' || lower(p_type) END AS etiquetas,
            CASE WHEN p_partkey % 2 = 0 THEN 'mens-shoes' ELSE 'womens-shoes' END AS categoria_origen,
            'api:https://example.com' AS _source, '2024-01-02T00:00:00' AS _ingested_at,
            p_partkey % 41 <> 0 AND p_partkey % 59 <> 0 AS bueno
        FROM part""",
    "catalogo_ok": "SELECT * FROM catalogo WHERE bueno",
    "ventas": """
        SELECT fecha, sku, sum(cantidad) AS unidades, sum(subtotal) AS ingresos, fuente FROM (
            SELECT CAST(fecha AS DATE) AS fecha, sku, cantidad, subtotal, 'transaccional' AS fuente FROM vista
            WHERE estado IN ('confirmado', 'enviado', 'entregado') AND estado_pago = 'confirmado'
            UNION ALL SELECT fecha, sku, cantidad, subtotal, 'historico' FROM historico_ok) s
        GROUP BY fecha, sku, fuente""",
    "diarias": """
        SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
            CAST(weekofyear(fecha) AS INTEGER) AS semana, CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana,
            dayofweek(fecha) IN (0, 6) AS es_fin_de_semana, CAST(sum(unidades) AS BIGINT) AS unidades_vendidas,
            sum(ingresos) AS ingresos, count(DISTINCT sku) AS skus_distintos
        FROM ventas GROUP BY fecha""",
    "top": """
        SELECT sku, producto_id, coalesce(nombre, sku) AS nombre, coalesce(marca, '—') AS marca,
            coalesce(categoria, '—') AS categoria, CAST(unidades AS BIGINT) AS unidades, ingresos,
            CAST(rank() OVER (ORDER BY ingresos DESC) AS INTEGER) AS ranking_global,
            CAST(rank() OVER (PARTITION BY categoria ORDER BY ingresos DESC) AS INTEGER) AS ranking_categoria
        FROM (SELECT s.sku, v.producto_id, p.nombre, p.marca, p.categoria, s.unidades, s.ingresos
            FROM (SELECT sku, sum(unidades) AS unidades, sum(ingresos) AS ingresos FROM ventas
                WHERE sku IS NOT NULL AND sku <> '' GROUP BY sku) s
            LEFT JOIN variantes_ok v ON s.sku = v.sku LEFT JOIN productos_ok p ON v.producto_id = p.id) t""",
    "atributos": """
        SELECT valor, tipo, CAST(unidades AS BIGINT) AS unidades, ingresos,
            CAST(rank() OVER (PARTITION BY tipo ORDER BY unidades DESC) AS INTEGER) AS ranking
        FROM (SELECT v.talla AS valor, 'talla' AS tipo, sum(unidades) AS unidades, sum(ingresos) AS ingresos
            FROM ventas s JOIN variantes_ok v ON s.sku = v.sku GROUP BY v.talla
            UNION ALL SELECT v.color, 'color', sum(unidades), sum(ingresos)
            FROM ventas s JOIN variantes_ok v ON s.sku = v.sku GROUP BY v.color) t""",
    "embudo": """
        SELECT e.orden, e.etapa, e.etapa_nombre, coalesce(c.sesiones, 0) AS sesiones, coalesce(c.eventos, 0) AS eventos,
            CASE WHEN coalesce(c.sesiones, 0) = 0 THEN 0.0::DOUBLE ELSE CAST(c.sesiones AS DOUBLE) / (
                SELECT count(DISTINCT session_id) FROM eventos_ok WHERE event_type = 'product_viewed') END AS tasa_sobre_vistas
        FROM (VALUES (1, 'product_viewed', 'Vistas de producto'), (2, 'added_to_cart', 'Añadidos al carrito'),
            (3, 'checkout_started', 'Checkouts iniciados'), (4, 'order_placed', 'Compras finalizadas'))
            AS e(orden, etapa, etapa_nombre)
        LEFT JOIN (SELECT event_type, count(DISTINCT session_id) AS sesiones, count(*) AS eventos
            FROM eventos_ok GROUP BY event_type) c ON e.etapa = c.event_type""",
    "abandonados": """
        SELECT a.sku, a.producto_id, p.nombre, p.marca, p.categoria, v.talla, v.color, a.carritos_abandonados,
            a.unidades_estimadas, a.ultima_actividad
        FROM (SELECT sku, max(producto_id) AS producto_id, count(DISTINCT session_id) AS carritos_abandonados,
                CAST(sum(coalesce(cantidad, 1)) AS BIGINT) AS unidades_estimadas, max(ts) AS ultima_actividad
            FROM eventos_ok WHERE event_type = 'added_to_cart' AND session_id NOT IN (
                SELECT session_id FROM eventos_ok WHERE event_type = 'order_placed')
            GROUP BY sku) a
        LEFT JOIN variantes_ok v ON a.sku = v.sku LEFT JOIN productos_ok p ON a.producto_id = p.id""",
    "critico": """
        SELECT i.variante_id, v.sku, p.nombre, p.marca, p.categoria, v.talla, v.color, i.stock_disponible, i.bodega,
            i.stock_disponible * p.precio AS valor_riesgo
        FROM inventario_ok i JOIN variantes_ok v ON i.variante_id = v.variante_id
        LEFT JOIN productos_ok p ON v.producto_id = p.id
        WHERE i.stock_disponible <= 5""",
    "motivos": """
        SELECT v.producto_id, d.motivo, count(DISTINCT d.pedido_id) AS veces
        FROM devoluciones_ok d JOIN vista v ON d.pedido_id = v.pedido_id GROUP BY v.producto_id, d.motivo""",
    "tasas": """
        SELECT t.producto_id, coalesce(p.nombre, '—') AS nombre, coalesce(p.marca, '—') AS marca,
            coalesce(p.categoria, '—') AS categoria, s.pedidos_con_producto, s.unidades_vendidas, t.devoluciones,
            CASE WHEN s.unidades_vendidas > 0 THEN CAST(t.devoluciones AS DOUBLE) / s.unidades_vendidas END AS tasa_devolucion,
            t.motivo AS motivo_mas_frecuente
        FROM (SELECT producto_id, motivo, CAST(total AS BIGINT) AS devoluciones FROM (
                SELECT *, sum(veces) OVER (PARTITION BY producto_id) AS total,
                    row_number() OVER (PARTITION BY producto_id ORDER BY veces DESC, motivo) AS rn
                FROM motivos) m WHERE rn = 1) t
        LEFT JOIN (SELECT producto_id, count(DISTINCT pedido_id) AS pedidos_con_producto,
                CAST(sum(cantidad) AS BIGINT) AS unidades_vendidas
            FROM vista WHERE estado IN ('confirmado', 'enviado', 'entregado') GROUP BY producto_id) s
            ON t.producto_id = s.producto_id
        LEFT JOIN productos_ok p ON t.producto_id = p.id""",
    "valor": """
        SELECT g.cliente_id, c.nombre, c.correo, c.ciudad, g.pedidos, g.gasto_total,
            CAST(g.gasto_total AS DOUBLE) / g.pedidos AS ticket_promedio, g.primera_compra, g.ultima_compra,
            CASE WHEN g.pedidos >= 5 THEN 'frecuente' WHEN g.pedidos >= 2 THEN 'recurrente' ELSE 'ocasional' END AS segmento,
            CAST(row_number() OVER (ORDER BY g.gasto_total DESC, g.cliente_id) AS INTEGER) AS ranking
        FROM (SELECT cliente_id, count(DISTINCT pedido_id) AS pedidos, sum(subtotal) AS gasto_total,
                min(fecha) AS primera_compra, max(fecha) AS ultima_compra
            FROM vista WHERE estado IN ('confirmado', 'enviado', 'entregado') AND estado_pago = 'confirmado'
            GROUP BY cliente_id) g
        LEFT JOIN clientes_ok c ON g.cliente_id = c.id""",
    # half-up rounding on whole cents
    "referencia": """
        SELECT categoria_origen, categoria, marca, count(*) AS productos,
            CAST((2 * CAST(sum(precio) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS precio_medio,
            CAST(min(precio) AS DOUBLE) AS precio_min, CAST(max(precio) AS DOUBLE) AS precio_max,
            CAST((20 * CAST(sum(api_id % 50) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS rating_medio,
            CAST(sum(stock) AS BIGINT) AS stock_total
        FROM catalogo_ok GROUP BY categoria_origen, categoria, marca""",
    "corridas": """
        SELECT o_orderdate AS inicio, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS hechos,
            count(*) FILTER (o_orderstatus = 'O') AS abiertos
        FROM orders GROUP BY o_orderdate""",
}

# Which parts a part is built from.
_USES = {
    name: [other for other in PARTS if other != name and f" {other} " in f" {sql} ".replace("\n", " ").replace(")", " ")]
    for name, sql in PARTS.items()
}


def _needed(sql: str) -> list[str]:
    """Parts a statement uses, each after the parts it uses itself."""
    words = f" {sql} ".replace("\n", " ").replace(")", " ").replace(",", " ")
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in _USES[name]:
                add(other)
            order.append(name)

    for name in PARTS:
        if f" {name} " in words:
            add(name)
    return order


def statement(sql: str) -> str:
    """``sql`` with the definitions of all parts it uses in front."""
    parts = ", ".join(f"{name} AS ({PARTS[name]})" for name in _needed(sql))
    return f"WITH {parts} {sql}" if parts else sql


_EVENT_COLUMNS = (
    "event_id, event_type, ts, session_id, user_id, producto_id, variante_id, sku, cantidad, monto, search_query, "
    "stock_actual, motivo, canal"
)


def _doubles(*columns: str) -> str:
    return ", ".join(f"CAST({column} AS DOUBLE) AS {column}" for column in columns)


_STATEMENTS = {
    # cleansing
    "clean_size": """
        SELECT id, dia, CASE WHEN NOT talla_buena THEN NULL WHEN id % 6 = 4 THEN numero || '.5' ELSE numero END AS talla
        FROM variantes JOIN dias ON dia = 1 OR id % 11 <> 0""",
    "clean_date": "SELECT orden_ref, fecha FROM historico",
    "clean_price": "SELECT orden_ref, CAST(precio_unitario AS DOUBLE) AS precio FROM historico",
    "clean_email": """
        SELECT id, dia, correo, coalesce(bueno, FALSE) AS valido
        FROM clientes JOIN dias ON dia = 1 OR id % 11 <> 0""",
    "clean_text": """
        SELECT id, dia, nombre, CASE WHEN id % 31 = 0 THEN NULL WHEN dia = 1 AND id % 7 = 0 THEN 'Antigua Ciudad'
            ELSE 'Nation_' || c_nationkey END AS ciudad
        FROM clientes JOIN customer ON id = c_custkey JOIN dias ON dia = 1 OR id % 11 <> 0""",
    "calendar_attributes": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, CAST(year(o_orderdate) AS INTEGER) AS anio,
            CAST(month(o_orderdate) AS INTEGER) AS mes, CAST(weekofyear(o_orderdate) AS INTEGER) AS semana,
            CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dia_semana, dayofweek(o_orderdate) IN (0, 6) AS es_fin_de_semana
        FROM orders""",
    # general operators
    "dedupe_latest_snapshot": """
        SELECT id, cliente_id, fecha, estado, CAST(total AS DOUBLE) AS total,
            CASE WHEN id % 11 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS _ingest_date
        FROM pedidos""",
    "dedupe_earliest_event": """
        SELECT user_id, event_type, ts, event_id, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) t
        WHERE rn = 1""",
    "rejects_summary": """
        SELECT tabla, motivo_rechazo, count(*) AS filas FROM (
            SELECT 'clientes' AS tabla, 'correo_inválido' AS motivo_rechazo FROM clientes WHERE NOT bueno
            UNION ALL SELECT 'productos', 'precio_o_categoria_invalido' FROM productos WHERE NOT bueno
            UNION ALL SELECT 'variantes', 'talla_invalida' FROM variantes WHERE NOT bueno
            UNION ALL SELECT 'inventario', 'stock_invalido' FROM inventario WHERE coalesce(stock_disponible, -1) < 0
            UNION ALL SELECT 'pedidos', 'estado_fecha_total_invalido' FROM pedidos WHERE NOT bueno
            UNION ALL SELECT 'detalle_pedido', 'cantidad_precio_invalido' FROM lineas WHERE cantidad <= 0 OR precio <= 0
            UNION ALL SELECT 'devoluciones', 'motivo_o_fecha_invalido' FROM devoluciones
                WHERE pedido_id % 97 = 0 OR pedido_id % 89 = 0
            UNION ALL SELECT 'historico_ventas', 'fecha_cantidad_precio_invalido' FROM historico WHERE NOT bueno
            UNION ALL SELECT 'historico_devoluciones', 'fecha_o_referencia_invalida' FROM devueltas_antes WHERE NOT bueno
            UNION ALL SELECT 'eventos', 'evento_invalido' FROM eventos WHERE NOT bueno
            UNION ALL SELECT 'clientes', 'correo_repetido' FROM clientes_repetidos
            UNION ALL SELECT 'inventario', 'variante_desconocida' FROM inventario_sin_variante
            UNION ALL SELECT 'devoluciones', 'pedido_desconocido' FROM devoluciones_sin_pedido
            UNION ALL SELECT 'eventos', 'evento_repetido' FROM eventos WHERE bueno AND late <> 0
            UNION ALL SELECT 'catalogo_externo', 'catalogo_api_invalido' FROM catalogo WHERE NOT bueno) r
        GROUP BY tabla, motivo_rechazo""",
    # Bronze
    "bronze_snapshot": """
        SELECT id, cliente_id, fecha,
            CASE WHEN id % 101 = 0 THEN 'perdido' WHEN id % 103 = 0 THEN NULL
                WHEN dia = 1 AND id % 7 = 0 THEN 'pendiente' WHEN o_orderstatus = 'F' THEN ' Entregado'
                WHEN o_orderstatus = 'O' THEN 'CONFIRMADO ' WHEN id % 3 = 0 THEN 'pendiente'
                WHEN id % 3 = 1 THEN ' enviado' ELSE 'Cancelado' END AS estado,
            CAST(total AS DOUBLE) AS total, 'postgresql:pedidos' AS _source, DATE '2023-12-31' + dia AS _ingest_date
        FROM pedidos JOIN orders ON id = o_orderkey JOIN dias ON dia = 1 OR id % 11 <> 0""",
    "bronze_manifest": " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS archivo, count(*) AS registros FROM {name}"
        for name in ("customer", "part", "orders", "lineitem", "events")
    ),
    "src_csv_history": """
        SELECT CASE WHEN l_suppkey % 50 = 0 THEN 'sin fecha' WHEN l_linenumber % 4 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
                WHEN l_linenumber % 4 = 1 THEN strftime(l_shipdate, '%d/%m/%Y')
                WHEN l_linenumber % 4 = 2 THEN strftime(l_shipdate, '%d-%m-%Y')
                ELSE strftime(l_shipdate, '%d.%m.%Y') END AS fecha,
            'H-' || l_orderkey AS orden_ref,
            CASE WHEN l_partkey % 113 = 0 THEN ' ' ELSE ' sku-' || l_partkey END AS sku,
            CASE WHEN l_suppkey % 71 = 0 THEN 'muchas' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS cantidad,
            l_extendedprice AS precio_unitario,
            CASE WHEN l_linestatus = 'F' THEN ' Web' ELSE 'APP' END AS canal, ' VILLA ' || (l_suppkey % 7) AS ciudad
        FROM lineitem""",
    "bronze_landing": """
        SELECT CASE WHEN l_orderkey % 5 = 1 THEN 3 ELSE 1 END AS corrida, count(*) AS registros, count(*) AS en_bronze
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "sql_cleaning": """
        SELECT orden_ref, fecha, sku, cantidad, CAST(precio_unitario AS DOUBLE) AS precio, canal FROM historico""",
    # rejects
    "rejects_customers": """
        SELECT id, nombre, correo, ciudad, fecha_registro, 'correo_inválido' AS motivo_rechazo
        FROM clientes WHERE NOT bueno
        UNION ALL SELECT id, nombre, correo, ciudad, fecha_registro, 'correo_repetido' FROM clientes_repetidos""",
    "rejects_products": """
        SELECT id, nombre, marca, categoria, CAST(precio AS DOUBLE) AS precio,
            'precio_o_categoria_invalido' AS motivo_rechazo
        FROM productos WHERE NOT bueno""",
    "rejects_variants": """
        SELECT id, producto_id,
            CASE WHEN id % 37 = 0 THEN 'XL' WHEN id % 43 = 0 THEN '1' || numero WHEN id % 6 = 0 THEN numero
                WHEN id % 6 = 1 THEN 'EU ' || numero WHEN id % 6 = 2 THEN ' T' || numero || ' '
                WHEN id % 6 = 3 THEN 'talla ' || numero WHEN id % 6 = 4 THEN numero || ',5'
                ELSE 'esp.' || numero END AS talla,
            color, sku, 'talla_invalida' AS motivo_rechazo
        FROM variantes WHERE NOT bueno""",
    "rejects_inventory": """
        SELECT *, 'stock_invalido' AS motivo_rechazo FROM inventario WHERE coalesce(stock_disponible, -1) < 0
        UNION ALL SELECT *, 'variante_desconocida' FROM inventario_sin_variante""",
    "rejects_orders": """
        SELECT id, cliente_id, fecha, estado, CAST(total AS DOUBLE) AS total,
            'estado_fecha_total_invalido' AS motivo_rechazo
        FROM pedidos WHERE NOT bueno""",
    "rejects_order_lines": """
        SELECT pedido_id, variante_id, cantidad, CAST(precio AS DOUBLE) AS precio,
            'cantidad_precio_invalido' AS motivo_rechazo
        FROM lineas WHERE cantidad <= 0 OR precio <= 0""",
    "rejects_returns": """
        SELECT pedido_id, motivo, fecha, 'motivo_o_fecha_invalido' AS motivo_rechazo
        FROM devoluciones WHERE pedido_id % 97 = 0 OR pedido_id % 89 = 0
        UNION ALL SELECT pedido_id, motivo, fecha, 'pedido_desconocido' FROM devoluciones_sin_pedido""",
    "rejects_sales_history": """
        SELECT fecha, orden_ref, sku, cantidad, CAST(precio_unitario AS DOUBLE) AS precio_unitario,
            'fecha_cantidad_precio_invalido' AS motivo_rechazo
        FROM historico WHERE NOT bueno""",
    "rejects_returns_history": """
        SELECT fecha, orden_ref, motivo, 'fecha_o_referencia_invalida' AS motivo_rechazo
        FROM devueltas_antes WHERE NOT bueno""",
    "rejects_events": """
        SELECT event_id, event_type, ts, session_id, 'evento_invalido' AS motivo_rechazo FROM eventos WHERE NOT bueno
        UNION ALL SELECT event_id, event_type, ts, session_id, 'evento_repetido' FROM eventos WHERE bueno AND late <> 0""",
    "rejects_external_catalog": """
        SELECT api_id, titulo, marca, CAST(precio AS DOUBLE) AS precio, sku, 'catalogo_api_invalido' AS motivo_rechazo
        FROM catalogo WHERE NOT bueno""",
    # Silver
    "silver_customers": "SELECT * FROM clientes_ok",
    "silver_products": f"SELECT id, nombre, marca, categoria, {_doubles('precio')} FROM productos_ok",
    "silver_variants": "SELECT * FROM variantes_ok",
    "silver_inventory": "SELECT * FROM inventario_ok",
    "silver_orders": f"SELECT pedido_id, cliente_id, fecha, estado, {_doubles('total')} FROM pedidos_ok",
    "silver_orders_by_day": f"SELECT pedido_id, cliente_id, fecha, estado, {_doubles('total')} FROM pedidos_ok",
    # the second day is complete: what it lacks was deleted
    "silver_orders_deleted": f"""
        SELECT pedido_id, cliente_id, fecha, estado, {_doubles('total')} FROM pedidos_ok WHERE pedido_id % 11 <> 0""",
    "silver_order_lines": f"SELECT pedido_id, variante_id, cantidad, {_doubles('precio', 'subtotal')} FROM lineas_ok",
    "silver_order_view": f"""
        SELECT variante_id, pedido_id, cliente_id, fecha, estado, cantidad, metodo_pago, estado_pago, producto_id, talla,
            color, sku, {_doubles('total', 'precio', 'subtotal', 'monto')}
        FROM vista""",
    "silver_returns": "SELECT pedido_id, motivo, fecha FROM devoluciones_ok",
    "silver_sales_history": f"""
        SELECT fecha, orden_ref, sku, cantidad, canal, ciudad, {_doubles('precio_unitario', 'subtotal')}
        FROM historico_ok""",
    "silver_returns_history": "SELECT fecha, orden_ref, motivo FROM devueltas_antes WHERE bueno",
    "silver_suppliers": """
        SELECT 'P-' || s_suppkey AS proveedor_id, s_name AS nombre, 'ventas@' || s_suppkey || '.example.com' AS contacto,
            CASE WHEN s_suppkey % 17 = 0 THEN '' WHEN s_suppkey % 3 = 0 THEN 'formal'
                WHEN s_suppkey % 3 = 1 THEN 'formal,deportivo' ELSE 'formal,deportivo,sandalia' END AS categorias,
            n_name AS pais, CAST(s_suppkey % 30 AS INTEGER) AS plazo_entrega_dias
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "silver_events": f"SELECT {_EVENT_COLUMNS} FROM eventos_ok",
    "silver_external_catalog": f"""
        SELECT api_id, titulo, marca, categoria, {_doubles('precio')}, descuento_pct, rating, stock, sku, etiquetas,
            categoria_origen, _source, _ingested_at
        FROM catalogo_ok""",
    # Gold
    "gold_unified_sales": f"""
        SELECT fecha, sku, CAST(unidades AS BIGINT) AS unidades, {_doubles('ingresos')}, fuente FROM ventas""",
    "gold_daily_sales": f"SELECT * REPLACE ({_doubles('ingresos')}) FROM diarias",
    "gold_top_products": f"SELECT * REPLACE ({_doubles('ingresos')}) FROM top",
    "gold_sales_by_attribute": f"SELECT * REPLACE ({_doubles('ingresos')}) FROM atributos",
    "gold_conversion_funnel": "SELECT * FROM embudo",
    "gold_abandoned_carts": "SELECT * FROM abandonados",
    "gold_critical_stock": f"SELECT * REPLACE ({_doubles('valor_riesgo')}) FROM critico",
    "gold_return_rate": "SELECT * FROM tasas",
    "gold_customer_value": f"SELECT * REPLACE ({_doubles('gasto_total')}) FROM valor",
    "gold_external_catalog_benchmark": "SELECT * FROM referencia",
    # streaming
    "stream_parse_events": f"SELECT {_EVENT_COLUMNS} FROM vivos",
    "stream_bronze_copy": f"SELECT {_EVENT_COLUMNS} FROM vivos",
    "stream_activity": "SELECT * FROM actividad",
    "stream_sessions_sketch": "SELECT DISTINCT event_type, true AS cerca FROM vivos",
    "stream_activity_windowed": """
        SELECT date_trunc('hour', ts) AS desde, event_type, count(*) AS eventos, CAST(sum(cantidad) AS BIGINT) AS unidades,
            min(ts) AS primero_ts, max(ts) AS ultimo_ts
        FROM eventos WHERE legible AND num % 211 <> 0 AND ts IS NOT NULL AND late = 0
        GROUP BY 1, 2""",
    "stream_stock_alerts": "SELECT * FROM alertas",
    # reports
    "report_kpis": """
        SELECT CAST(sum(ingresos) AS DOUBLE) AS ingresos, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades_vendidas,
            count(*) AS dias_con_ventas,
            (SELECT nombre FROM top ORDER BY top.ingresos DESC, sku LIMIT 1) AS producto_estrella,
            (SELECT count(*) FROM critico ) AS stock_critico
        FROM diarias""",
    "report_range_summary": """
        SELECT CAST(sum(ingresos) AS DOUBLE) AS ingresos, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades_vendidas,
            CAST(sum(ingresos) AS DOUBLE) / count(*) AS ticket_medio_dia
        FROM diarias WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "report_monthly_sales": """
        SELECT strftime(fecha, '%Y-%m') AS mes, CAST(sum(ingresos) AS DOUBLE) AS ingresos,
            CAST(sum(unidades_vendidas) AS BIGINT) AS unidades_vendidas
        FROM diarias GROUP BY strftime(fecha, '%Y-%m')""",
    "report_funnel_pct": """
        SELECT orden, etapa_nombre, sesiones, eventos, round(tasa_sobre_vistas * 100, 1) AS pct_sobre_vistas FROM embudo""",
    "report_top_products": """
        SELECT nombre, marca, categoria, unidades, CAST(ingresos AS DOUBLE) AS ingresos
        FROM (SELECT * FROM top ORDER BY ingresos DESC, sku LIMIT 15) t""",
    "report_income_by_category": """
        SELECT categoria, CAST(sum(ingresos) AS DOUBLE) AS ingresos FROM top GROUP BY categoria""",
    "report_demand_by_size": """
        SELECT valor, unidades, CAST(ingresos AS DOUBLE) AS ingresos, ranking FROM atributos WHERE tipo = 'talla'""",
    "report_demand_by_color": """
        SELECT valor, unidades, CAST(ingresos AS DOUBLE) AS ingresos, ranking FROM atributos WHERE tipo = 'color'""",
    "report_top_products_filtered": """
        SELECT nombre, marca, categoria, unidades, CAST(ingresos AS DOUBLE) AS ingresos
        FROM top WHERE categoria IN ('economy', 'medium')""",
    "report_critical_stock": f"SELECT * REPLACE ({_doubles('valor_riesgo')}) FROM critico",
    "report_return_pct": """
        SELECT producto_id, nombre, unidades_vendidas, devoluciones,
            round(coalesce(tasa_devolucion, 0) * 100, 1) AS pct_devolucion,
            CASE WHEN pedidos_con_producto > 0 THEN CAST(devoluciones AS DOUBLE) / pedidos_con_producto END AS tasa_por_pedido,
            motivo_mas_frecuente
        FROM tasas""",
    "report_segment_kpis": """
        SELECT count(*) AS clientes, CAST(sum(gasto_total) AS DOUBLE) AS gasto_total,
            CAST(sum(gasto_total) AS DOUBLE) / greatest(sum(pedidos), 1) AS ticket_medio
        FROM valor WHERE segmento IN ('frecuente', 'recurrente')""",
    "report_spend_by_segment": """
        SELECT segmento, CAST(sum(gasto_total) AS DOUBLE) AS gasto_total FROM valor GROUP BY segmento""",
    "report_top_customers": """
        SELECT cliente_id, nombre, ciudad, pedidos, CAST(gasto_total AS DOUBLE) AS gasto_total, ticket_promedio, segmento
        FROM valor WHERE ranking <= 15""",
    "report_abandoned_top": """
        SELECT * FROM abandonados ORDER BY carritos_abandonados DESC, sku ASC NULLS LAST LIMIT 15""",
    "report_stream_kpis": """
        SELECT CAST(sum(eventos) AS BIGINT) AS eventos, (SELECT count(*) FROM alertas ) AS alertas,
            (SELECT count(*) FROM alertas WHERE severidad = 'agotado') AS agotados
        FROM actividad""",
    "report_latest_alerts": """
        SELECT ts, sku, stock_actual, umbral, severidad FROM alertas
        ORDER BY ts DESC NULLS LAST, sku ASC NULLS LAST, stock_actual ASC NULLS FIRST LIMIT 20""",
    "report_activity": "SELECT * FROM actividad",
    "report_external_benchmark": "SELECT * FROM referencia",
    "report_external_kpis": """
        SELECT CAST(sum(productos) AS BIGINT) AS productos,
            CAST(sum(CAST(precio_medio AS DECIMAL(18, 2)) * productos) AS DOUBLE) / sum(productos) AS precio_medio,
            count(DISTINCT marca) AS marcas
        FROM referencia""",
    "report_external_price_by_brand": """
        SELECT marca, CAST(sum(productos) AS BIGINT) AS productos,
            CAST(sum(CAST(precio_medio AS DECIMAL(18, 2)) * productos) AS DOUBLE) / sum(productos) AS precio_medio
        FROM referencia GROUP BY marca""",
    "report_run_history": """
        SELECT inicio, inicio + to_seconds(n) AS fin, CAST(n AS DOUBLE) AS duracion_s,
            CASE WHEN hechos = 0 THEN 'error' ELSE 'ok' END AS estado, n AS filas_bronze,
            hechos + abiertos AS filas_silver, CASE WHEN hechos = 0 THEN NULL ELSE hechos END AS filas_gold,
            CASE WHEN hechos = 0 THEN 'RuntimeError: nothing delivered' END AS error,
            (SELECT count(*) FROM (SELECT * FROM corridas ORDER BY inicio DESC LIMIT 50) u WHERE hechos = 0) AS errores
        FROM corridas ORDER BY inicio DESC LIMIT 8""",
}


def oracle_sql() -> dict[str, str]:
    # read from files of their own, the rows are those of the tables
    same = {"src_supplier_arrays": "silver_suppliers", "src_event_files": "silver_events"}
    return {name: statement(sql) for name, sql in (_STATEMENTS | {name: _STATEMENTS[of] for name, of in same.items()}).items()}
