"""Declared schemas of the raw inputs. Nothing is inferred, so a missing field is NULL and never an error."""

from __future__ import annotations

import re

# Field names of the raw feeds.
SALES_HISTORY = (
    "fecha STRING, orden_ref STRING, sku STRING, cantidad STRING, precio_unitario STRING, canal STRING, ciudad STRING"
)

RETURNS_HISTORY = "fecha STRING, orden_ref STRING, motivo STRING"

SUPPLIERS = (
    "proveedor_id STRING, nombre STRING, contacto STRING, categorias ARRAY<STRING>, pais STRING, "
    "plazo_entrega_dias STRING"
)

EVENT = (
    "event_id STRING, event_type STRING, ts STRING, session_id STRING, user_id BIGINT, producto_id BIGINT, "
    "variante_id BIGINT, sku STRING, cantidad INT, monto DOUBLE, search_query STRING, stock_actual INT, "
    "motivo STRING, canal STRING"
)

# Numbers arrive as JSON numbers or as text depending on the provider: read as text, cast afterwards.
CATALOG = (
    "id STRING, title STRING, brand STRING, category STRING, price STRING, discountPercentage STRING, rating STRING, "
    "stock STRING, sku STRING, tags ARRAY<STRING>, description STRING, availabilityStatus STRING, thumbnail STRING, "
    "_categoria_api STRING, _source STRING, _endpoint STRING, _ingested_at STRING, _ingest_date STRING"
)

# What the stream writes; either table may not exist yet.
ACTIVITY = (
    "event_type STRING, eventos BIGINT, sesiones BIGINT, primero_ts TIMESTAMP, ultimo_ts TIMESTAMP, "
    "procesado_en TIMESTAMP, corrida STRING, lote BIGINT"
)

ALERTS = (
    "ts TIMESTAMP, sku STRING, producto_id BIGINT, variante_id BIGINT, stock_actual INT, umbral INT, severidad STRING, "
    "procesado_en TIMESTAMP, corrida STRING, lote BIGINT"
)

RUN_LOG = (
    "inicio TIMESTAMP_NTZ, fin TIMESTAMP_NTZ, duracion_s DOUBLE, estado STRING, bronze MAP<STRING, BIGINT>, "
    "silver MAP<STRING, BIGINT>, gold MAP<STRING, BIGINT>, error STRING"
)


def field_names(ddl: str) -> list[str]:
    """Column names of a flat schema, in order (commas inside ``<>`` belong to a type)."""
    return [field.split()[0] for field in re.split(r",(?![^<]*>)", ddl)]
