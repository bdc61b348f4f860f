"""Business values of the shop. Everything that a caller may want to change is a field of ``ShopRules``."""

from __future__ import annotations

from dataclasses import dataclass

# Money is exact: NUMERIC(12,2) sources and text prices with up to four decimals both fit.
MONEY = "decimal(18,4)"


# State names, event names, reason texts and labels are part of the output contract.
@dataclass(frozen=True)
class ShopRules:
    stock_threshold: int = 5
    email_pattern: str = r"^[^@\s]+@[^@\s]+\.[a-zA-Z]{2,}$"
    categories: tuple[str, ...] = ("deportivo", "formal", "sandalia")
    order_states: tuple[str, ...] = ("pendiente", "confirmado", "enviado", "entregado", "cancelado")
    sale_states: tuple[str, ...] = ("confirmado", "enviado", "entregado")
    paid_state: str = "confirmado"
    event_types: tuple[str, ...] = (
        "product_viewed",
        "search_performed",
        "added_to_cart",
        "checkout_started",
        "order_placed",
        "payment_confirmed",
        "payment_failed",
        "stock_low",
    )
    cart_event: str = "added_to_cart"
    purchase_event: str = "order_placed"
    alert_event: str = "stock_low"
    # (event type, label shown in reports), in the order of the customer journey
    funnel: tuple[tuple[str, str], ...] = (
        ("product_viewed", "Vistas de producto"),
        ("added_to_cart", "Añadidos al carrito"),
        ("checkout_started", "Checkouts iniciados"),
        ("order_placed", "Compras finalizadas"),
    )
    # (lowest number of orders, segment), highest first
    segments: tuple[tuple[int, str], ...] = ((5, "frecuente"), (2, "recurrente"), (0, "ocasional"))
    missing_label: str = "—"
    # zone in which event times without an offset are meant
    naive_zone: str = "UTC"

    @property
    def critical_stock(self) -> int:
        return max(self.stock_threshold // 2, 1)


DEFAULT_RULES = ShopRules()
