"""Gold from the nested table, from orders and products that are stored twice, from amounts of three places: the same SQL."""

from __future__ import annotations

import oracles.quality
import oracles.star  # noqa: F401 - its parts are used here
from oracles import features, gold, silver
from oracles.compose import query
from shopmart.sources.sample_mapping import MAPPING

DIRTY = {"b_orders": "orders_dirty", "products": "products_dirty"}
SOURCES = {
    "gold_sales_kpi": "kpi",
    "gold_customer_ltv": "ltv",
    "gold_seller_performance": "seller_perf",
    "gold_payment_behavior": "pay_behavior",
    "gold_ltv_features": "ltv_features",
}

ORACLES: dict[str, str] = {f"{name}_nested": sql for name, sql in gold.ORACLES.items()}
ORACLES["dq_gold_report_nested"] = oracles.quality.ORACLES["dq_gold_report"]
ORACLES["gold_ltv_features_nested"] = features.ORACLES["gold_ltv_features"]
for _name, _part in SOURCES.items():
    for _form in ("dirty", "dirty_nested"):
        ORACLES[f"{_name}_{_form}"] = query(f"select * from {{{_part}}}", swap=DIRTY)

THIRDS = {"order_items": "items_thirds", "order_payments": "payments_thirds"}
THIRDS_SQL = {
    "silver_items_agg": silver.ITEMS_AGG,
    "silver_payments_agg": silver.PAYMENTS_AGG,
    "silver_denormalized_orders": silver.DENORMALIZED,
    "star_seller_performance": "select * from {star_sellers}",
    **{name: f"select * from {{{_part}}}" for name, _part in SOURCES.items()},
}
for _name, _sql in THIRDS_SQL.items():
    # The raw tables themselves are derived from the plain amounts.
    _text = query(_sql, swap=THIRDS, keep=frozenset(MAPPING))
    ORACLES[f"{_name}_thirds"] = _text
    if _name in SOURCES:
        ORACLES[f"{_name}_thirds_nested"] = _text
