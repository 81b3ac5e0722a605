"""The whole pipeline on stored tables: raw tables -> silver -> gold -> rule report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.operators import features, gold, rules
from shopmart.operators.silver import Silver, denormalized_orders
from shopmart.sources.bronze import Bronze
from shopmart.sources.storage import create_layers, materialize

GOLD: dict[str, Callable[[Silver], DataFrame]] = {
    "sales_kpi": gold.sales_kpi,
    "customer_ltv": gold.customer_ltv,
    "seller_performance": gold.seller_performance,
    "payment_behavior": gold.payment_behavior,
    "cohort_retention_all": gold.cohort_retention_all,
    "cohort_retention_product": gold.cohort_retention_product,
    "order_summary": gold.order_summary,
    "ltv_features": features.ltv_features,
    "churn_features": features.churn_features_customer,
}
# Published with the time of their load, like silver.
STAMPED = frozenset(
    {"sales_kpi", "seller_performance", "payment_behavior", "cohort_retention_all", "cohort_retention_product"}
)


def build(
    spark: SparkSession,
    bronze: Bronze,
    as_views: frozenset[str] = frozenset(),
    buckets: int = 0,
    reports: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Stores silver and every gold table and returns the stored tables.

    Gold reads the stored silver table. With `buckets` it is bucketed by
    order, which makes all per-order work in gold free of shuffles; a bucket
    is one task, so leave it out where one order fills a large part of the
    data. Names in `as_views` become views. With `reports` the rules of every
    stored gold table are counted while it is written, and put there by name.
    """
    create_layers(spark)
    table = materialize(
        denormalized_orders(bronze), "silver.denormalized_orders", bucket_by="order_id", buckets=buckets
    )
    silver = Silver.from_table(table)
    stored = {"denormalized_orders": silver.orders}
    for name, define in GOLD.items():
        result = define(silver)
        if name in STAMPED:
            result = result.withColumn("_ingest_ts", F.current_timestamp())
        if reports is not None and name in rules.RULES and name not in as_views:
            stored[name], reports[name] = rules.store_checked(result, name, lambda df, name=name: materialize(df, f"gold.{name}"))
        else:
            stored[name] = materialize(result, f"gold.{name}", as_view=name in as_views)
    metrics = gold.customer_metrics(stored["order_summary"])
    stored["customer_metrics"] = materialize(metrics, "gold.customer_metrics")
    return stored


def quality_report(stored: dict[str, DataFrame]) -> DataFrame:
    """All declared rules on the stored tables."""
    return rules.report({name: stored[name] for name in rules.RULES})
