"""The gold tables computed from the raw tables by joins.

Twins of the tables in `gold`, for comparing both layouts. They differ from
them on purpose in places: customers are joined inner, an order without items
has no cost instead of zero, sellers are credited with their own items only,
and in the payment table an order's cost is multiplied by its payments and its
payments by its items before they are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import EXACT, early_days, on_time
from shopmart.operators import gold
from shopmart.operators.silver import (
    MATCH_TOLERANCE,
    item_totals,
    latest_review,
    order_customers,
    payment_match,
    payment_totals,
    with_product,
)
from shopmart.sources.bronze import Bronze


def _scores(bronze: Bronze) -> DataFrame:
    return latest_review(bronze.order_reviews).select("order_id", "review_score")


def _items_by_category(bronze: Bronze, keys: list[str], *measures: Column) -> DataFrame:
    """Items counted per order, category and `keys`; combined before they are shuffled."""
    items = with_product(bronze.order_items, bronze.products, bronze.product_category_name_translation)
    return items.groupBy("order_id", "product_category", *keys).agg(*measures)


def _punctual() -> Column:
    return on_time(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))


def star_customer_ltv(bronze: Bronze) -> DataFrame:
    orders = order_customers(bronze.orders, bronze.customers, "inner")
    return gold.customer_ltv_of(orders.join(item_totals(bronze.order_items), "order_id", "left"))


def star_payment_behavior(bronze: Bronze) -> DataFrame:
    """Cost is summed once per payment and the paid amount once per item here."""
    payments = bronze.order_payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n_payments"), F.sum("payment_installments").alias("installments")
    )
    payments_n = bronze.order_payments.groupBy("order_id").agg(F.count("*").alias("payments_n"))
    items = _items_by_category(bronze, [], F.count("*").alias("n_items"))
    totals = item_totals(bronze.order_items).join(payment_totals(bronze.order_payments), "order_id")
    cost = F.col("calculated_order_cost") * F.col("payments_n")
    paid = F.col("total_payment_value") * F.col("total_items_quantity")
    orders = (
        bronze.orders.select("order_id", "order_status")
        .join(totals, "order_id")
        .join(payments_n, "order_id")
        .join(_scores(bronze), "order_id", "left")
        .select(
            "order_id",
            "order_status",
            cost.alias("calculated_order_cost"),
            paid.alias("total_payment_value"),
            F.when(F.abs(cost - paid) < F.lit(MATCH_TOLERANCE).cast("decimal(2,1)"), 0).otherwise(1).alias("mismatch"),
            "review_score",
        )
    )
    return gold.payment_behavior_of(orders.join(items, "order_id").join(payments, "order_id"))


def star_seller_performance(bronze: Bronze) -> DataFrame:
    items = _items_by_category(
        bronze, ["seller_id"], F.count("*").alias("n"), F.sum(F.col("price").cast(EXACT)).alias("revenue")
    )
    orders = bronze.orders.where(F.col("order_status") == gold.DELIVERED).select(
        "order_id", _punctual().alias("is_delivered_on_time")
    )
    pairs = items.join(orders, "order_id").join(_scores(bronze), "order_id", "left")
    figures = gold.seller_performance_of(pairs, ["seller_id", "product_category"])
    # The state depends on the seller alone, so it is attached to the result.
    return figures.join(bronze.sellers.select("seller_id", "seller_state"), "seller_id")


def star_sales_kpi(bronze: Bronze) -> DataFrame:
    cost, paid = F.col("calculated_order_cost"), F.col("total_payment_value")
    promised, arrived = F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    orders = (
        order_customers(bronze.orders, bronze.customers, "inner")
        .join(item_totals(bronze.order_items), "order_id", "left")
        .join(payment_totals(bronze.order_payments), "order_id", "left")
        .join(_scores(bronze), "order_id", "left")
        .withColumn("payment_match_flag", payment_match(cost, paid, F.col("order_status")))
        .withColumn("is_delivered_on_time", _punctual())
        .withColumn("num_early_delivery_days", early_days(promised, arrived))
    )
    items = _items_by_category(bronze, [], F.count("*").alias("n"))
    keys = ["product_category", "order_status", "payment_match_flag", "customer_state", "customer_city"]
    return gold.sales_kpi_of(items.join(orders, "order_id"), keys)


def _delivered(bronze: Bronze) -> DataFrame:
    delivered = bronze.orders.where(F.col("order_status") == gold.DELIVERED)
    return order_customers(delivered, bronze.customers, "inner")


def star_cohort_retention_all(bronze: Bronze) -> DataFrame:
    return gold.cohort_retention_all_of(_delivered(bronze))


def star_cohort_retention_product(bronze: Bronze) -> DataFrame:
    items = with_product(bronze.order_items, bronze.products, bronze.product_category_name_translation)
    first_items = items.groupBy("order_id").agg(
        F.min("order_item_id").alias("first_item"),
        F.min_by("product_category", "order_item_id").alias("first_category"),
    )
    return gold.cohort_retention_product_of(_delivered(bronze).join(first_items, "order_id", "left"))
