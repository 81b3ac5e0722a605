"""Gold tables on the silver order data.

Several published figures are inflated by design and kept that way: order
values repeat per item in the sales KPIs, per item and payment in the payment
table, and every seller of an order is credited with all items of the order
in the seller table. None of this needs the exploded rows: with n items in a
category and m payments of a type, an order stands for n * m rows, so each
figure is a weighted sum over small per-order counts (`Silver.crossed`).

Orders and persons are counted distinct: an order that is stored twice adds to
the sums as often, as it does in the exploded rows, but counts once. Spark
deduplicates (keys, id) before it counts, so hot sellers, categories or
persons are always combined before a shuffle. Nested rows say how often their
order is stored, and the ids of orders stored once are not moved at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import count_where, money, month_label, month_start, on_time, ratio
from shopmart.functions.columns import early_days as early_days_of
from shopmart.operators.silver import COPIES, Silver, with_first_state
from shopmart.operators.tallies import Tally

DELIVERED = "delivered"
GROSS_MARGIN = 0.25
DAYS_PER_MONTH = 30.4
PROJECTED_MONTHS = 6
LAST_PERIOD = 6


def sales_kpi(silver: Silver) -> DataFrame:
    """Sales, customers, punctuality and reviews by category, status, match flag and place."""
    place = ["order_status", "payment_match_flag", "customer_state", "customer_city"]
    keys = ["product_category", *place]
    scalars = [
        "customer_unique_id",
        "calculated_order_cost",
        "num_early_delivery_days",
        "is_delivered_on_time",
        "review_score",
    ]
    orders = silver.crossed(silver.rows, [*place, *scalars], Tally("items", ["product_category"], "n"))
    return sales_kpi_of(orders, keys, silver.distinct_orders(orders))


def sales_kpi_of(orders: DataFrame, keys: list[str], orders_n: Column | None = None) -> DataFrame:
    """KPIs from one row per (order, category) that stands for `n` items; `orders_n` counts distinct orders."""
    n = F.col("n")
    return orders.groupBy(*keys).agg(
        money(F.sum(n * F.col("calculated_order_cost"))).alias("total_sales"),
        F.count_distinct("customer_unique_id").alias("total_customers"),
        (F.count_distinct("order_id") if orders_n is None else orders_n).alias("total_orders"),
        money(F.sum(n * F.col("num_early_delivery_days"))).alias("total_early_delivery_days"),
        F.sum(n * F.col("is_delivered_on_time")).alias("total_on_time_delivery"),
        F.sum(n * F.col("review_score")).alias("total_review_score"),
    )


def customer_ltv(silver: Silver) -> DataFrame:
    """Lifetime value of every person with a delivered order.

    `primary_state` depends on the person alone, so one aggregate per person
    gives it together with the sums; no window and no join back.
    """
    return customer_ltv_of(silver.orders)


def customer_ltv_of(orders: DataFrame) -> DataFrame:
    delivered = F.col("order_status") == DELIVERED
    day = F.col("order_purchase_timestamp").cast("date")
    persons = (
        orders.groupBy("customer_unique_id")
        .agg(
            F.min_by("customer_state", F.struct("order_purchase_timestamp", "order_id")).alias("primary_state"),
            F.count_distinct(F.when(delivered, F.col("order_id"))).alias("total_orders"),
            money(F.sum(F.when(delivered, F.col("calculated_order_cost")))).alias("historical_ltv"),
            F.datediff(F.max(F.when(delivered, day)), F.min(F.when(delivered, day))).alias("days_since_first_purchase"),
        )
        .where("total_orders > 0")
    )
    spent, orders_n = F.col("historical_ltv"), F.col("total_orders")
    per_month = F.nullif(F.col("days_since_first_purchase"), F.lit(0)).cast("double") / F.lit(DAYS_PER_MONTH)
    projected = F.col("historical_aov") * (F.try_divide(orders_n.cast("double"), per_month) * PROJECTED_MONTHS)
    return persons.withColumn("historical_aov", ratio(spent, orders_n, 2)).select(
        "customer_unique_id",
        "primary_state",
        "days_since_first_purchase",
        "total_orders",
        "historical_ltv",
        "historical_aov",
        F.round(projected, 2).alias("predicted_ltv_6m_heuristic"),
        F.round(spent * F.lit(GROSS_MARGIN), 2).alias("historical_profit_contribution"),
    )


def seller_performance(silver: Silver) -> DataFrame:
    """Items, revenue, punctuality and reviews by seller, state and category.

    Every seller of an order is paired with every item of the order, as the
    published table does; `star_seller_performance` holds the true figures.
    """
    delivered = silver.rows.where(F.col("order_status") == DELIVERED)
    pairs = silver.crossed(
        delivered,
        ["is_delivered_on_time", "review_score"],
        Tally("items", ["product_category"], "n_items", {"price": "price"}),
        Tally("sellers", ["seller_id", "seller_state"], "n_sellers"),
    )
    pairs = pairs.select(
        "order_id",
        "seller_id",
        "seller_state",
        "product_category",
        (F.col("n_sellers") * F.col("n_items")).alias("n"),
        (F.col("n_sellers") * F.col("price")).alias("revenue"),
        "is_delivered_on_time",
        "review_score",
        *[c for c in pairs.columns if c == COPIES],
    )
    keys = ["seller_id", "seller_state", "product_category"]
    return seller_performance_of(pairs, keys, silver.distinct_orders(pairs))


def seller_performance_of(pairs: DataFrame, keys: list[str], orders_n: Column | None = None) -> DataFrame:
    """Figures from one row per (order, seller, category) that stands for `n` items; `orders_n` counts distinct orders."""
    n, score = F.col("n"), F.col("review_score")
    orders_n = F.count_distinct("order_id") if orders_n is None else orders_n
    return pairs.groupBy(*keys).agg(
        F.sum(n).alias("total_order_items_sold"),
        money(F.sum("revenue")).alias("total_revenue_contribution"),
        ratio(F.sum(n * F.col("is_delivered_on_time")), orders_n, 4).alias("on_time_delivery_rate"),
        ratio(F.sum(n * score), F.sum(F.when(score.isNotNull(), n)), 2).alias("average_review_score"),
    )


def payment_behavior(silver: Silver) -> DataFrame:
    """Orders, value and risk by payment type, status and category.

    Orders without a payment have no row here, so 'Missing Payment' never
    adds to the mismatch count.
    """
    scalars = [
        "order_status",
        "calculated_order_cost",
        "total_payment_value",
        "payment_match_flag",
        "review_score",
    ]
    pairs = silver.crossed(
        silver.rows,
        scalars,
        Tally("items", ["product_category"], "n_items"),
        Tally("payments", ["payment_type"], "n_payments", {"installments": "payment_installments"}),
    ).withColumn("mismatch", F.when(F.col("payment_match_flag") == "Match", 0).otherwise(1))
    return payment_behavior_of(pairs, silver.distinct_orders(pairs))


def payment_behavior_of(pairs: DataFrame, orders_n: Column | None = None) -> DataFrame:
    """Figures from one row per (order, payment type, category); `orders_n` counts distinct orders."""
    orders_n = F.count_distinct("order_id") if orders_n is None else orders_n
    n = F.col("n_items") * F.col("n_payments")
    cost, paid = F.col("calculated_order_cost"), F.col("total_payment_value")
    mismatches = F.sum(n * F.col("mismatch"))
    return pairs.groupBy("payment_type", "order_status", "product_category").agg(
        orders_n.alias("total_dist_orders"),
        F.sum(n).alias("total_order_items"),
        money(F.sum(n * cost)).alias("total_gmv"),
        money(F.sum(n * (cost - paid))).alias("payment_missing_value"),
        F.sum(F.col("n_items") * F.col("installments")).cast("double").alias("total_installments"),
        mismatches.alias("mismatch_transactions_count"),
        ratio(mismatches, orders_n, 4).alias("payment_mismatch_rate"),
        F.sum(n * F.col("review_score")).cast("double").alias("total_review_score"),
    )


# ---------------------------------------------------------------- cohorts


def _retention(persons: DataFrame, keys: list[str]) -> DataFrame:
    """Retention rows from one row per person with cohort and purchase months.

    A cohort keeps seven counters, one per period, in one aggregate; the
    counter of period 0 is the cohort size, so no self join is needed.
    """
    bought = [
        count_where(F.array_contains("months", F.add_months("cohort_month", period).cast("date")))
        for period in range(LAST_PERIOD + 1)
    ]
    cohorts = persons.groupBy(*keys, "cohort_month").agg(F.array(*bought).alias("counts"))
    return (
        cohorts.select(
            *keys,
            "cohort_month",
            F.get("counts", F.lit(0)).alias("initial_cohort_size"),
            F.posexplode("counts").alias("period", "retained_customers"),
        )
        .where("retained_customers > 0 AND initial_cohort_size > 0")
        .select(
            *keys,
            "cohort_month",
            month_label(F.col("cohort_month")).alias("month_year"),
            F.col("period").cast("long").alias("retention_period"),
            "retained_customers",
            "initial_cohort_size",
            ratio(F.col("retained_customers"), F.col("initial_cohort_size")).alias("retention_rate"),
        )
    )


def _months() -> Column:
    """Distinct purchase months; as many as the calendar has, however many orders."""
    return F.collect_set(month_start(F.col("order_purchase_timestamp"))).alias("months")


def cohort_retention_all(silver: Silver) -> DataFrame:
    return cohort_retention_all_of(silver.orders.where(F.col("order_status") == DELIVERED))


def cohort_retention_all_of(delivered: DataFrame) -> DataFrame:
    """Share of each month's first-time buyers that buys again 0 to 6 months later."""
    persons = delivered.where("customer_unique_id IS NOT NULL").groupBy("customer_unique_id").agg(_months())
    return _retention(persons.withColumn("cohort_month", F.array_min("months")), [])


def cohort_retention_product(silver: Silver) -> DataFrame:
    delivered = silver.rows.where(F.col("order_status") == DELIVERED)
    first = silver.with_first(
        delivered, "items", "items_n", {"first_item": "order_item_id", "first_category": "product_category"}
    )
    return cohort_retention_product_of(first)


def cohort_retention_product_of(delivered: DataFrame) -> DataFrame:
    """From delivered orders with their `first_item` and `first_category`, null without items: retention with the cohort also split by the category of the very first item.

    Cohort month and category come from orders that have items, later
    purchases from all delivered orders, so an earlier order without items
    has a negative period and is left out. A null category forms no cohort.
    """
    has_item = F.col("first_item").isNotNull()
    when = F.struct("order_purchase_timestamp", "first_item", "order_id")
    persons = (
        delivered.groupBy("customer_unique_id")
        .agg(
            _months(),
            F.min(F.when(has_item, month_start(F.col("order_purchase_timestamp")))).alias("cohort_month"),
            F.min_by("first_category", F.when(has_item, when)).alias("cohort_category_name"),
        )
        .where("customer_unique_id IS NOT NULL AND cohort_category_name IS NOT NULL")
    )
    return _retention(persons, ["cohort_category_name"])


# ---------------------------------------------------------------- order and customer tables


def order_summary(silver: Silver) -> DataFrame:
    """Delivered orders flat; `primary_state` is over delivered orders only here."""
    delivered = silver.rows.where(F.col("order_status") == DELIVERED).drop("primary_state")
    orders = silver.with_first(delivered, "items", "items_n", {})
    orders = silver.with_first(orders, "sellers", "sellers_n", {"primary_seller_id": "seller_id"})
    arrived, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    latest_day = silver.orders.agg(F.max(F.col("order_purchase_timestamp").cast("date"))).scalar()
    return (
        with_first_state(orders)
        .select(
            "order_id",
            "order_status",
            F.col("order_purchase_timestamp").cast("date").alias("purchase_date"),
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "primary_state",
            F.col("calculated_order_cost").cast("double").alias("order_value"),
            F.col("total_payment_value").cast("double").alias("total_payment_value"),
            "payment_match_flag",
            "primary_seller_id",
            on_time(arrived, promised).alias("is_delivered_on_time"),
            F.datediff(arrived.cast("date"), F.col("order_approved_at").cast("date")).alias("num_delivery_days"),
            early_days_of(promised, arrived).cast("double").alias("num_early_delivery_days"),
            latest_day.alias("current_day"),
            F.col("items_n").cast("int").alias("total_items_quantity"),
        )
    )


def customer_metrics(summary: DataFrame, as_of: str = "2018-09-03") -> DataFrame:
    """Orders, spend and recency per person and state of the order summary."""
    last = F.max("purchase_date")
    return (
        summary.where(F.col("order_status") == DELIVERED)
        .groupBy("customer_unique_id", "primary_state")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money(F.sum(F.col("order_value").cast("decimal(18,2)"))).alias("total_spent"),
            F.min("purchase_date").alias("first_purchase_date"),
            last.alias("last_purchase_date"),
            F.datediff(F.lit(as_of).cast("date"), last).alias("recency_days"),
        )
    )
