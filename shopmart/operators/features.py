"""Point-in-time features for the seller and the customer models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import count_where, money, ratio
from shopmart.operators.gold import DELIVERED
from shopmart.operators.silver import ARRAYS, Silver
from shopmart.operators.tallies import Tally

PEAK_MONTHS = (11, 12)
GOOD_SCORE = 4
BAD_SCORE = 2
CANCELED = "canceled"
HORIZON_MONTHS = 6
RECENT_DAYS = 180

# Model inputs.
LTV_FEATURES = (
    "total_orders",
    "total_spent",
    "avg_order_value",
    "recency_days",
    "days_since_first_purchase",
    "customer_tenure_days",
    "avg_delivery_delay",
    "pct_ontime_deliveries",
    "avg_early_deliver_days",
    "avg_shipping_duration",
    "avg_review_score",
    "review_count",
    "pct_positive_reviews",
    "avg_response_time",
    "credit_pay_rate",
    "avg_payment_installments",
    "payment_match_rate",
    "unique_products_bought",
    "unique_categories_bought",
    "avg_product_price",
    "avg_freight_value",
    "last_purchase_month",
    "pct_orders_peak_season",
)
CHURN_FEATURES = (
    "num_orders",
    "distinct_categories",
    "avg_order_value",
    "lifetime_value",
    "avg_basket_size",
    "pct_on_time",
    "days_since_last_purchase",
    "avg_review_score",
    "pct_negative_reviews",
    "distinct_payment_types",
    "num_orders_180d",
    "ltv_180d",
    "num_canceled_orders",
)


def observation_time(silver: Silver, months: int = HORIZON_MONTHS) -> Column:
    """The newest purchase minus the horizon, as a scalar subquery over one column of the orders."""
    newest = silver.orders.agg(F.max("order_purchase_timestamp").alias("t"))
    return newest.select(F.col("t") - F.make_ym_interval(F.lit(0), F.lit(months))).scalar()


def ltv_target(silver: Silver) -> DataFrame:
    """What every seller's delivered orders were paid after the observation time.

    An order counts once per item the seller has in it.
    """
    later = silver.rows.where(
        (F.col("order_status") == DELIVERED) & (F.col("order_purchase_timestamp") > observation_time(silver))
    )
    sellers = silver.crossed(later, ["total_payment_value"], Tally("sellers", ["seller_id"], "n"))
    return sellers.groupBy("seller_id").agg(money(F.sum(F.col("n") * F.col("total_payment_value"))).alias("ltv_6m"))


def ltv_features(silver: Silver) -> DataFrame:
    """One row per seller with 23 features of the year before the observation time, and the target.

    The published table explodes sellers x items x payments, so an order with
    s items of a seller, i items and p payments stands for w = s * i * p rows.
    All sums and averages here are weighted by w over one row per order and
    seller. Two of the rates count every row and are therefore always 1.
    The target comes from the later orders in the same pass. Orders out of time
    are left out before their children are looked at, if these are nested.
    """
    observed = observation_time(silver)
    bought = F.col("order_purchase_timestamp")
    orders = (
        silver.rows.where(F.col("order_status") == DELIVERED)
        .where(bought > observed - F.make_ym_interval(F.lit(1), F.lit(0)))
        .where(bought != observed)
    )
    columns = [
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
        "order_delivered_customer_date",
        "total_payment_value",
        "is_delivered_on_time",
        "num_early_delivery_days",
        "review_score",
        "review_cre_datetime",
        "review_ans_datetime",
    ]
    amounts = {"price": "price", "freight": "freight_value"}
    rows = silver.crossed(
        orders,
        columns,
        Tally("items", (), "items", amounts, {"priced": "price", "freighted": "freight_value"}),
        Tally(
            "payments",
            (),
            "payments",
            {"installments": "payment_installments"},
            {"installed": "payment_installments"},
            optional=True,
        ),
        Tally("sellers", ["seller_id"], "own"),
    ).withColumn("later", bought > observed)
    features = _seller_sums(rows, observed)
    variety = seller_variety(silver, orders.where(bought < observed))
    return features.join(variety, features["seller_id"].eqNullSafe(variety["variety_seller"]), "left").select(
        "seller_id",
        *[F.coalesce(c, F.lit(0)).alias(c) if c.startswith("unique_") else c for c in LTV_FEATURES],
        "ltv_6m",
    )


def _seller_sums(rows: DataFrame, observed: Column) -> DataFrame:
    """Weighted sums per seller; later orders have no weight and only feed the target."""
    later, paid = F.col("later"), F.col("total_payment_value")
    counted = ~later & F.col("payments").isNotNull()
    rows = rows.withColumns(
        {
            "w": F.when(counted, F.col("own") * F.col("items") * F.col("payments")),
            "per_item": F.when(counted, F.col("own") * F.col("items")),
            "per_payment": F.when(counted, F.col("own") * F.col("payments")),
            "bought": F.when(counted, F.col("order_purchase_timestamp")),
        }
    )
    bought, w = F.col("bought"), F.col("w")
    promised, arrived = F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date").cast("date")
    all_rows = F.sum(w)

    def average(value: Column, digits: int) -> Column:
        return ratio(F.sum(w * value), F.sum(F.when(value.isNotNull(), w)), digits)

    def share(condition: Column) -> Column:
        return ratio(F.sum(F.when(condition, w).otherwise(0)), all_rows)

    def child_average(total: str, known: str, weight: str, digits: int) -> Column:
        return ratio(F.sum(F.col(weight) * F.col(total)), F.sum(F.col(weight) * F.col(known)), digits)

    first, last = F.min(bought), F.max(bought)
    score = F.col("review_score")
    answer_days = F.datediff(F.col("review_cre_datetime").cast("date"), F.col("review_ans_datetime").cast("date"))
    # A target is joined by seller, so unknown sellers have none.
    later_paid = F.sum(F.when(later & F.col("seller_id").isNotNull(), F.col("own") * paid))
    return (
        rows.groupBy("seller_id")
        .agg(
            all_rows.alias("total_orders"),
            money(F.sum(w * paid)).alias("total_spent"),
            F.coalesce(average(paid, 2), F.lit(0.0)).alias("avg_order_value"),
            F.datediff(observed.cast("date"), last.cast("date")).alias("recency_days"),
            F.datediff(observed.cast("date"), first.cast("date")).alias("days_since_first_purchase"),
            F.datediff(last.cast("date"), first.cast("date")).alias("customer_tenure_days"),
            average(F.datediff(promised, arrived), 2).alias("avg_delivery_delay"),
            average(F.col("is_delivered_on_time"), 2).alias("pct_ontime_deliveries"),
            average(F.col("num_early_delivery_days"), 2).alias("avg_early_deliver_days"),
            average(F.datediff(arrived, bought.cast("date")), 2).alias("avg_shipping_duration"),
            F.coalesce(average(score, 2), F.lit(0.0)).alias("avg_review_score"),
            F.sum(F.when(score.isNotNull() & w.isNotNull(), w).otherwise(0)).alias("review_count"),
            share(score >= GOOD_SCORE).alias("pct_positive_reviews"),
            F.coalesce(average(answer_days, 2), F.lit(0.0)).alias("avg_response_time"),
            F.round(ratio(all_rows, all_rows), 2).alias("credit_pay_rate"),
            child_average("installments", "installed", "per_item", 2).alias("avg_payment_installments"),
            F.round(ratio(all_rows, all_rows), 2).alias("payment_match_rate"),
            child_average("price", "priced", "per_payment", 0).alias("avg_product_price"),
            child_average("freight", "freighted", "per_payment", 0).alias("avg_freight_value"),
            F.month(last).alias("last_purchase_month"),
            share(F.month(bought).isin(*PEAK_MONTHS)).alias("pct_orders_peak_season"),
            F.coalesce(money(later_paid), F.lit(0.0)).alias("ltv_6m"),
        )
        .where("total_orders IS NOT NULL")
    )


VARIETY = {"product_id": "unique_products_bought", "product_category": "unique_categories_bought"}


def seller_variety(silver: Silver, orders: DataFrame) -> DataFrame:
    """Distinct products and categories of every seller in those of the given orders that have payments.

    A seller is credited with all products of an order it took part in, so
    the result is defined by the distinct (seller, product) pairs. Sellers and
    products of an order are made distinct before they meet, in the row if
    nested. The cost is one row per order, distinct seller and distinct
    product, combined before it is shuffled; an order of s sellers and p
    products costs s * p.
    """
    if silver.table is not None:
        pairs = _nested_variety(orders)
    else:
        paid = orders.select("order_id").join(silver.payments, "order_id", "left_semi")
        items, sellers = (silver.children(part, paid) for part in ("items", "sellers"))
        members = sellers.select("order_id", F.col("seller_id").alias("variety_seller")).distinct()
        sold = [
            items.select("order_id", F.lit(kind).alias("kind"), F.col(kind).alias("value")).distinct()
            for kind in VARIETY
        ]
        pairs = members.join(sold[0].union(sold[1]), "order_id")
    met = pairs.where(F.col("value").isNotNull()).select("variety_seller", "kind", "value").distinct()
    counts = [count_where(F.col("kind") == kind).alias(name) for kind, name in VARIETY.items()]
    return met.groupBy("variety_seller").agg(*counts)


def _nested_variety(orders: DataFrame) -> DataFrame:
    """(variety_seller, kind, value) pairs formed in the rows."""
    items, sellers = ARRAYS["items"], ARRAYS["sellers"]

    def values(kind: str) -> Column:
        distinct = F.array_distinct(F.transform(items, lambda x: x[kind]))
        return F.transform(distinct, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    sold = F.concat(*map(values, VARIETY)).alias("sold")
    members = F.explode(F.array_distinct(F.transform(sellers, lambda x: x["seller_id"]))).alias("variety_seller")
    paid = orders.where(F.size(ARRAYS["payments"]) > 0)
    return paid.select(sold, sellers).select("sold", members).select("variety_seller", F.inline("sold"))


def churn_label(features: DataFrame) -> DataFrame:
    """Churned is who was paid nothing after the observation time."""
    return features.withColumn("churn_6m", F.when(F.col("ltv_6m") > 0, 0).otherwise(1))


def churn_features_customer(silver: Silver, horizon_months: int = HORIZON_MONTHS) -> DataFrame:
    """One row per person with an order before the observation time.

    The column names are given by the model, the formulas are ours: all inputs
    lie before the observation time; lifetime value is the summed order cost;
    basket size is the mean number of items; a review is negative up to score
    2; days since the last purchase disregard canceled orders and are null
    when there is no other; the 180-day columns count the last 180 days before
    the observation time; churned is who places no order afterwards that is
    not canceled.
    """
    observed = observation_time(silver, horizon_months)
    bought = F.col("order_purchase_timestamp")
    before = bought < observed
    recent = before & (bought >= observed - F.make_dt_interval(F.lit(RECENT_DAYS)))
    kept = F.col("order_status") != CANCELED
    cost, score = F.col("calculated_order_cost"), F.col("review_score")
    orders = silver.with_first(silver.rows.where("customer_unique_id IS NOT NULL"), "items", "items", {})

    n = count_where(before)
    persons = (
        orders.groupBy("customer_unique_id")
        .agg(
            n.alias("num_orders"),
            ratio(F.sum(F.when(before, cost)), n, 2).alias("avg_order_value"),
            money(F.sum(F.when(before, cost))).alias("lifetime_value"),
            ratio(F.sum(F.when(before, F.coalesce("items", F.lit(0)))), n, 2).alias("avg_basket_size"),
            ratio(F.sum(F.when(before, F.col("is_delivered_on_time"))), n, 4).alias("pct_on_time"),
            F.datediff(observed.cast("date"), F.max(F.when(before & kept, bought)).cast("date")).alias(
                "days_since_last_purchase"
            ),
            ratio(F.sum(F.when(before, score)), count_where(before & score.isNotNull()), 2).alias("avg_review_score"),
            F.coalesce(
                ratio(count_where(before & (score <= BAD_SCORE)), count_where(before & score.isNotNull()), 4),
                F.lit(0.0),
            ).alias("pct_negative_reviews"),
            count_where(recent).alias("num_orders_180d"),
            F.coalesce(money(F.sum(F.when(recent, cost))), F.lit(0.0)).alias("ltv_180d"),
            count_where(before & ~kept).alias("num_canceled_orders"),
            F.when(count_where(~before & kept) > 0, 0).otherwise(1).alias("churn_flag"),
        )
        .where("num_orders > 0")
    )
    categories = _distinct_per_person(silver, "items", "product_category", "distinct_categories", observed)
    payment_types = _distinct_per_person(silver, "payments", "payment_type", "distinct_payment_types", observed)
    return (
        persons.join(categories, "customer_unique_id", "left")
        .join(payment_types, "customer_unique_id", "left")
        .fillna(0, ["distinct_categories", "distinct_payment_types"])
        .select("customer_unique_id", *CHURN_FEATURES, "churn_flag")
    )


def _distinct_per_person(silver: Silver, part: str, column: str, name: str, observed: Column) -> DataFrame:
    """Distinct values in a person's orders before a time; two levels, so no set is held."""
    before = silver.rows.where(F.col("order_purchase_timestamp") < observed)
    pairs = silver.crossed(before, ["customer_unique_id"], Tally(part, [column], "n")).where(F.col(column).isNotNull())
    return pairs.select("customer_unique_id", column).distinct().groupBy("customer_unique_id").agg(
        F.count("*").alias(name)
    )


def fill_missing(features: DataFrame) -> DataFrame:
    """No review counts as score 0, no purchase as -1 days."""
    return features.fillna({"avg_review_score": 0, "days_since_last_purchase": -1})
