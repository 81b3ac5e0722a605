"""Checks of the raw tables: violating rows, or one number.

Counts per key are combined before the shuffle, and lists of known keys are
made distinct first, so a key that fills a table does not gather in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import not_in, parse_review_time, ratio
from shopmart.operators.silver import item_totals, payment_totals
from shopmart.sources.bronze import Bronze

PAYMENT_TOLERANCE = 0.1


def repeated(df: DataFrame, key: str, count: str = "row_count") -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def orders_null_keys(bronze: Bronze) -> DataFrame:
    return bronze.orders.where("order_id IS NULL OR customer_id IS NULL OR order_status IS NULL")


def orders_dup_order_id(bronze: Bronze) -> DataFrame:
    return repeated(bronze.orders, "order_id", "dup_ord_id")


def _distinct(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row with the number of distinct keys, counted after a distributed distinct."""
    return df.select(key).distinct().agg(F.count(key).alias(name))


def customers_distinct_ratio(bronze: Bronze) -> DataFrame:
    rows = bronze.customers.groupBy("customer_id").agg(F.count("*").alias("n"))
    return rows.agg(ratio(F.count("customer_id"), F.sum("n")).alias("distinct_ratio"))


def orders_customer_ratio(bronze: Bronze) -> DataFrame:
    rows = bronze.orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    return rows.agg(ratio(F.count("customer_id"), F.sum("n")).alias("distinct_ratio"))


def orders_dup_customer_id(bronze: Bronze) -> DataFrame:
    return repeated(bronze.orders, "customer_id")


def products_dup(bronze: Bronze) -> DataFrame:
    return repeated(bronze.products, "product_id")


def multi_payment_orders(bronze: Bronze) -> DataFrame:
    return repeated(bronze.order_payments, "order_id")


def repeat_customers(bronze: Bronze) -> DataFrame:
    return repeated(bronze.customers, "customer_unique_id")


def distinct_orders(bronze: Bronze) -> DataFrame:
    return _distinct(bronze.orders, "order_id", "distinct_orders")


def distinct_order_customers(bronze: Bronze) -> DataFrame:
    return _distinct(bronze.orders, "customer_id", "distinct_customers")


def customer_moved(bronze: Bronze) -> DataFrame:
    """Customer rows of which the same person has rows at another zip or city.

    The pairs of one person grow with the square of its rows, so every row is
    returned once with `moved_pairs`, the number of its partners. A partner
    differs in zip or in city, and an unknown value differs from nothing:
    partners = other zips + other cities - both other, each from counts per
    (person), (person, zip), (person, city) and (person, zip, city).
    """
    person, zip_code, city = "customer_unique_id", "customer_zip_code_prefix", "customer_city"
    places = bronze.customers.groupBy(person, zip_code, city).agg(F.count("*").alias("n"))
    n, has_zip, has_city = F.col("n"), F.col(zip_code).isNotNull(), F.col(city).isNotNull()

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    persons = places.groupBy(person).agg(
        total(has_zip).alias("zips"), total(has_city).alias("cities"), total(has_zip & has_city).alias("both")
    )
    same_zip = places.where(has_zip).groupBy(person, zip_code).agg(
        F.sum("n").alias("zip_n"), total(has_city).alias("zip_city_known")
    )
    same_city = places.where(has_city).groupBy(person, city).agg(
        F.sum("n").alias("city_n"), total(has_zip).alias("city_zip_known")
    )
    other_zip = F.when(has_zip, F.col("zips") - F.col("zip_n")).otherwise(0)
    other_city = F.when(has_city, F.col("cities") - F.col("city_n")).otherwise(0)
    other_both = F.when(
        has_zip & has_city, F.col("both") - F.col("zip_city_known") - F.col("city_zip_known") + n
    ).otherwise(0)
    partners = (
        places.where(F.col(person).isNotNull())
        .join(persons, person)
        .join(same_zip, [person, zip_code], "left")
        .join(same_city, [person, city], "left")
        .select(person, zip_code, city, (other_zip + other_city - other_both).alias("moved_pairs"))
        .where("moved_pairs > 0")
    )
    rows, moved = bronze.customers.alias("c"), partners.alias("m")
    same_place = (
        (F.col(f"c.{person}") == F.col(f"m.{person}"))
        & F.col(f"c.{zip_code}").eqNullSafe(F.col(f"m.{zip_code}"))
        & F.col(f"c.{city}").eqNullSafe(F.col(f"m.{city}"))
    )
    return rows.join(moved, same_place).select("c.*", "m.moved_pairs")


def multi_review_orders(bronze: Bronze) -> DataFrame:
    """All reviews of orders with more than one review, creation date parsed.

    The published right join keeps one empty row if several reviews have no
    order at all; it is added here, so that the join itself can be a semi
    join, whose large side may be split.
    """
    several = repeated(bronze.order_reviews, "order_id").select("order_id")
    reviews = bronze.order_reviews.withColumn("parsed_cre_date", parse_review_time(F.col("review_creation_date"))).drop(
        "review_creation_date"
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in reviews.schema.fields]
    unmatched = several.where(F.col("order_id").isNull()).select(*nothing)
    return reviews.join(several, "order_id", "left_semi").select(reviews.columns).unionByName(unmatched)


def multi_review_latest(bronze: Bronze) -> DataFrame:
    """The kept review of orders with more than one review, in one aggregate."""
    created = parse_review_time(F.col("review_creation_date"))
    answered = parse_review_time(F.col("review_answer_timestamp"))
    newest = F.max_by(
        F.struct("review_score", created.alias("created"), answered.alias("answered")), F.struct(created, "review_id")
    )
    kept = (
        bronze.order_reviews.groupBy("order_id")
        .agg(newest.alias("review"), F.count("*").alias("n"))
        .where("n > 1")
    )
    known = F.col("order_id").isNotNull()
    return kept.select(
        "order_id",
        F.when(known, F.col("review.review_score")).alias("review_score"),
        F.when(known, F.col("review.created")).alias("review_cre_date"),
        F.when(known, F.col("review.answered")).alias("review_ans_datetime"),
    )


def untranslated_categories(bronze: Bronze) -> DataFrame:
    return not_in(bronze.products, "product_category_name", bronze.product_category_name_translation)


def orders_without_review(bronze: Bronze) -> DataFrame:
    return not_in(bronze.orders, "order_id", bronze.order_reviews)


def reviews_without_order(bronze: Bronze) -> DataFrame:
    return not_in(bronze.order_reviews, "order_id", bronze.orders)


def items_without_product(bronze: Bronze) -> DataFrame:
    return not_in(bronze.order_items, "product_id", bronze.products)


def invalid_dates(bronze: Bronze) -> DataFrame:
    """Orders whose timestamps are out of order in one of five ways."""
    purchased, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    shipped, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    return bronze.orders.where(
        (purchased > approved)
        | (purchased > shipped)
        | (purchased > delivered)
        | (approved > shipped)
        | (shipped > delivered)
    )


def orders_without_payment(bronze: Bronze) -> DataFrame:
    return not_in(bronze.orders, "order_id", bronze.order_payments)


def orders_without_items(bronze: Bronze) -> DataFrame:
    return not_in(bronze.orders, "order_id", bronze.order_items)


def cost_payment_mismatch(bronze: Bronze) -> DataFrame:
    """Orders with items and payments whose totals differ by more than the tolerance."""
    cost, paid = F.col("calculated_order_cost"), F.col("total_payment_value")
    return (
        bronze.orders.join(item_totals(bronze.order_items), "order_id")
        .join(payment_totals(bronze.order_payments), "order_id")
        .where(F.abs(cost - paid) > F.lit(PAYMENT_TOLERANCE).cast("decimal(2,1)"))
        .select(
            "order_id",
            "order_status",
            cost.cast("double").alias("calculated_total_price"),
            paid.cast("double").alias("total_payment_value"),
        )
    )
