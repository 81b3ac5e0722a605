"""Silver: one order with its items, payments and sellers.

Two forms of the same data:

* flat parts (`Silver.from_bronze`): one frame of order scalars plus one frame
  per 1:n child. Everything is lazy, and joins a reader does not need drop out
  of the plan, because the child side of each is unique by `order_id`.
* the nested table (`denormalized_orders`, read back with `Silver.from_table`):
  the children as arrays of structs next to the scalars, so that readers need
  no join.

The nested table has exactly one row per stored order row, and an array holds
all children of the order, whatever their numbers. An order whose children do
not fit into one row belongs in the flat parts, which never gather them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import EXACT, MONEY, early_days, label, on_time, parse_review_time, title_case
from shopmart.operators.tallies import Tally, unfolded, with_tally
from shopmart.session import cut_lineage
from shopmart.sources.bronze import Bronze

MATCH_TOLERANCE = 0.1

# Struct fields of the nested arrays; the first one gives the order.
ITEM_FIELDS = (
    "order_item_id",
    "product_id",
    "price",
    "freight_value",
    "product_category",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
PAYMENT_FIELDS = ("payment_sequential", "payment_type", "payment_installments", "payment_value")
SELLER_FIELDS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")

ARRAYS = {"items": "order_items_array", "payments": "payments_array", "sellers": "sellers_array"}

# How often the order is stored; a column of the nested table for its readers, not for publication.
COPIES = "order_copies"


# ---------------------------------------------------------------- children


PRODUCT_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def with_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with `product_category`, translated where possible, else as it is, instead of their category name."""
    english = translation.select(
        "product_category_name", label(F.col("product_category_name_english")).alias("english_label")
    )
    own = label(F.col("product_category_name"))
    joined = products.withColumn("own_label", own).join(english, "product_category_name", "left")
    return joined.withColumn("product_category", F.coalesce("english_label", "own_label")).drop(
        "english_label", "own_label", "product_category_name"
    )


def with_product(items: DataFrame, products: DataFrame, translation: DataFrame, *fields: str) -> DataFrame:
    """Items with `product_category` and `fields` of their product, null for unknown products.

    The text work and the join with the translations are done on products, not
    on items, so that items are moved once, by product.
    """
    return items.join(
        with_category(products.select("product_id", "product_category_name", *fields), translation), "product_id", "left"
    )


def item_rows(order_items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per item with its product; product fields are null for unknown products."""
    items = order_items.withColumns({c: F.col(c).cast(EXACT) for c in ("price", "freight_value")})
    return with_product(items, products, translation, *PRODUCT_SIZES).select("order_id", *ITEM_FIELDS)


def labelled_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select("order_id", *PAYMENT_FIELDS).withColumn("payment_type", label(F.col("payment_type")))


def payment_rows(order_payments: DataFrame) -> DataFrame:
    return labelled_payments(order_payments).withColumn("payment_value", F.col("payment_value").cast(EXACT))


def seller_labels(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        title_case(F.col("seller_city")).alias("seller_city"),
        "seller_state",
    )


def seller_rows(order_items: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per item with its seller, all null when the seller is unknown; repeats are kept."""
    known = seller_labels(sellers)
    items = order_items.select("order_id", "order_item_id", F.col("seller_id").alias("item_seller"))
    return items.join(known, items["item_seller"] == known["seller_id"], "left").drop("item_seller")


# ---------------------------------------------------------------- per order


def item_cost() -> Column:
    return F.col("price").cast(EXACT) + F.col("freight_value").cast(EXACT)


def total(amount: Column) -> Column:
    """A sum of exact amounts, rounded once."""
    return F.round(F.sum(amount), 2).cast(MONEY)


def item_totals(order_items: DataFrame) -> DataFrame:
    """Cost and size of every order; sums are combined before the shuffle."""
    return order_items.groupBy("order_id").agg(
        total(item_cost()).alias("calculated_order_cost"), F.count("*").alias("total_items_quantity")
    )


def payment_totals(order_payments: DataFrame) -> DataFrame:
    paid = F.col("payment_value").cast(EXACT)
    return order_payments.groupBy("order_id").agg(total(paid).alias("total_payment_value"))


def review_rows(order_reviews: DataFrame) -> DataFrame:
    """(order_id, review, review_time): what is published of a review, and what makes it the latest."""
    created = parse_review_time(F.col("review_creation_date")).alias("review_cre_datetime")
    answered = parse_review_time(F.col("review_answer_timestamp")).alias("review_ans_datetime")
    return order_reviews.select(
        "order_id",
        F.struct("review_score", created, answered).alias("review"),
        F.struct(created, "review_id").alias("review_time"),
    )


def latest_review(order_reviews: DataFrame) -> DataFrame:
    """The review with the newest creation date of every order, ties by review_id.

    An aggregate instead of a window: the winner is chosen before the shuffle
    already, so an order with very many reviews costs nothing extra.
    """
    newest = F.max_by("review", "review_time").alias("review")
    return review_rows(order_reviews).groupBy("order_id").agg(newest).select("order_id", "review.*")


def first_state(orders: DataFrame) -> DataFrame:
    """State of the first order of every person, ties by order_id.

    An aggregate, because one person may hold very many orders.
    """
    first = F.min_by("customer_state", F.struct("order_purchase_timestamp", "order_id"))
    return orders.groupBy("customer_unique_id").agg(first.alias("primary_state"))


def with_first_state(orders: DataFrame) -> DataFrame:
    """Adds `primary_state` over the given orders; null for orders of no known person.

    The joined side is unique by person, so the join drops out of the plan
    when nobody reads the column.
    """
    return orders.join(first_state(orders), "customer_unique_id", "left")


def order_customers(orders: DataFrame, customers: DataFrame, how: str = "left", *fields: str) -> DataFrame:
    """Orders with the person and place behind their customer_id, and `fields` of the customer."""
    people = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        title_case(F.col("customer_city")).alias("customer_city"),
        "customer_state",
        *fields,
    )
    return orders.join(people, "customer_id", how).drop("customer_id")


def core_order(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer and the state of the person's first order.

    The state is joined to customers, not to orders, which have more and wider
    columns to move by person.
    """
    states = first_state(order_customers(orders, customers))
    known = customers.join(states, "customer_unique_id", "left")
    core = order_customers(orders, known, "left", "primary_state")
    person = "customer_unique_id"
    return core.select(person, *[c for c in core.columns if c != person])


def payment_match(cost: Column, paid: Column, status: Column) -> Column:
    """'Match' within the tolerance first, so a tiny unpaid order still matches."""
    gap = F.abs(F.coalesce(cost, F.lit(0)) - F.coalesce(paid, F.lit(0)))
    return (
        F.when(gap < F.lit(MATCH_TOLERANCE).cast("decimal(2,1)"), "Match")
        .when(status.isin("delivered", "shipped") & paid.isNull(), "Missing Payment")
        .otherwise("Discrepancy")
    )


def date_validity() -> Column:
    purchased, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    shipped, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    broken = (purchased > shipped) | (approved > shipped) | (shipped > delivered)
    return F.when(broken, "invalid").otherwise("valid")


def derived_facts() -> list[Column]:
    """What is computed from an order, its two totals and its review."""
    estimated, delivered = F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    cost, paid, none = F.col("calculated_order_cost"), F.col("total_payment_value"), F.lit(0).cast(MONEY)
    return [
        F.coalesce(cost, none).alias("calculated_order_cost"),
        F.coalesce(paid, none).alias("total_payment_value"),
        payment_match(cost, paid, F.col("order_status")).alias("payment_match_flag"),
        on_time(delivered, estimated).alias("is_delivered_on_time"),
        early_days(estimated, delivered).alias("num_early_delivery_days"),
        date_validity().alias("date_validity"),
        *map(F.col, ("review_score", "review_cre_datetime", "review_ans_datetime")),
    ]


def order_facts(bronze: Bronze) -> DataFrame:
    """All scalars of the silver table, one row per order."""
    core = core_order(bronze.orders, bronze.customers)
    joined = (
        core.join(item_totals(bronze.order_items), "order_id", "left")
        .join(payment_totals(bronze.order_payments), "order_id", "left")
        .join(latest_review(bronze.order_reviews), "order_id", "left")
    )
    return joined.select(*core.columns, *derived_facts())


# ---------------------------------------------------------------- both forms


def exploded(table: DataFrame, part: str, order_columns: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array of the nested table; empty arrays give none."""
    return table.select("order_id", *order_columns, F.inline(ARRAYS[part]))


def _grouped(rows: DataFrame, keys: list[str], measures: Sequence[Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(*measures) if measures else rows.select(*keys).distinct()


@dataclass(frozen=True)
class Silver:
    """Order scalars and children, from flat parts or from the nested table."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    sellers: DataFrame
    table: DataFrame | None = None

    @classmethod
    def from_bronze(cls, bronze: Bronze) -> Silver:
        return cls(
            orders=order_facts(bronze),
            items=item_rows(bronze.order_items, bronze.products, bronze.product_category_name_translation),
            payments=payment_rows(bronze.order_payments),
            sellers=seller_rows(bronze.order_items, bronze.sellers),
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> Silver:
        scalars = [c for c in table.columns if c not in (*ARRAYS.values(), COPIES, "_ingest_ts")]
        parts = {part: exploded(table, part) for part in ARRAYS}
        return cls(orders=table.select(*scalars), **parts, table=table)

    def stored(self) -> Silver:
        """The flat parts written once, for jobs that build many tables; one after the other, as each takes its room on disk."""
        return Silver(**{name: cut_lineage(getattr(self, name)) for name in ("orders", *ARRAYS)})

    @property
    def rows(self) -> DataFrame:
        """The orders, with their arrays if nested; unused columns drop out of a plan."""
        return self.orders if self.table is None else self.table

    def distinct_orders(self, rows: DataFrame) -> Column:
        """Number of orders in groups of `crossed` rows whose keys are the columns of all tallies, or of the order.

        Such a group holds a row of an order once, so only orders that are stored
        several times need their ids compared. A nested table tells them apart;
        without that column all ids are.
        """
        if COPIES not in rows.columns:
            return F.count_distinct("order_id")
        once = F.col(COPIES) == 1
        return F.count(F.when(once, F.col("order_id"))) + F.count_distinct(F.when(once, None).otherwise(F.col("order_id")))

    def crossed(self, orders: DataFrame, columns: Sequence[str], *tallies: Tally) -> DataFrame:
        """One row per order of `orders` and keys of every tally, with the order's `columns` alongside.

        `orders` are rows of `self.rows`. This is the building block of the gold
        tables: products of children become products of small per-order counts.
        Flat children are combined before they are shuffled or joined, and
        those of other orders are left out before that; nested ones never leave
        their row, so the table is read once and nothing is shuffled by order.
        """
        if self.table is None:
            found = orders.select("order_id", *columns)
            for t in tallies:
                per_order = _grouped(self.children(t.part, orders), ["order_id", *t.keys], t.measures())
                found = found.join(per_order, "order_id", "left" if t.optional else "inner")
            return found
        columns = [*columns, *([COPIES] if COPIES in orders.columns else [])]
        found = orders.select("order_id", *columns, *{ARRAYS[t.part] for t in tallies})
        names = [f"tally_{i}" for i in range(len(tallies))]
        for name, t in zip(names, tallies):
            found = with_tally(found, ARRAYS[t.part], t, name)
        found = found.select("order_id", *columns, *names)
        for name, t in zip(names, tallies):
            found = unfolded(found, t, name)
        return found

    def children(self, part: str, orders: DataFrame) -> DataFrame:
        """Flat children of the given orders.

        The ids are made distinct, so that the joins of the orders with other tables drop out of them.
        """
        rows = getattr(self, part)
        return rows if orders is self.orders else rows.join(orders.select("order_id").distinct(), "order_id", "left_semi")

    def with_first(self, orders: DataFrame, part: str, number: str, columns: Mapping[str, str]) -> DataFrame:
        """`orders` with `number` of children (null if none) and `columns` (name: field) of the first one by item id."""
        if self.table is None:
            first = [F.min_by(c, "order_item_id").alias(name) for name, c in columns.items()]
            return orders.join(_grouped(getattr(self, part), ["order_id"], [F.count("*").alias(number), *first]), "order_id", "left")
        array = ARRAYS[part]
        # Arrays are in the order of item ids, unknown ids before all others.
        first = F.get(F.filter(array, lambda x: x["order_item_id"].isNotNull()), F.lit(0))
        size = F.when(F.size(array) > 0, F.size(array).cast("long"))
        return orders.withColumns({number: size, **{name: first[c] for name, c in columns.items()}})


# ---------------------------------------------------------------- nested table


def _sorted_structs(columns: Sequence[str]) -> Column:
    """Child rows as an array in the order of the first column."""
    return F.sort_array(F.collect_list(F.struct(*columns)))


def items_agg(bronze: Bronze) -> DataFrame:
    """Item array per order, with the order's cost and size of the raw items.

    A product that is listed twice repeats elements of the array, not amounts.
    """
    rows = item_rows(bronze.order_items, bronze.products, bronze.product_category_name_translation)
    arrays = rows.groupBy("order_id").agg(_sorted_structs(ITEM_FIELDS).alias("order_items_array"))
    return item_totals(bronze.order_items).join(arrays, "order_id")


def sellers_agg(bronze: Bronze) -> DataFrame:
    """Seller array per order: one element per item, in item order and with its number."""
    rows = seller_rows(bronze.order_items, bronze.sellers)
    fields = [c for c in rows.columns if c != "order_id"]
    return rows.groupBy("order_id").agg(_sorted_structs(fields).alias("sellers_array"))


def payments_agg(order_payments: DataFrame) -> DataFrame:
    """Payment array per order, with the order's total."""
    rows = payment_rows(order_payments)
    return rows.groupBy("order_id").agg(
        total(F.col("payment_value")).alias("total_payment_value"), _sorted_structs(PAYMENT_FIELDS).alias("payments_array")
    )


def _listed(rows: DataFrame, key: str, fields: Sequence[str], several: str) -> DataFrame:
    """Every key once, with the `fields` of its row and, only where it has several rows, all of them as a list."""
    found = rows.groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("found"))
    first = [F.get("found", F.lit(0))[c].alias(c) for c in fields if c != key]
    return found.select(key, *first, F.when(F.size("found") > 1, F.col("found")).alias(several))


def products_listed(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Every product once, with all its rows and translations."""
    rows = with_category(products.select("product_id", *PRODUCT_SIZES, "product_category_name"), translation)
    return _listed(rows, "product_id", ["product_category", *PRODUCT_SIZES], "products")


def sellers_listed(sellers: DataFrame) -> DataFrame:
    """Every seller once, with all its rows."""
    return _listed(seller_labels(sellers), "seller_id", SELLER_FIELDS, "sellers")


def order_lines(bronze: Bronze) -> DataFrame:
    """One row per raw item with the fields of its product and seller, null where unknown.

    A product or seller that is listed several times is a list beside them, so
    it repeats no line on the way to the order. All fields are plain columns,
    which take less room than structs in every shuffle and sort on that way.
    """
    own = ("order_id", "order_item_id", "product_id", "price", "freight_value")
    lines = bronze.order_items.select(*own, F.col("seller_id").alias("item_seller"))
    known = sellers_listed(bronze.sellers)
    met = lines.join(known, lines["item_seller"] == known["seller_id"], "left").drop("item_seller")
    products = products_listed(bronze.products, bronze.product_category_name_translation)
    return met.join(products, "product_id", "left")


def _elements(lines: Column, several: str, fields: Sequence[str]) -> Column:
    """The array elements of an order's lines: one for each row of a line's product or seller, one where it is unknown."""

    def element(line: Column, row: Column) -> Column:
        own = {"order_item_id": line["order_item_id"], "product_id": line["product_id"]}
        own |= {c: line[c].cast(EXACT) for c in ("price", "freight_value")}
        return F.struct(*[(own[c] if c in own else row[c]).alias(c) for c in fields])

    def all_rows(line: Column) -> Column:
        return F.coalesce(F.transform(line[several], lambda row: element(line, row)), F.array(element(line, line)))

    listed_twice = F.exists(lines, lambda line: line[several].isNotNull())
    plain = F.transform(lines, lambda line: element(line, line))
    return F.when(listed_twice, F.flatten(F.transform(lines, all_rows))).otherwise(plain)


def denormalized_orders(bronze: Bronze) -> DataFrame:
    """The nested silver table, to be stored, in one shuffle by order.

    Orders, items, payments and reviews are one tagged union, each in a column
    of its own and null elsewhere. The union is dealt out by order as it is,
    since arrays do not shrink before the shuffle; there a single aggregate by
    order turns it into totals, the latest review and the arrays. An order that
    is stored twice comes out twice, each time with all children; children of
    no stored order go. Amounts come from the raw items, so that a product that
    is listed twice repeats elements of the array only.
    """
    core = core_order(bronze.orders, bronze.customers)
    lines = order_lines(bronze)
    parts = {
        "line": (lines, [c for c in lines.columns if c != "order_id"]),
        "payment": (labelled_payments(bronze.order_payments), PAYMENT_FIELDS),
        "review": (review_rows(bronze.order_reviews), ["review", "review_time.review_id"]),
    }
    # No child belongs to an order without id, as in a join. A filter of them would be moved into the numbering of the
    # lines and keep it from being shared with the reviews, so they stay, emptied.
    # The union carries every order id once, as the key, and amounts as they are stored.
    facts = [c for c in core.columns if c != "order_id"]
    union = core.select("order_id", F.struct(*facts).alias("core"))
    for name, (rows, fields) in parts.items():
        packed = rows.select("order_id", F.when(F.col("order_id").isNotNull(), F.struct(*fields)).alias(name))
        union = union.unionByName(packed, allowMissingColumns=True)
    # Rows are sorted and collected as they come, in their narrowest form; the arrays are made of what is collected.
    # The elements of the arrays are twice as wide, and would spill before an order is complete.
    cost = F.col("line.price").cast(EXACT) + F.col("line.freight_value").cast(EXACT)
    collected = union.repartition("order_id").groupBy("order_id").agg(
        F.collect_list("core").alias("copies"),
        F.count("core").cast("int").alias(COPIES),
        total(cost).alias("calculated_order_cost"),
        total(F.col("payment.payment_value").cast(EXACT)).alias("total_payment_value"),
        F.max_by("review.review", F.struct("review.review.review_cre_datetime", "review.review_id")).alias("review"),
        F.collect_list("line").alias("lines"),
        F.collect_list("payment").alias("payments"),
    )

    def array(rows: str, elements: Column) -> Column:
        return F.when(F.size(rows) > 0, F.sort_array(elements))

    def payment(row: Column) -> Column:
        return F.struct(*[(row[c].cast(EXACT) if c == "payment_value" else row[c]).alias(c) for c in PAYMENT_FIELDS])

    arrays = {
        "order_items_array": array("lines", _elements(F.col("lines"), "products", ITEM_FIELDS)),
        "sellers_array": array("lines", _elements(F.col("lines"), "sellers", ("order_item_id", *SELLER_FIELDS))),
        "payments_array": array("payments", F.transform("payments", payment)),
    }
    totals = (COPIES, "calculated_order_cost", "total_payment_value", "review")
    orders = collected.select("order_id", "copies", *totals, *[a.alias(name) for name, a in arrays.items()])
    sums = ("calculated_order_cost", "total_payment_value")
    copies = orders.select("order_id", F.inline("copies"), COPIES, *sums, "review.*", *arrays)
    nested = copies.select(*core.columns, *derived_facts(), *arrays, COPIES)
    return nested.withColumn("_ingest_ts", F.current_timestamp())
