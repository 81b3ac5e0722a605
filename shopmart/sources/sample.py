"""The sample star schema as raw marketplace tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmart.sources.bronze import Bronze
from shopmart.sources.sample_mapping import DIRTY, MAPPING, in_dialect

def number_by_parts(lineitem: DataFrame) -> DataFrame:
    """Item numbers of every order: lines by line number and part, those without either left out but counted.

    One shuffle by order, which the join with the orders goes on from. The
    quantity settles what the other columns leave open, and makes every reader
    ask for the same columns, so that all of them share the shuffle.
    """
    lines = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"
    )
    numbered = lineitem.withColumn("item_no", F.row_number().over(lines).cast("long"))
    return numbered.where("l_linenumber IS NOT NULL AND l_partkey IS NOT NULL")


def sample_bronze(spark: SparkSession, sf_dir: str, shared: bool = False) -> Bronze:
    """Raw marketplace tables derived from the star schema in `sf_dir`; all lazy.

    With `shared` every reader of the lines asks for their numbers, so that
    items, reviews and the costs that payments are made of share one shuffle of
    the lines. For jobs that read all of them; costs alone move fewer columns
    without numbers.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    tables = {name: read(name) for name in ("lineitem", "orders", "customer", "nation", "part", "supplier")}
    # Lines are dealt out, numbered and joined by the id they are published with, so that nothing that is counted or
    # joined by order later on moves them again.
    numbered = number_by_parts(tables["lineitem"].withColumn("l_orderkey", F.concat(F.lit("O"), "l_orderkey")))
    # True for every line of an order. The first part keeps the numbers in plans that do not read them; the second is
    # what Spark finds for payments alone, from their join with costs, and would filter the lines by before they move.
    same = "item_no > 0 AND l_orderkey IS NOT NULL"
    tables["numbered_lines"] = numbered.where(same) if shared else numbered

    raw: dict[str, DataFrame] = {}
    for name, text in MAPPING.items():
        text = in_dialect(text, "spark")
        inputs = {k: v for k, v in {**tables, **raw}.items() if f"{{{k}}}" in text}
        raw[name] = spark.sql(text, **inputs)
    raw["orders"] = raw.pop("b_orders")
    return Bronze.from_tables(raw)


def dirty_bronze(spark: SparkSession, sf_dir: str, shared: bool = False) -> Bronze:
    """The sample with planted faults in the keys of orders and products."""
    bronze = sample_bronze(spark, sf_dir, shared)
    return replace(
        bronze,
        orders=spark.sql(DIRTY["orders_dirty"], b_orders=bronze.orders),
        products=spark.sql(DIRTY["products_dirty"], products=bronze.products),
    )


def thirds_bronze(spark: SparkSession, sf_dir: str, shared: bool = False) -> Bronze:
    """The sample with amounts of three decimal places, which must be summed before they are rounded."""
    bronze = sample_bronze(spark, sf_dir, shared)
    return replace(
        bronze,
        order_items=spark.sql(DIRTY["items_thirds"], order_items=bronze.order_items),
        order_payments=spark.sql(DIRTY["payments_thirds"], order_payments=bronze.order_payments),
    )
