"""The raw tables: their schemas and how they are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopmart.session import cut_lineage
from shopmart.sources.schema_files import read_schema

# Table layouts. Money stays double as in the raw files and is
# turned into exact decimals in silver. The two review dates are text.
SCHEMAS: dict[str, str] = {
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date date"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
        "customer_city string, customer_state string"
    ),
    "order_items": (
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price double, freight_value double"
    ),
    "order_payments": (
        "order_id string, payment_sequential bigint, payment_type string, "
        "payment_installments bigint, payment_value double"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score bigint, review_commend_title string, "
        "review_commend_message string, review_creation_date string, review_answer_timestamp string"
    ),
    "order_ratings": (
        "review_id string, order_id string, review_score bigint, "
        "review_creation_date date, review_answer_timestamp timestamp_ntz"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_length bigint, "
        "product_description_length bigint, product_photo_qty bigint, product_weight_g bigint, "
        "product_length_cm bigint, product_height_cm bigint, product_width_cm bigint"
    ),
    "sellers": "seller_id string, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    "product_category_name_translation": "product_category_name string, product_category_name_english string",
    "geolocation": (
        "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
}


@dataclass(frozen=True)
class Bronze:
    """The raw tables a silver build reads; all frames are lazy."""

    orders: DataFrame
    customers: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    products: DataFrame
    sellers: DataFrame
    product_category_name_translation: DataFrame
    geolocation: DataFrame | None = None

    @classmethod
    def from_tables(cls, tables: Mapping[str, DataFrame]) -> Bronze:
        return cls(**{f.name: tables[f.name] for f in fields(cls) if f.name in tables})

    @classmethod
    def from_database(cls, spark: SparkSession, database: str = "bronze") -> Bronze:
        names = [f.name for f in fields(cls) if spark.catalog.tableExists(f"{database}.{f.name}")]
        return cls.from_tables({n: spark.table(f"{database}.{n}") for n in names})


def read_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A raw CSV file or folder with a header line, read with the declared schema."""
    return spark.read.schema(SCHEMAS[table]).option("header", True).csv(path)


def load_csv(spark: SparkSession, folder: str, tables: list[str] | None = None, schemas: str | None = None) -> Bronze:
    """All raw tables of `folder`, one `<table>.csv` file or folder each.

    With `schemas` the schemas come from the files `<table>_schema.json` there.
    """
    names = tables or [f.name for f in fields(Bronze)]
    if schemas is None:
        return Bronze.from_tables({n: read_csv(spark, n, f"{folder}/{n}.csv") for n in names})
    declared = {n: read_schema(spark, f"{schemas}/{n}_schema.json") for n in names}
    read = {n: spark.read.schema(kind).option("header", True).csv(f"{folder}/{n}.csv") for n, kind in declared.items()}
    return Bronze.from_tables(read)


@dataclass(frozen=True)
class CheckedCsv:
    """A CSV read whose bad lines are set aside: `good` rows, and `rejected` (line, reason, file)."""

    good: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """Rows by verdict and reason, one pass over each side."""
        good = self.good.agg(F.count("*").alias("lines")).select(F.lit("good").alias("verdict"), F.lit(None).cast("string").alias("reason"), "lines")
        rejected = self.rejected.groupBy("reason").agg(F.count("*").alias("lines"))
        return good.unionByName(rejected.select(F.lit("rejected").alias("verdict"), "reason", "lines"))


LINE = "_line"
MALFORMED, MISSING = "malformed", "missing"


def read_checked_csv(
    spark: SparkSession, schema: str | StructType, path: str, header: bool = True, required: Sequence[str] = ()
) -> CheckedCsv:
    """A CSV read that loses no line silently.

    A line with a value that does not fit its type, or with too few or too many
    values, is rejected as malformed; one without a value in a `required` or
    non-nullable column as missing. The whole lines are read and stored once:
    a read of some columns would parse, and reject, by these alone.
    """
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    needed = dict.fromkeys([*required, *[f.name for f in declared.fields if not f.nullable]])
    open_ = StructType([StructField(f.name, f.dataType, True) for f in declared.fields])
    read = (
        spark.read.schema(StructType([*open_.fields, StructField(LINE, StringType())]))
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .csv(path)
    )
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed], F.lit(False))
    reason = F.when(F.col(LINE).isNotNull(), MALFORMED).when(missing, MISSING)
    stored = cut_lineage(read.select("*", F.col("_metadata.file_path").alias("_file"), reason.alias("_reason")))
    line = F.coalesce(LINE, F.to_csv(F.struct(*open_.names)))
    rejected = stored.where("_reason IS NOT NULL")
    return CheckedCsv(
        good=stored.where("_reason IS NULL").select(*open_.names),
        rejected=rejected.select(line.alias("line"), F.col("_reason").alias("reason"), F.col("_file").alias("file")),
    )
