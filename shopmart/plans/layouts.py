"""Compares both layouts: gold from the nested silver table and by raw joins."""

from __future__ import annotations

import json
import os
import time
from dataclasses import fields
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from shopmart.operators import gold, star
from shopmart.operators.silver import Silver, denormalized_orders
from shopmart.session import shared_dir
from shopmart.sources.bronze import Bronze
from shopmart.sources.storage import replace_table

TABLES = {
    "customer_ltv": (gold.customer_ltv, star.star_customer_ltv),
    "payment_behavior": (gold.payment_behavior, star.star_payment_behavior),
    "seller_performance": (gold.seller_performance, star.star_seller_performance),
    "sales_kpi": (gold.sales_kpi, star.star_sales_kpi),
    "cohort_retention_all": (gold.cohort_retention_all, star.star_cohort_retention_all),
    "cohort_retention_product": (gold.cohort_retention_product, star.star_cohort_retention_product),
}


def stored_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength())


def store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def bytes_read(log_folder: str, application: str) -> dict[str, int]:
    """Bytes that the tasks of each job description read from storage, from Spark's event log in a local folder."""
    stages: dict[int, str] = {}
    read: dict[str, int] = {}
    with open(os.path.join(log_folder, application)) as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                description = event.get("Properties", {}).get("spark.job.description")
                stages.update({s: description for s in event["Stage IDs"] if description})
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stages:
                name = stages[event["Stage ID"]]
                figures = (event.get("Task Metrics") or {}).get("Input Metrics") or {}
                read[name] = read.get(name, 0) + figures.get("Bytes Read", 0)
    return read


def _description(table: str, layout: str) -> str:
    return f"{layout}: {table}"


def bytes_by_layout(log_folder: str, application: str) -> list[dict]:
    """Bytes read per gold table by both layouts, and the share that the nested table saves."""
    read = bytes_read(log_folder, application)
    out = []
    for table in TABLES:
        silver, star_ = (read.get(_description(table, layout), 0) for layout in ("silver", "star"))
        out.append({"gold_table": table, "silver_bytes": silver, "star_bytes": star_, "saved": round(1 - silver / star_, 3) if star_ else None})
    return out


def silver_vs_star(spark: SparkSession, bronze: Bronze) -> DataFrame:
    """Seconds per gold table and stored bytes of both layouts.

    Both layouts are written first, so that each side reads columnar files
    and nothing else. The nested table is bucketed by order, so everything
    gold does per order takes no shuffle.
    """
    root = f"{shared_dir(spark)}/layouts-{uuid4().hex}"
    raw = {f.name: getattr(bronze, f.name) for f in fields(Bronze) if getattr(bronze, f.name) is not None}
    stored_raw = Bronze.from_tables({name: store(df, f"{root}/bronze/{name}") for name, df in raw.items()})
    buckets = spark.sparkContext.defaultParallelism
    name = f"nested_{uuid4().hex}"
    nested = Silver.from_table(
        replace_table(denormalized_orders(bronze), name, "order_id", buckets, path=f"{root}/silver")
    )
    sizes = {"silver": stored_bytes(spark, f"{root}/silver"), "star": stored_bytes(spark, f"{root}/bronze")}
    rows = []
    for table, (from_silver, from_star) in TABLES.items():
        for layout, job in (("silver", lambda: from_silver(nested)), ("star", lambda: from_star(stored_raw))):
            spark.sparkContext.setJobDescription(_description(table, layout))
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            rows.append((table, layout, time.perf_counter() - start, sizes[layout]))
    spark.sparkContext.setJobDescription(None)
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, "gold_table string, layout string, seconds double, stored_bytes bigint")
