"""Wall time of the headline queries; prints one JSON line.

Raw tables and the nested silver table are stored first, outside the clock
(`inputs_sec`). Gold is timed on stored silver, its star twins, silver and
checks on stored raw tables. The reports that store tables of their own still
start from the sample and pay for deriving it; they are named in `from_sample`.

BENCH_SF_DIR  folder of the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names instead of the headline list
BENCH_LAYOUTS if set, both storage layouts are compared too, seconds and bytes read, on stderr
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import fields

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "silver_denormalized_orders",
    "silver_core_order",
    "gold_sales_kpi",
    "gold_customer_ltv",
    "gold_seller_performance",
    "gold_payment_behavior",
    "gold_cohort_retention_all",
    "gold_cohort_retention_product",
    "gold_order_summary",
    "gold_customer_metrics",
    "gold_ltv_features",
    "star_customer_ltv",
    "star_payment_behavior",
    "star_seller_performance",
    "star_sales_kpi",
    "star_cohort_retention_all",
    "star_cohort_retention_product",
    "churn_features_customer",
    "dq_customer_moved",
    "dq_cost_payment_mismatch",
    "dq_gold_report",
    "profile_describe",
    "ml_metrics",
)


def main() -> None:
    from shopmart.operators.silver import Silver, denormalized_orders
    from shopmart.plans.catalog import FROM_BRONZE, FROM_SILVER, GOLD_TABLES, QUERIES
    from shopmart.session import build_session, cut_lineage
    from shopmart.sources.bronze import Bronze
    from shopmart.sources.sample import sample_bronze

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    log_folder = tempfile.mkdtemp(prefix="bench-events-") if os.environ.get("BENCH_LAYOUTS") else None
    log = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_folder}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            **(log if log_folder else {}),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    raw = {f.name: getattr(sample_bronze(spark, folder), f.name) for f in fields(Bronze)}
    bronze = Bronze.from_tables({name: cut_lineage(df) for name, df in raw.items() if df is not None})
    nested = Silver.from_table(cut_lineage(denormalized_orders(bronze)))
    inputs_sec = round(time.perf_counter() - start, 3)

    def build(name: str) -> DataFrame:
        if name in GOLD_TABLES:
            return GOLD_TABLES[name](nested)
        if name in FROM_SILVER:
            return FROM_SILVER[name](Silver.from_bronze(bronze))
        return FROM_BRONZE[name](bronze) if name in FROM_BRONZE else QUERIES[name](spark, folder)

    def run(name: str) -> float:
        start = time.perf_counter()
        build(name).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("gold_sales_kpi")  # JVM warm-up, not counted
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "inputs_sec": inputs_sec,
                "from_sample": [n for n in names if not any(n in d for d in (GOLD_TABLES, FROM_SILVER, FROM_BRONZE))],
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    if log_folder:
        from shopmart.plans.layouts import bytes_by_layout, silver_vs_star

        application = spark.sparkContext.applicationId
        for row in silver_vs_star(spark, bronze).collect():
            print(row.asDict(), file=sys.stderr)
        spark.stop()  # the log is complete from here on
        for row in bytes_by_layout(log_folder, application):
            print(row, file=sys.stderr)
    spark.stop()


if __name__ == "__main__":
    main()
