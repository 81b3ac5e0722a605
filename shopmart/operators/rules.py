"""Declared rules on tables, reported as (table, column, rule, failing_rows)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT = ["table", "column", "rule", "failing_rows"]


@dataclass(frozen=True)
class Rule:
    """`kind` is unique, not_null, accepted_values or a row predicate in SQL."""

    column: str
    kind: str
    values: tuple[str, ...] = ()


def unique(column: str) -> Rule:
    return Rule(column, "unique")


def not_null(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def accepted_values(column: str, *values: str) -> Rule:
    return Rule(column, "accepted_values", values)


def expression(column: str, predicate: str) -> Rule:
    return Rule(column, predicate)


def _failing(rule: Rule) -> Column:
    """Condition of a failing row; a null value fails not_null only."""
    if rule.kind == "not_null":
        return F.col(rule.column).isNull()
    if rule.kind == "accepted_values":
        return ~F.col(rule.column).isin(*rule.values)
    return ~F.expr(rule.kind)


def _row_counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.count(F.when(_failing(r), 1)).alias(f"r{i}") for i, r in enumerate(rules) if r.kind != "unique"]


def _entry(table: str, rule: Rule, failing: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.kind).alias("rule"),
        failing.alias("failing_rows"),
    )


def apply_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule. All row rules share one pass; each unique rule is one count per value."""
    parts = []
    counts = _row_counts(rules)
    if counts:
        entries = [_entry(table, r, F.col(f"r{i}")) for i, r in enumerate(rules) if r.kind != "unique"]
        parts.append(df.agg(*counts).select(F.inline(F.array(*entries))))
    for rule in rules:
        if rule.kind == "unique":
            per_value = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("n"))
            parts.append(per_value.agg(F.count(F.when(F.col("n") > 1, 1)).alias("n")).select(F.inline(F.array(_entry(table, rule, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)


def store_checked(df: DataFrame, table: str, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Stores a table and reports its rules: row rules are counted while it is written, unique ones on what is stored.

    Only the columns of unique rules are read again.
    """
    rules = RULES[table]
    counts = _row_counts(rules)
    seen = Observation(f"{table}-{uuid4().hex}")
    stored = store(df.observe(seen, *counts) if counts else df)
    rows = [(table, r.column, r.kind, seen.get[f"r{i}"]) for i, r in enumerate(rules) if r.kind != "unique"]
    report = df.sparkSession.createDataFrame(rows, "table string, column string, rule string, failing_rows bigint")
    unique = [r for r in rules if r.kind == "unique"]
    return stored, report.unionByName(apply_rules(stored, table, unique)) if unique else report


# The rules of the silver and gold tables.
COHORT_RULES = [
    *not_null(
        "cohort_month",
        "month_year",
        "retention_period",
        "retained_customers",
        "initial_cohort_size",
        "retention_rate",
    ),
    expression("retention_period", "retention_period >= 0"),
    expression("retained_customers", "retained_customers >= 0"),
    expression("initial_cohort_size", "initial_cohort_size >= 1"),
    expression("retention_rate", "retention_rate >= 0 AND retention_rate <= 1"),
]
RULES: dict[str, list[Rule]] = {
    "denormalized_orders": [
        unique("order_id"),
        *not_null("order_id"),
        accepted_values("payment_match_flag", "Match", "Discrepancy", "Missing Payment"),
    ],
    "customer_ltv": [
        unique("customer_unique_id"),
        *not_null(
            "customer_unique_id",
            "total_orders",
            "historical_ltv",
            "historical_aov",
            "predicted_ltv_6m_heuristic",
            "historical_profit_contribution",
        ),
        expression("total_orders", "total_orders >= 1"),
        expression("historical_ltv", "historical_ltv >= 0"),
        expression("historical_aov", "historical_aov >= 0"),
    ],
    "cohort_retention_product": [*not_null("cohort_category_name"), *COHORT_RULES],
    "cohort_retention_all": COHORT_RULES,
    "payment_behavior": [
        *not_null(
            "payment_type",
            "order_status",
            "product_category",
            "total_dist_orders",
            "total_order_items",
            "total_gmv",
            "total_installments",
            "mismatch_transactions_count",
            "payment_mismatch_rate",
            "total_review_score",
        ),
        expression("total_dist_orders", "total_dist_orders >= 1"),
        expression("total_gmv", "total_gmv >= 0"),
        expression("mismatch_transactions_count", "mismatch_transactions_count >= 0"),
        expression("payment_mismatch_rate", "payment_mismatch_rate >= 0 AND payment_mismatch_rate <= 1"),
    ],
    "seller_performance": [
        *not_null(
            "seller_id",
            "product_category",
            "total_order_items_sold",
            "total_revenue_contribution",
            "on_time_delivery_rate",
            "average_review_score",
        ),
        expression("total_order_items_sold", "total_order_items_sold >= 1"),
        expression("total_revenue_contribution", "total_revenue_contribution >= 0"),
        expression("on_time_delivery_rate", "on_time_delivery_rate >= 0 AND on_time_delivery_rate <= 1"),
        expression("average_review_score", "average_review_score >= 1 AND average_review_score <= 5"),
    ],
    "sales_kpi": [
        *not_null(
            "product_category",
            "order_status",
            "payment_match_flag",
            "total_sales",
            "total_customers",
            "total_orders",
            "total_on_time_delivery",
            "total_review_score",
        ),
        expression("total_sales", "total_sales >= 0"),
        expression("total_customers", "total_customers >= 1"),
        expression("total_orders", "total_orders >= 1"),
        expression("total_on_time_delivery", "total_on_time_delivery >= 0"),
    ],
}


def asked(table: str, kinds: Sequence[str] | None) -> list[Rule]:
    """The rules of a table; `kinds` keeps some kinds ('expression' for predicates)."""
    named = ("unique", "not_null", "accepted_values")
    return [r for r in RULES[table] if kinds is None or (r.kind if r.kind in named else "expression") in kinds]


def report(tables: dict[str, DataFrame], kinds: Sequence[str] | None = None) -> DataFrame:
    """The reports of several tables on rules of the given kinds."""
    parts = [apply_rules(df, table, rules) for table, df in tables.items() if (rules := asked(table, kinds))]
    return reduce(DataFrame.unionByName, parts)
