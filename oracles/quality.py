"""Raw table checks and rule reports in SQL."""

from __future__ import annotations

import oracles.gold  # noqa: F401 - its parts are used here
from oracles.compose import part, query
from shopmart.operators.rules import RULES, Rule
from shopmart.sources.sample_mapping import DIRTY

for _name, _text in DIRTY.items():
    part(_name, _text)


def repeated(table: str, key: str, count: str = "row_count") -> str:
    return query(f"select {key}, count(*) {count} from {table} group by {key} having count(*) > 1")


def without(table: str, key: str, other: str) -> str:
    return query(f"select * from {table} where {key} not in (select {key} from {other})")


part("several_reviews", "select order_id from {order_reviews} group by order_id having count(*) > 1")

CHECKS: dict[str, str] = {
    "dq_orders_null_keys": query(
        "select * from {orders_dirty} where order_id is null or customer_id is null or order_status is null"
    ),
    "dq_orders_dup_order_id": repeated("{orders_dirty}", "order_id", "dup_ord_id"),
    "dq_customers_distinct_ratio": query(
        "select DIV(count(distinct customer_id), (select count(*) from {customers})) distinct_ratio from {customers}"
    ),
    "dq_orders_customer_ratio": query(
        "select DIV(count(distinct customer_id), (select count(*) from {orders_dirty})) distinct_ratio "
        "from {orders_dirty}"
    ),
    "dq_orders_dup_customer_id": repeated("{orders_dirty}", "customer_id"),
    "dq_products_dup": repeated("{products_dirty}", "product_id"),
    "dq_multi_payment_orders": repeated("{order_payments}", "order_id"),
    "dq_repeat_customers": repeated("{customers}", "customer_unique_id"),
    "dq_distinct_orders": query("select count(distinct order_id) distinct_orders from {orders_dirty}"),
    "dq_distinct_order_customers": query("select count(distinct customer_id) distinct_customers from {orders_dirty}"),
    "dq_customer_moved": query("""
select a.customer_id, a.customer_unique_id, a.customer_zip_code_prefix, a.customer_city, a.customer_state,
  count(*) moved_pairs
from {customers} a left join {customers} b on a.customer_unique_id = b.customer_unique_id
where a.customer_zip_code_prefix <> b.customer_zip_code_prefix or a.customer_city <> b.customer_city
group by all"""),
    "dq_multi_review_orders": query("""
select t.* exclude (review_creation_date), strptime(t.review_creation_date, '%m/%d/%Y %H:%M') parsed_cre_date
from {order_reviews} t right join {several_reviews} s on t.order_id = s.order_id"""),
    "dq_multi_review_latest": query("""
select r.order_id, r.review_score, r.review_cre_datetime review_cre_date, r.review_ans_datetime
from {review} r right join {several_reviews} s on r.order_id = s.order_id"""),
    "dq_untranslated_categories": without("{products}", "product_category_name", "{product_category_name_translation}"),
    "dq_orders_without_review": without("{b_orders}", "order_id", "{order_reviews}"),
    "dq_reviews_without_order": without("{order_reviews}", "order_id", "{b_orders}"),
    "dq_items_without_product": query("""
select * replace (cast(price as double) as price, cast(freight_value as double) as freight_value)
from {order_items} where product_id not in (select product_id from {products})"""),
    "dq_invalid_dates": query("""
select * from {b_orders}
where order_purchase_timestamp > order_approved_at or order_purchase_timestamp > order_delivered_carrier_date
  or order_purchase_timestamp > order_delivered_customer_date or order_approved_at > order_delivered_carrier_date
  or order_delivered_carrier_date > order_delivered_customer_date"""),
    "dq_orders_without_payment": without("{b_orders}", "order_id", "{order_payments}"),
    "dq_orders_without_items": without("{b_orders}", "order_id", "{order_items}"),
    "dq_cost_payment_mismatch": query("""
select o.order_id, o.order_status, cast(cost as double) calculated_total_price,
  cast(paid as double) total_payment_value
from {b_orders} o join {costs} using (order_id) join {paid} using (order_id) where abs(cost - paid) > 0.1"""),
}

SOURCES = {
    "denormalized_orders": "facts",
    "customer_ltv": "ltv",
    "cohort_retention_product": "cohorts_product",
    "cohort_retention_all": "cohorts_all",
    "payment_behavior": "pay_behavior",
    "seller_performance": "seller_perf",
    "sales_kpi": "kpi",
}


def failing(rule: Rule, source: str) -> str:
    if rule.kind == "unique":
        return (
            f"(select count(*) from (select {rule.column} from {{{source}}} where {rule.column} is not null "
            f"group by 1 having count(*) > 1))"
        )
    if rule.kind == "not_null":
        condition = f"{rule.column} is null"
    elif rule.kind == "accepted_values":
        condition = f"{rule.column} not in ({', '.join(repr(v) for v in rule.values)})"
    else:
        condition = f"not ({rule.kind})"
    return f"(select count(*) from {{{source}}} where {condition})"


def report(sources: dict[str, str], kinds: tuple[str, ...]) -> str:
    rows = []
    for table, source in sources.items():
        for rule in RULES[table]:
            kind = rule.kind if rule.kind in ("unique", "not_null", "accepted_values") else "expression"
            if kind in kinds:
                rows.append(
                    f"select '{table}' \"table\", '{rule.column}' \"column\", '{rule.kind}' \"rule\", "
                    f"{failing(rule, source)} failing_rows"
                )
    return query("\nunion all\n".join(rows))


# Silver over the dirty orders, as far as the rules look at it.
part("dirty_facts", "select order_id, 'Match' payment_match_flag from {orders_dirty}")

ORACLES: dict[str, str] = {
    **CHECKS,
    "dq_rule_unique": report({"denormalized_orders": "dirty_facts", "customer_ltv": "ltv"}, ("unique",)),
    "dq_rule_not_null": report({**SOURCES, "denormalized_orders": "dirty_facts"}, ("not_null",)),
    "dq_rule_accepted_values": report(SOURCES, ("accepted_values",)),
    "dq_rule_expression": report(SOURCES, ("expression",)),
    "dq_gold_report": report(SOURCES, ("unique", "not_null", "accepted_values", "expression")),
}
