"""Gold tables in SQL, written out over the exploded rows."""

from __future__ import annotations

import oracles.silver  # noqa: F401 - its parts are used here
from oracles.compose import part, query

part("delivered", "select * from {facts} where order_status = 'delivered'")
part(
    "kpi",
    """
select i.product_category, t.order_status, t.payment_match_flag, t.customer_state, t.customer_city,
  cast(sum(t.calculated_order_cost) as double) total_sales,
  count(distinct t.customer_unique_id) total_customers, count(distinct t.order_id) total_orders,
  cast(sum(t.num_early_delivery_days) as double) total_early_delivery_days,
  cast(sum(t.is_delivered_on_time) as bigint) total_on_time_delivery,
  cast(sum(t.review_score) as bigint) total_review_score
from {facts} t join {items} i using (order_id) group by 1, 2, 3, 4, 5
""",
)
part(
    "ltv_base",
    """
select customer_unique_id, primary_state, count(distinct order_id) total_orders,
  cast(sum(calculated_order_cost) as double) spent,
  date_diff('day', min(cast(order_purchase_timestamp as date)), max(cast(order_purchase_timestamp as date))) span_days
from {delivered} group by 1, 2
""",
)


def ltv_columns(base: str) -> str:
    return f"""
select customer_unique_id, primary_state, cast(span_days as int) days_since_first_purchase, total_orders,
  spent historical_ltv, aov historical_aov,
  RND(aov * (DIV(total_orders, nullif(cast(span_days as double), 0) / cast(30.4 as double)) * 6), 2)
    predicted_ltv_6m_heuristic,
  RND(spent * cast(0.25 as double), 2) historical_profit_contribution
from (select *, RND(DIV(spent, total_orders), 2) aov from {base})
"""


part("ltv", ltv_columns("{ltv_base}"))
part(
    "seller_perf",
    """
select s.seller_id, s.seller_state, i.product_category, count(*) total_order_items_sold,
  cast(cast(sum(i.price) as decimal(38,2)) as double) total_revenue_contribution,
  RND(DIV(sum(t.is_delivered_on_time), count(distinct t.order_id)), 4) on_time_delivery_rate,
  RND(DIV(sum(t.review_score), count(t.review_score)), 2) average_review_score
from {delivered} t join {order_sellers} s using (order_id) join {items} i using (order_id) group by 1, 2, 3
""",
)
part(
    "pay_behavior",
    """
select p.payment_type, t.order_status, i.product_category, count(distinct t.order_id) total_dist_orders,
  count(*) total_order_items, cast(sum(t.calculated_order_cost) as double) total_gmv,
  cast(sum(t.calculated_order_cost - t.total_payment_value) as double) payment_missing_value,
  cast(sum(p.payment_installments) as double) total_installments,
  count(*) filter (t.payment_match_flag <> 'Match') mismatch_transactions_count,
  RND(DIV(count(*) filter (t.payment_match_flag <> 'Match'), count(distinct t.order_id)), 4) payment_mismatch_rate,
  cast(sum(t.review_score) as double) total_review_score
from {facts} t join {items} i using (order_id) join {payments} p using (order_id) group by 1, 2, 3
""",
)


def retention(source: str, keys: str = "") -> str:
    """Retention rows from (person, cohort month, purchase month, keys) rows."""
    on = "".join(f" and a.{k} = b.{k}" for k in keys.split())
    lead = "".join(f"{k}, " for k in keys.split())
    counts = f"""
(select {lead}cohort_month, date_diff('month', cohort_month, purchase_month) retention_period,
  count(distinct customer_unique_id) retained_customers from {source} group by all)"""
    return f"""
select {"".join(f"a.{k}, " for k in keys.split())}a.cohort_month, strftime(a.cohort_month, '%b %Y') month_year,
  a.retention_period, a.retained_customers, b.retained_customers initial_cohort_size,
  DIV(a.retained_customers, b.retained_customers) retention_rate
from {counts} a join {counts} b on a.cohort_month = b.cohort_month{on} and b.retention_period = 0
where a.retention_period between 0 and 6
"""


part(
    "months_all",
    """
select customer_unique_id, cast(date_trunc('month', order_purchase_timestamp) as date) purchase_month,
  cast(date_trunc('month', min(order_purchase_timestamp) over (partition by customer_unique_id)) as date) cohort_month
from {delivered}
""",
)
part("cohorts_all", retention("{months_all}"))
part(
    "first_buys",
    """
select distinct customer_unique_id,
  cast(date_trunc('month', min(order_purchase_timestamp) over (partition by customer_unique_id)) as date) cohort_month,
  first_value(product_category) over (partition by customer_unique_id
    order by order_purchase_timestamp, order_item_id, order_id) cohort_category_name
from {delivered} join {items} using (order_id)
""",
)
part(
    "months_product",
    """
select customer_unique_id, cohort_category_name, cohort_month,
  cast(date_trunc('month', order_purchase_timestamp) as date) purchase_month
from {delivered} join {first_buys} using (customer_unique_id)
""",
)
part("cohorts_product", retention("{months_product}", "cohort_category_name"))
part(
    "summary",
    """
select order_id, order_status, cast(order_purchase_timestamp as date) purchase_date, customer_unique_id,
  customer_city, customer_state,
  first_value(customer_state) over (partition by customer_unique_id order by order_purchase_timestamp, order_id)
    primary_state,
  cast(calculated_order_cost as double) order_value, cast(total_payment_value as double) total_payment_value,
  payment_match_flag, s.seller_id primary_seller_id, is_delivered_on_time,
  cast(date_diff('day', cast(order_approved_at as date), cast(order_delivered_customer_date as date)) as int)
    num_delivery_days,
  cast(num_early_delivery_days as double) num_early_delivery_days,
  (select max(cast(order_purchase_timestamp as date)) from {facts}) current_day,
  cast(c.quantity as int) total_items_quantity
from {delivered} left join {costs} c using (order_id)
left join (select order_id, arg_min(seller_id, order_item_id) seller_id from {order_sellers} group by order_id) s
  using (order_id)
""",
)

ORACLES: dict[str, str] = {
    "gold_sales_kpi": query("select * from {kpi}"),
    "gold_customer_ltv": query("select * from {ltv}"),
    "gold_seller_performance": query("select * from {seller_perf}"),
    "gold_payment_behavior": query("select * from {pay_behavior}"),
    "gold_cohort_retention_all": query("select * from {cohorts_all}"),
    "gold_cohort_retention_product": query("select * from {cohorts_product}"),
    "gold_order_summary": query("select * from {summary}"),
    "gold_customer_metrics": query("""
select customer_unique_id, primary_state, count(distinct order_id) total_orders,
  cast(sum(cast(order_value as decimal(18,2))) as double) total_spent, min(purchase_date) first_purchase_date,
  max(purchase_date) last_purchase_date,
  cast(date_diff('day', max(purchase_date), date '2018-09-03') as int) recency_days
from {summary} group by 1, 2"""),
}
