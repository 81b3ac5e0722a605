"""Gold tables from the raw tables by joins, in SQL."""

from __future__ import annotations

import oracles.silver  # noqa: F401 - its parts are used here
from oracles.compose import part, query
from oracles.gold import ltv_columns, retention
from oracles.silver import title

part(
    "star_orders",
    f"""
select o.*, c.customer_unique_id, {title("c.customer_city")} customer_city, c.customer_state
from {{b_orders}} o join {{customers}} c using (customer_id)
""",
)
part(
    "star_ltv_orders",
    """
select *, (select sum(price + freight_value) from {order_items} i where i.order_id = o.order_id) cost,
  first_value(customer_state) over (partition by customer_unique_id order by order_purchase_timestamp, order_id)
    primary_state
from {star_orders} o
""",
)
part(
    "star_ltv_base",
    """
select customer_unique_id, primary_state, count(distinct order_id) total_orders, cast(sum(cost) as double) spent,
  date_diff('day', min(cast(order_purchase_timestamp as date)), max(cast(order_purchase_timestamp as date))) span_days
from {star_ltv_orders} where order_status = 'delivered' group by 1, 2
""",
)
part(
    "star_totals",
    """
select o.order_id, o.order_status, sum(i.price + i.freight_value) cost, sum(p.payment_value) paid
from {b_orders} o left join {order_items} i using (order_id) left join {order_payments} p using (order_id)
group by 1, 2
""",
)
part(
    "star_pay",
    """
select p.payment_type, t.order_status, i.product_category, count(distinct t.order_id) total_dist_orders,
  count(*) total_order_items, cast(sum(t.cost) as double) total_gmv,
  cast(sum(t.cost - t.paid) as double) payment_missing_value,
  cast(sum(p.payment_installments) as double) total_installments,
  count(*) filter (abs(coalesce(t.cost, 0) - coalesce(t.paid, 0)) >= 0.1) mismatch_transactions_count,
  RND(DIV(count(*) filter (abs(coalesce(t.cost, 0) - coalesce(t.paid, 0)) >= 0.1), count(distinct t.order_id)), 4)
    payment_mismatch_rate,
  cast(sum(r.review_score) as double) total_review_score
from {star_totals} t join {items} i using (order_id) join {order_payments} p using (order_id)
left join {review} r using (order_id) group by 1, 2, 3
""",
)
part(
    "star_sellers",
    """
select s.seller_id, s.seller_state, i.product_category, count(*) total_order_items_sold,
  cast(cast(sum(i.price) as decimal(38,2)) as double) total_revenue_contribution,
  RND(DIV(count(*) filter (t.order_delivered_customer_date <= cast(t.order_estimated_delivery_date as timestamp)),
    count(distinct t.order_id)), 4) on_time_delivery_rate,
  RND(DIV(sum(r.review_score), count(r.review_score)), 2) average_review_score
from {b_orders} t join {items} i using (order_id)
join {order_items} own on own.order_id = i.order_id and own.order_item_id = i.order_item_id
join {sellers} s on s.seller_id = own.seller_id
left join {review} r on r.order_id = t.order_id
where t.order_status = 'delivered' group by 1, 2, 3
""",
)
part("star_delivered", "select * from {star_orders} where order_status = 'delivered'")
part(
    "star_months",
    """
select customer_unique_id, cast(date_trunc('month', order_purchase_timestamp) as date) purchase_month,
  cast(date_trunc('month', min(order_purchase_timestamp) over (partition by customer_unique_id)) as date) cohort_month
from {star_delivered}
""",
)
part(
    "star_first",
    """
select distinct customer_unique_id,
  cast(date_trunc('month', min(order_purchase_timestamp) over (partition by customer_unique_id)) as date) cohort_month,
  first_value(product_category) over (partition by customer_unique_id
    order by order_purchase_timestamp, order_item_id, order_id) cohort_category_name
from {star_delivered} join {items} using (order_id)
""",
)
part(
    "star_product_months",
    """
select customer_unique_id, cohort_category_name, cohort_month,
  cast(date_trunc('month', order_purchase_timestamp) as date) purchase_month
from {star_delivered} join {star_first} using (customer_unique_id)
""",
)

ORACLES: dict[str, str] = {
    "star_customer_ltv": query(ltv_columns("{star_ltv_base}")),
    "star_payment_behavior": query("select * from {star_pay}"),
    "star_seller_performance": query("select * from {star_sellers}"),
    "star_sales_kpi": query("select * from {kpi}"),
    "star_cohort_retention_all": query(retention("{star_months}")),
    "star_cohort_retention_product": query(retention("{star_product_months}", "cohort_category_name")),
}
