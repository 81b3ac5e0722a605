"""Raw tables and silver stages in SQL."""

from __future__ import annotations

from oracles.compose import part, query
from shopmart.sources.sample_mapping import MAPPING, NUMBERED_LINES, in_dialect

# Driver tables keep their names; raw tables become parts.
part("numbered_lines", NUMBERED_LINES)
for _name, _text in MAPPING.items():
    part(_name, in_dialect(_text, "duckdb"))


def title(x: str) -> str:
    """Words of the sample data are separated by spaces only."""
    words = f"list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, ' ')"


part(
    "labelled",
    f"""
select p.product_id, p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
  {title("replace(coalesce(t.product_category_name_english, p.product_category_name), '_', ' ')")} product_category
from {{products}} p left join {{product_category_name_translation}} t using (product_category_name)
""",
)
part(
    "items",
    """
select i.order_id, i.order_item_id, i.product_id, i.price, i.freight_value, l.product_category,
  l.product_weight_g, l.product_length_cm, l.product_height_cm, l.product_width_cm
from {order_items} i left join {labelled} l using (product_id)
""",
)
part(
    "payments",
    f"""
select order_id, payment_sequential, {title("replace(payment_type, '_', ' ')")} payment_type,
  payment_installments, payment_value
from {{order_payments}}
""",
)
part(
    "order_sellers",
    f"""
select i.order_id, i.order_item_id, s.seller_id, s.seller_zip_code_prefix,
  {title("s.seller_city")} seller_city, s.seller_state
from {{order_items}} i left join {{sellers}} s on s.seller_id = i.seller_id
""",
)
part(
    "core",
    f"""
select o.order_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
  o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
  c.customer_unique_id, c.customer_zip_code_prefix, {title("c.customer_city")} customer_city, c.customer_state,
  first_value(c.customer_state) over (partition by c.customer_unique_id
    order by o.order_purchase_timestamp, o.order_id) primary_state
from {{b_orders}} o left join {{customers}} c on c.customer_id = o.customer_id
""",
)
part(
    "review",
    """
select order_id, review_score, created review_cre_datetime, answered review_ans_datetime
from (select *, strptime(review_creation_date, '%m/%d/%Y %H:%M') created,
        strptime(review_answer_timestamp, '%m/%d/%Y %H:%M') answered from {order_reviews})
qualify row_number() over (partition by order_id order by created desc, review_id desc) = 1
""",
)
part(
    "costs",
    """
select order_id, cast(sum(price + freight_value) as decimal(18,2)) cost, count(*) quantity
from {order_items} group by order_id
""",
)
part(
    "paid",
    "select order_id, cast(sum(payment_value) as decimal(18,2)) paid from {order_payments} group by order_id",
)
part(
    "facts",
    """
select a.*, coalesce(b.cost, 0) calculated_order_cost, coalesce(c.paid, 0) total_payment_value,
  case when abs(coalesce(b.cost, 0) - coalesce(c.paid, 0)) < 0.1 then 'Match'
       when a.order_status in ('delivered', 'shipped') and c.paid is null then 'Missing Payment'
       else 'Discrepancy' end payment_match_flag,
  case when a.order_delivered_customer_date <= cast(a.order_estimated_delivery_date as timestamp) then 1 else 0 end
    is_delivered_on_time,
  cast(RND(date_diff('hour', a.order_delivered_customer_date, cast(a.order_estimated_delivery_date as timestamp))
    / 24.0, 2) as decimal(18,2)) num_early_delivery_days,
  case when a.order_purchase_timestamp > a.order_delivered_carrier_date
         or a.order_approved_at > a.order_delivered_carrier_date
         or a.order_delivered_carrier_date > a.order_delivered_customer_date then 'invalid' else 'valid' end
    date_validity,
  e.review_score, e.review_cre_datetime, e.review_ans_datetime
from {core} a left join {costs} b using (order_id) left join {paid} c using (order_id)
left join {review} e using (order_id)
""",
)
part(
    "item_lists",
    """
select order_id, count(*) items, string_agg(concat_ws('|', order_item_id, product_id, price::double, freight_value::double,
  product_category, product_weight_g, product_length_cm, product_height_cm, product_width_cm), ';'
  order by order_item_id) item_list
from {items} group by order_id
""",
)
part(
    "payment_lists",
    """
select order_id, string_agg(concat_ws('|', payment_sequential, payment_type, payment_installments, payment_value::double),
  ';' order by payment_sequential) payment_list
from {payments} group by order_id
""",
)
part(
    "seller_lists",
    """
select order_id, string_agg(concat_ws('|', seller_id, seller_zip_code_prefix, seller_city, seller_state), ';'
  order by order_item_id) seller_list
from {order_sellers} group by order_id
""",
)
part(
    "flat_facts",
    """
select * replace (cast(calculated_order_cost as double) as calculated_order_cost,
  cast(total_payment_value as double) as total_payment_value,
  cast(num_early_delivery_days as double) as num_early_delivery_days) from {facts}
""",
)

ITEMS_AGG = """
select order_id, cast(cost as double) calculated_order_cost, quantity total_items_quantity, item_list
from {costs} join {item_lists} using (order_id)"""
PAYMENTS_AGG = """
select order_id, cast(paid as double) total_payment_value, payment_list
from {paid} join {payment_lists} using (order_id)"""
DENORMALIZED = """
select f.*, item_list, payment_list, seller_list from {flat_facts} f
left join {item_lists} using (order_id) left join {payment_lists} using (order_id)
left join {seller_lists} using (order_id)"""

ORACLES: dict[str, str] = {
    "silver_items_agg": query(ITEMS_AGG),
    "silver_payments_agg": query(PAYMENTS_AGG),
    "silver_sellers_agg": query("select order_id, seller_list from {seller_lists}"),
    "silver_core_order": query("select * from {core}"),
    "silver_latest_review": query("select * from {review}"),
    "silver_payment_match": query("""
select order_id, calculated_order_cost, total_payment_value, payment_match_flag from {flat_facts}"""),
    "silver_delivery_flags": query("""
select order_id, is_delivered_on_time, num_early_delivery_days, date_validity from {flat_facts}"""),
    "silver_denormalized_orders": query(DENORMALIZED),
    "silver_items_exploded": query("""
select * replace (cast(price as double) as price, cast(freight_value as double) as freight_value)
from {items} where order_id in (select order_id from {b_orders})"""),
    "silver_payments_exploded": query("""
select * replace (cast(payment_value as double) as payment_value)
from {payments} where order_id in (select order_id from {b_orders})"""),
    "silver_sellers_exploded": query("""
select * from {order_sellers} where order_id in (select order_id from {b_orders})"""),
    "bronze_csv_roundtrip": query("""
select * replace (cast(price as double) as price, cast(freight_value as double) as freight_value)
from {order_items}"""),
    "bronze_csv_quarantine": query("""
select case when order_item_id % 7 in (3, 5, 6) then 'malformed' when order_item_id % 7 = 4 then 'missing' end reason,
  case when order_item_id % 7 <> 4 then order_id end order_id, order_item_id, product_id,
  case when order_item_id % 7 not in (3, 4, 5, 6) then cast(price as double) end price from {order_items}"""),
    "silver_append_nested": query(DENORMALIZED + """
union all by name select null order_id where exists (select 1 from {b_orders})"""),
    "silver_incremental_append": query("""
select * from {flat_facts} union all by name select null order_id where exists (select 1 from {b_orders})"""),
}
