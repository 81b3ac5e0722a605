"""SQL texts that map the sample star schema onto the raw marketplace tables.

Both engines of the result check read the same texts (see FIXTURES.md):
`{name}` stands for a table, `SEC/HRS/DAYS(n)` for an interval, `TXT(ts)` for
the review date format and `TS` for a timestamp literal without zone.
"""

from __future__ import annotations

import re

# Lines of one order in a fixed order; the running number within the order is
# the item number.
NUMBERED_LINES = """
select l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate,
  cast(row_number() over(partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as bigint) item_no
from {lineitem}
"""

MAPPING: dict[str, str] = {
    "order_items": """
select concat('O', l_orderkey) order_id, item_no order_item_id, concat('P', l_partkey) product_id,
  concat('S', case when o_orderdate >= TS '2001-01-31' and l_suppkey % 5 < 2
                   then l_suppkey - l_suppkey % 5 + 2 else l_suppkey end, '-', l_partkey % 10) seller_id,
  l_shipdate shipping_limit_date, cast(l_extendedprice as decimal(18,2)) price,
  cast(cast(l_quantity as decimal(18,2)) * 0.5 as decimal(18,2)) freight_value
from {numbered_lines} join {orders} on l_orderkey = o_orderkey
""",
    "b_orders": """
select concat('O', o_orderkey) order_id, concat('C', o_orderkey) customer_id, st order_status,
  p order_purchase_timestamp,
  case when o_orderkey % 97 <> 0 then p + HRS(o_orderkey % 48) end order_approved_at,
  case when st not in ('delivered', 'shipped') then null when o_orderkey % 71 = 0 then p - HRS(1)
       else p + DAYS(2 + o_orderkey % 5) end order_delivered_carrier_date,
  case when st = 'delivered' then p + DAYS(4 + o_orderkey % 30) + HRS(o_orderkey % 24) end
    order_delivered_customer_date,
  cast(cast(o_orderdate as date) + 25 as date) order_estimated_delivery_date
from (select *, o_orderdate + SEC((o_orderkey * 7919) % 86400) p,
  case when o_orderstatus in ('F', 'P') then 'delivered' when o_orderkey % 10 = 0 then 'canceled'
       when o_orderkey % 10 = 1 then 'unavailable' when o_orderkey % 10 = 2 then 'processing'
       else 'shipped' end st from {orders}) o
""",
    "customers": """
select concat('C', o_orderkey) customer_id, concat('U', o_custkey) customer_unique_id,
  1000 + o_custkey % 900 customer_zip_code_prefix, replace(lower(n_name), '_', ' ') customer_city,
  concat('R', n_regionkey) customer_state
from {orders} join {customer} on o_custkey = c_custkey
join {nation} on n_nationkey = (c_nationkey + case when o_orderkey % 5 = 0 then 1 else 0 end) % 25
""",
    "products": """
select concat('P', p_partkey) product_id,
  case when p_partkey % 53 <> 0 then concat(lower(p_type), '_', split_part(p_name, ' ', 2)) end
    product_category_name,
  cast(length(p_name) as bigint) product_name_length, cast(p_size * 20 as bigint) product_description_length,
  1 + p_partkey % 5 product_photo_qty, cast(p_size * 100 as bigint) product_weight_g,
  cast(10 + p_size as bigint) product_length_cm, cast(5 + p_size as bigint) product_height_cm,
  cast(8 + p_size as bigint) product_width_cm
from {part} where p_partkey % 211 <> 0
""",
    "product_category_name_translation": """
select distinct product_category_name,
  concat(split_part(product_category_name, '_', 2), '_', split_part(product_category_name, '_', 1))
    product_category_name_english
from {products} where product_category_name is not null and product_category_name not like 'promo%'
""",
    "sellers": """
select concat('S', s_suppkey, '-', n) seller_id, 2000 + s_suppkey % 900 seller_zip_code_prefix,
  replace(lower(n_name), '_', ' ') seller_city, concat('R', n_regionkey) seller_state
from (select s_suppkey, s_nationkey, explode_ten(n) from {supplier}) s join {nation} on s_nationkey = n_nationkey
""",
    "order_payments": """
with k as (select order_id, sum(price + freight_value) cost from {order_items} group by order_id),
a as (select o_orderkey k, concat('O', o_orderkey) order_id,
  coalesce(cost, cast(o_totalprice as decimal(18,2))) + case when o_orderkey % 11 = 0 then 5 else 0 end amt,
  case left(o_orderpriority, 1) when '1' then 'credit_card' when '2' then 'credit_card' when '3' then 'boleto'
       when '4' then 'voucher' else 'debit_card' end ty,
  cast(left(o_orderpriority, 1) as bigint) ins
  from {orders} left join k on k.order_id = concat('O', o_orderkey) where o_orderkey % 13 <> 0)
select order_id, cast(1 as bigint) payment_sequential, ty payment_type, ins payment_installments,
  cast(case when k % 3 = 0 then amt - 10 else amt end as decimal(18,2)) payment_value from a
union all
select order_id, cast(2 as bigint), 'voucher', cast(1 as bigint), cast(10 as decimal(18,2)) from a where k % 3 = 0
""",
    "order_reviews": """
select concat('V', order_id, '-', order_item_id) review_id,
  case when order_item_id = 1 and order_id like '%77' then concat('X', order_id) else order_id end order_id,
  cast(1 + cast(freight_value * 2 as int) % 5 as bigint) review_score,
  cast(null as varchar(1)) review_commend_title, cast(null as varchar(1)) review_commend_message,
  TXT(shipping_limit_date) review_creation_date, TXT(shipping_limit_date + DAYS(2)) review_answer_timestamp
from {order_items} where order_item_id % 2 = 1
""",
    "geolocation": """
select cast(1000 + n_nationkey * 10 as bigint) geolocation_zip_code_prefix,
  cast(n_nationkey * 1.5 - 30 as double) geolocation_lat, cast(n_nationkey - 60 as double) geolocation_lng,
  replace(lower(n_name), '_', ' ') geolocation_city, concat('R', n_regionkey) geolocation_state
from {nation}
""",
}

DIALECTS: dict[str, list[tuple[str, str]]] = {
    "spark": [
        # Spark's lines carry the published id as their key (see sample.py).
        (r"concat\('O', l_orderkey\) order_id", "l_orderkey order_id"),
        (r"on l_orderkey = o_orderkey", "on l_orderkey = concat('O', o_orderkey)"),
        (r"SEC\((.*?\) % 86400)\)", r"make_dt_interval(0, 0, 0, \1)"),
        (r"HRS\((.*?)\)", r"make_dt_interval(0, cast(\1 as int), 0, 0)"),
        (r"DAYS\((.*?)\)", r"make_dt_interval(cast(\1 as int), 0, 0, 0)"),
        (r"TXT\((shipping_limit_date(?: \+ .*?\)\)?)?)\) review", r"date_format(\1, 'MM/dd/yyyy HH:mm') review"),
        (r"\bTS '", "timestamp_ntz '"),
        (r"explode_ten\(n\)", "explode(sequence(0, 9)) n"),
    ],
    "duckdb": [
        (r"SEC\((.*?\) % 86400)\)", r"to_seconds(\1)"),
        (r"HRS\((.*?)\)", r"to_hours(\1)"),
        (r"DAYS\((.*?)\)", r"to_days(cast(\1 as int))"),
        (r"TXT\((shipping_limit_date(?: \+ .*?\)\)?)?)\) review", r"strftime(\1, '%m/%d/%Y %H:%M') review"),
        (r"\bTS '", "timestamp '"),
        (r"explode_ten\(n\)", "unnest(range(10)) n"),
    ],
}


def in_dialect(text: str, dialect: str) -> str:
    for pattern, replacement in DIALECTS[dialect]:
        text = re.sub(pattern, replacement, text)
    return text

# Raw tables with planted faults for the key checks: some rows twice, some
# of the repeats without a customer.
DIRTY: dict[str, str] = {
    "orders_dirty": """
select * from {b_orders}
union all
select order_id, case when cast(substr(order_id, 2) as bigint) % 1000 = 0 then null else customer_id end customer_id,
  order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date
from {b_orders} where cast(substr(order_id, 2) as bigint) % 500 = 0
""",
    "products_dirty": """
select * from {products}
union all select * from {products} where cast(substr(product_id, 2) as bigint) % 100 = 0
""",
    # Amounts of three places, whose rounded values add up to something else.
    "items_thirds": """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  cast(price as decimal(24,6)) + cast(0.005 as decimal(24,6)) price,
  cast(freight_value as decimal(24,6)) + cast(0.004 as decimal(24,6)) freight_value
from {order_items}
""",
    "payments_thirds": """
select order_id, payment_sequential, payment_type, payment_installments,
  cast(payment_value as decimal(24,6)) + cast(0.005 as decimal(24,6)) payment_value
from {order_payments}
""",
}
