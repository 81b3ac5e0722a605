from __future__ import annotations

import pytest

from helpers import by, rows
from shopmart.operators import features, gold, star
from shopmart.operators.silver import Silver, denormalized_orders


def test_every_seller_gets_every_item_in_gold_but_not_in_star(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0, "p1", "s1").item("o1", 2, 20.0, "p1", "s2")
    bronze = shop.bronze()
    inflated = by(gold.seller_performance(Silver.from_bronze(bronze)), "seller_id")
    own = by(star.star_seller_performance(bronze), "seller_id")
    assert {s: inflated[s]["total_order_items_sold"] for s in ("s1", "s2")} == {"s1": 2, "s2": 2}
    assert inflated["s1"]["on_time_delivery_rate"] == 2.0
    assert [own[s]["total_revenue_contribution"] for s in ("s1", "s2")] == [10.0, 20.0]


def test_order_value_repeats_per_item_in_kpis(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).item("o1", 2, 10.0).item("o1", 3, 10.0, "p2")
    kpi = by(gold.sales_kpi(Silver.from_bronze(shop.bronze())), "product_category")
    assert kpi["Toys"]["total_sales"] == 60.0 and kpi["Toys"]["total_orders"] == 1
    assert kpi["Health Beauty"]["total_sales"] == 30.0


def test_one_day_customer_has_no_projection(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).order("o2", "2018-01-01", "u2").order("o3", "2018-01-11", "u2")
    shop.item("o2", 1, 10.01).item("o3", 1, 10.0).order("o4", "2018-01-01", "u3", status="canceled")
    ltv = by(gold.customer_ltv(Silver.from_bronze(shop.bronze())), "customer_unique_id")
    assert ltv["u1"]["predicted_ltv_6m_heuristic"] is None and "u3" not in ltv
    assert ltv["u2"]["historical_aov"] == 10.01  # 20.01 / 2, half away from zero
    assert ltv["u2"]["predicted_ltv_6m_heuristic"] == pytest.approx(10.01 * 2 / (10 / 30.4) * 6, abs=0.01)


def test_star_person_without_items_has_no_value(shop):
    shop.order("o1", "2018-01-01")
    bronze = shop.bronze()
    assert rows(gold.customer_ltv(Silver.from_bronze(bronze)))[0]["historical_ltv"] == 0.0
    assert rows(star.star_customer_ltv(bronze))[0]["historical_ltv"] is None


def test_orders_without_payment_are_not_in_the_payment_table(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).order("o2", "2018-01-01").item("o2", 1, 10.0)
    shop.payment("o2", 1, 4.0, "voucher").payment("o2", 2, 4.0, "voucher", 3)
    row = rows(gold.payment_behavior(Silver.from_bronze(shop.bronze())))[0]
    assert (row["total_dist_orders"], row["total_order_items"], row["total_gmv"]) == (1, 2, 20.0)
    assert (row["payment_missing_value"], row["total_installments"], row["payment_mismatch_rate"]) == (4.0, 4.0, 2.0)


def test_star_payment_table_multiplies_before_comparing(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).payment("o1", 1, 5.0).payment("o1", 2, 5.0)
    bronze = shop.bronze()
    assert rows(gold.payment_behavior(Silver.from_bronze(bronze)))[0]["mismatch_transactions_count"] == 0
    row = rows(star.star_payment_behavior(bronze))[0]
    assert row["payment_type"] == "credit_card" and row["mismatch_transactions_count"] == 2
    assert row["payment_missing_value"] == 20.0


def test_cohorts(shop):
    shop.order("o1", "2018-01-31").order("o2", "2018-02-01").order("o3", "2018-01-05", "u2").order("o4", "2018-09-01")
    for order in ("o1", "o2", "o3", "o4"):
        shop.item(order, 1, 1.0)
    got = by(gold.cohort_retention_all(Silver.from_bronze(shop.bronze())), "month_year", "retention_period")
    assert sorted(got) == [("Jan 2018", 0), ("Jan 2018", 1)]
    assert got[("Jan 2018", 1)]["retention_rate"] == 0.5 and got[("Jan 2018", 1)]["initial_cohort_size"] == 2


def test_product_cohort_starts_with_the_first_order_that_has_items(shop):
    shop.order("none", "2018-01-01").order("o1", "2018-03-01").item("o1", 2, 1.0, "p1").item("o1", 1, 1.0, "p2")
    got = by(gold.cohort_retention_product(Silver.from_bronze(shop.bronze())), "cohort_category_name")
    assert list(got) == ["Health Beauty"] and got["Health Beauty"]["month_year"] == "Mar 2018"


def test_product_cohort_needs_a_category(shop):
    shop.order("o1", "2018-03-01").item("o1", 1, 1.0, "unknown").order("o2", "2018-04-01").item("o2", 1, 1.0)
    assert rows(gold.cohort_retention_product(Silver.from_bronze(shop.bronze()))) == []


def test_order_summary_state_is_over_delivered_orders(shop):
    shop.order("o1", "2018-01-01", state="RJ", status="canceled").order("o2", "2018-02-01", state="SP")
    silver = Silver.from_bronze(shop.bronze())
    assert by(silver.orders, "order_id")["o2"]["primary_state"] == "RJ"
    summary = rows(gold.order_summary(silver))
    assert [r["primary_state"] for r in summary] == ["SP"] and summary[0]["primary_seller_id"] is None


def test_purchase_at_the_observation_time_is_in_no_window(shop):
    shop.order("last", "2018-07-31T10:00:00").order("edge", "2018-01-31T10:00:00").order("in", "2018-01-31T09:59:59")
    for order, value in (("last", 1.0), ("edge", 2.0), ("in", 4.0)):
        shop.item(order, 1, value).payment(order, 1, value)
    row = rows(features.ltv_features(Silver.from_bronze(shop.bronze())))[0]
    assert (row["total_orders"], row["total_spent"], row["ltv_6m"]) == (1, 4.0, 1.0)
    assert row["credit_pay_rate"] == row["payment_match_rate"] == 1.0


def test_six_months_before_month_end_is_clamped(shop, spark):
    shop.order("o1", "2018-08-31T00:00:00")
    observed = features.observation_time(Silver.from_bronze(shop.bronze()))
    assert str(spark.range(1).select(observed).first()[0]) == "2018-02-28 00:00:00"


BUILDS = [
    gold.sales_kpi,
    gold.customer_ltv,
    gold.seller_performance,
    gold.payment_behavior,
    gold.cohort_retention_all,
    gold.cohort_retention_product,
    gold.order_summary,
    features.ltv_features,
    features.ltv_target,
    features.churn_features_customer,
]


@pytest.mark.parametrize("build", BUILDS, ids=lambda b: b.__name__)
def test_nested_table_and_flat_parts_give_the_same_gold(build, spark, tmp_path_factory):
    from shopmart.session import cut_lineage
    from shopmart.sources.sample import sample_bronze

    bronze = sample_bronze(spark, "/root/testdata/sf0.001")
    if not hasattr(spark, "_nested_sample"):
        spark._nested_sample = cut_lineage(denormalized_orders(bronze))
    flat = build(Silver.from_bronze(bronze))
    nested = build(Silver.from_table(spark._nested_sample)).select(flat.columns)
    assert sorted(map(str, flat.collect())) == sorted(map(str, nested.collect()))


def test_variety_counts_products_and_categories_apart(shop):
    shop.product("p1", "garden")  # a product that is listed in two categories
    for i, order in enumerate(("o1", "o2", "o2")):
        shop.order(order, f"2018-01-0{i + 1}").payment(order, 1, 5.0)
    for n in range(1, 8):
        shop.item("o1", n, 1.0, f"p{n % 3}", f"s{1 + n % 2}")
    shop.order("end", "2018-12-01")
    got = {r["seller_id"]: r for r in rows(features.ltv_features(Silver.from_bronze(shop.bronze())))}
    assert {k: (r["unique_products_bought"], r["unique_categories_bought"]) for k, r in got.items()} == {
        "s1": (3, 3),
        "s2": (3, 3),
    }


def test_repeated_orders_count_once_flat_and_nested(shop):
    from shopmart.operators.silver import denormalized_orders

    shop.order("o1", "2018-01-01").item("o1", 1, 5.0).item("o1", 2, 5.0).payment("o1", 1, 10.0)
    bronze = shop.bronze()
    from dataclasses import replace

    bronze = replace(bronze, orders=bronze.orders.union(bronze.orders))
    for silver in (Silver.from_bronze(bronze), Silver.from_table(denormalized_orders(bronze))):
        assert rows(gold.sales_kpi(silver))[0]["total_orders"] == 1
        assert rows(gold.customer_ltv(silver))[0]["total_orders"] == 1
        assert rows(gold.payment_behavior(silver))[0]["total_dist_orders"] == 1
        row = rows(gold.seller_performance(silver))[0]
        assert row["total_order_items_sold"] == 8  # two sellers' items twice, as exploded rows
