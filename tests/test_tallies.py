"""Children counted inside the rows of the nested table, and the plans this gives."""

from __future__ import annotations

import random
import re
import time
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shopmart.operators import features, gold
from shopmart.operators.silver import Silver, core_order, denormalized_orders
from shopmart.operators.tallies import Tally, unfolded, with_tally
from shopmart.session import cut_lineage

ROW = "id int, kids array<struct<a: string, b: bigint, price: decimal(24,6), n: bigint>>"
BOTH = Tally("kids", ("a", "b"), "count", {"price": "price", "total": "n"}, {"priced": "price"})


def counted(kids, keys):
    groups = defaultdict(list)
    for kid in kids or ():
        groups[tuple(kid["ab".index(k)] for k in keys)].append(kid)
    out = []
    for key, own in groups.items():
        prices, ns = [k[2] for k in own if k[2] is not None], [k[3] for k in own if k[3] is not None]
        out.append((*key, len(own), sum(prices) if prices else None, sum(ns) if ns else None, len(prices)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keys", [("a", "b"), ("b",), ()])
def test_histograms_match_counting(spark, keys):
    r = random.Random(4)
    none = lambda v: None if r.random() < 0.2 else v

    def kid():
        return (none(r.choice("xyz")), none(r.randint(0, 2)), none(Decimal(r.randint(0, 9999)) / 1000), none(r.randint(0, 9)))

    data = [(0, None), (1, []), (2, [(None, None, None, None)])]
    data += [(i, [kid() for _ in range(r.randint(0, 25))]) for i in range(3, 60)]
    tally = Tally("kids", keys, BOTH.n, BOTH.sums, BOTH.known)
    got = with_tally(spark.createDataFrame(data, ROW), "kids", tally, "found").collect()
    for row, (_, kids) in zip(sorted(got, key=lambda x: x["id"]), data):
        assert sorted((tuple(x) for x in row["found"] or ()), key=str) == counted(kids, keys)


def test_very_many_children_of_one_order(spark):
    i = F.col("id")
    kid = F.struct((i % 20_000).cast("string").alias("a"), (i % 2).alias("b"), F.lit(1).cast("decimal(24,6)").alias("price"), i.alias("n"))
    many = cut_lineage(spark.range(80_000).select(kid.alias("kid")).groupBy().agg(F.collect_list("kid").alias("kids")))
    tally = Tally("kids", ("a",), "count", {"price": "price"})
    start = time.perf_counter()
    found = unfolded(with_tally(many, "kids", tally, "found"), tally, "found")
    assert found.agg(F.count("*"), F.min("count"), F.sum("price")).first()[:] == (20_000, 4, 80_000)
    assert time.perf_counter() - start < 20  # a step that starts anew for each child would take hours


BUILT = {}


@pytest.fixture
def nested(shop):
    """Flat and stored nested silver, built once."""
    if BUILT:
        return BUILT["forms"]
    r = random.Random(1)
    for i in range(30):
        shop.order(f"o{i}", f"2018-0{1 + i % 8}-0{1 + i % 9}", person=f"u{i % 7}", status="delivered" if i % 5 else "canceled")
        for number in range(r.randint(0, 4)):
            shop.item(f"o{i}", number + 1, r.randint(1, 9) + 0.005, r.choice(["p1", "p2", "gone"]), r.choice(["s1", "s2", "gone"]))
        for number in range(r.randint(0, 3)):
            shop.payment(f"o{i}", number + 1, 1.005, r.choice(["boleto", "credit_card"]), r.randint(1, 3))
    bronze = shop.bronze()
    flat = Silver.from_bronze(bronze).stored()
    BUILT["forms"] = (flat, Silver.from_table(cut_lineage(denormalized_orders(bronze))))
    return BUILT["forms"]


TABLES = {
    "sales_kpi": gold.sales_kpi,
    "seller_performance": gold.seller_performance,
    "payment_behavior": gold.payment_behavior,
    "cohort_retention_product": gold.cohort_retention_product,
    "order_summary": gold.order_summary,
    "ltv_features": features.ltv_features,
    "churn_features": features.churn_features_customer,
}


@pytest.mark.parametrize("name", TABLES)
def test_both_forms_agree(nested, name):
    flat, table = (sorted(map(str, rows(TABLES[name](s)))) for s in nested)
    assert flat == table and flat


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sales_kpi", "seller_performance", "payment_behavior"])
def test_nested_gold_reads_once_and_never_meets_by_order(nested, name):
    plan = plan_of(TABLES[name](nested[1]))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "hashpartitioning(order_id" not in plan


@pytest.mark.parametrize("name", ["order_summary", "ltv_features", "cohort_retention_product", "churn_features"])
def test_nested_tables_are_not_joined_by_order(nested, name):
    assert "hashpartitioning(order_id" not in plan_of(TABLES[name](nested[1]))


def test_silver_is_one_shuffle_by_order(spark, shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 1.0).payment("o1", 1, 1.0).review("r", "o1", 5, "1/2/2018 3:04")
    plan = plan_of(denormalized_orders(shop.bronze()))
    assert plan.count("Exchange hashpartitioning(order_id") == 1


def test_rows_are_collected_before_arrays_are_made_of_them(spark, shop):
    """What is sorted by order are the rows as shuffled; the elements of the arrays are wider and would spill."""
    plan = plan_of(denormalized_orders(shop.order("o1", "2018-01-01").item("o1", 1, 1.0).bronze())).split("\n")
    met = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(order_id" in x)
    assert "ObjectHashAggregate" in plan[met - 1] and "transform(" not in plan[met - 1]


def test_flat_and_nested_totals_are_rounded_once(shop):
    shop.order("o1", "2018-01-01")
    for number, value in enumerate((0.005, 0.005, 0.004)):
        shop.payment("o1", number, value).item("o1", number, value)
    bronze = shop.bronze()
    for orders in (Silver.from_bronze(bronze).orders, denormalized_orders(bronze)):
        row = rows(orders)[0]
        assert float(row["total_payment_value"]) == float(row["calculated_order_cost"]) == 0.01
    for silver in (Silver.from_bronze(bronze), Silver.from_table(denormalized_orders(bronze))):
        assert rows(gold.seller_performance(silver))[0]["total_revenue_contribution"] == 0.04


def test_orders_without_id_have_no_children(spark, shop):
    shop.order(None, "2018-01-01").order("o1", "2018-01-02").item(None, 1, 5.0).item("o1", 1, 2.0).item("gone", 1, 3.0)
    got = {r["order_id"]: r for r in rows(denormalized_orders(shop.bronze()))}
    assert set(got) == {None, "o1"} and got[None]["order_items_array"] is None
    assert float(got[None]["calculated_order_cost"]) == 0 and float(got["o1"]["calculated_order_cost"]) == 2


def test_observation_time_runs_no_job(nested):
    tracker = nested[1].table.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    features.ltv_target(nested[1])
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_lines_are_numbered_in_one_shuffle_and_meet_products_once(spark):
    from shopmart.sources.sample import sample_bronze

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = plan_of(denormalized_orders(sample_bronze(spark, "/root/testdata/sf0.001")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Once numbered for items and reviews, once without numbers for the costs that payments are made of.
    numbered = [x for x in plan.split("\n") if "Exchange hashpartitioning(l_orderkey" in x and "Reused" not in x]
    assert len(numbered) == 2
    by_product = [x for x in plan.split("\n") if "Exchange hashpartitioning(product_id" in x]
    assert len(by_product) == 2  # items and products


def plan_of_all_joins(spark, df) -> list[str]:
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return plan_of(df()).split("\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_costs_of_payments_share_the_shuffle_of_the_lines(spark):
    from shopmart.sources.sample import sample_bronze

    folder = "/root/testdata/sf0.001"
    plan = plan_of_all_joins(spark, lambda: denormalized_orders(sample_bronze(spark, folder, shared=True)))
    numbered = [x for x in plan if "Exchange hashpartitioning(l_orderkey" in x and "Reused" not in x]
    assert len(numbered) == 1
    own, shared = (sample_bronze(spark, folder, shared=s) for s in (False, True))
    for part in ("order_items", "order_payments", "order_reviews"):
        a, b = getattr(own, part), getattr(shared, part)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_customers_not_orders_are_moved_by_person(spark, shop):
    bronze = shop.order("o1", "2018-01-01").bronze()
    plan = plan_of_all_joins(spark, lambda: core_order(bronze.orders, bronze.customers))
    moved = [plan[i + 1] for i, x in enumerate(plan) if "Exchange hashpartitioning(customer_unique_id" in x]
    assert len(moved) == 2 and not any("order_status" in x for x in moved)


def test_first_state_with_customers_listed_twice_or_unknown(shop):
    shop.order("o1", "2018-01-02", person="u1", state="SP").order("o2", "2018-01-01", person="u1", state="RJ")
    shop.order("o3", "2018-01-03", person=None, state="MG").order("o4", "2018-01-04")
    shop.rows["customers"] = [x for x in shop.rows["customers"] if x[0] != "c-o4"] + [("c-o1", "u2", 1, "x", "BA"), ("none", "u3", 1, "x", "AC")]
    bronze = shop.bronze()
    core = core_order(bronze.orders, bronze.customers)
    found = {(r["order_id"], r["customer_unique_id"], r["primary_state"]) for r in rows(core)}
    assert found == {("o1", "u1", "RJ"), ("o1", "u2", "BA"), ("o2", "u1", "RJ"), ("o3", None, None), ("o4", None, None)}
    assert core.columns[:2] == ["customer_unique_id", "order_id"] and core.count() == 5


def test_the_union_carries_ids_once_and_amounts_as_stored(shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 2.0).payment("o1", 2, 1.25).payment("o1", 1, 0.75)
    table = denormalized_orders(shop.bronze())
    plan = plan_of(table).split("\n")
    met = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(order_id" in x)
    parts = [x for x in plan[met:] if "Project [order_id" in x and "struct(" in x]
    assert len(parts) == 4 and not any("order_id, order_id" in x or "decimal(24,6)" in x for x in parts)
    row = rows(table)[0]
    assert [(p["payment_sequential"], float(p["payment_value"])) for p in row["payments_array"]] == [(1, 0.75), (2, 1.25)]
    assert dict(table.dtypes)["payments_array"].endswith("payment_value:decimal(24,6)>>") and row["order_id"] == "o1"


def test_the_nested_table_is_stored_with_zstd(shop):
    from shopmart.plans.catalog import nested_silver

    files = nested_silver(shop.order("o1", "2018-01-01").item("o1", 1, 2.0).bronze()).table.inputFiles()
    assert files and all(x.endswith(".zstd.parquet") for x in files)


def test_only_ids_of_repeated_orders_are_counted(nested, shop):
    from dataclasses import replace

    plan = plan_of(gold.seller_performance(nested[1]))
    assert "order_copies" in plan
    shop.order("o1", "2018-01-01").item("o1", 1, 5.0).item("o1", 2, 5.0, "p2", "s2").payment("o1", 1, 10.0)
    shop.order("o2", "2018-01-02").item("o2", 1, 7.0).payment("o2", 1, 7.0).payment("o2", 2, 1.0, "boleto")
    shop.order("o3", "2018-01-02").item("o3", 1, 7.0)
    bronze = shop.bronze()
    other = bronze.orders.where("order_id <> 'o3'").withColumn("order_status", F.expr("if(order_id = 'o1', 'canceled', order_status)"))
    bronze = replace(bronze, orders=bronze.orders.union(other).union(other))
    table = denormalized_orders(bronze)
    assert {(r["order_id"], r["order_copies"]) for r in rows(table)} == {("o1", 3), ("o2", 3), ("o3", 1)}
    forms = [Silver.from_bronze(bronze), Silver.from_table(table), Silver.from_table(table.drop("order_copies"))]
    for build in (gold.sales_kpi, gold.seller_performance, gold.payment_behavior):
        first, *others = (sorted(map(str, rows(build(s)))) for s in forms)
        assert others == [first, first] and first


def test_products_and_sellers_listed_twice_repeat_elements_only(shop):
    shop.product("p1", "garden").seller("s1", "MG").order("o1", "2018-01-01").item("o1", 1, 5.0).item("o1", 2, 2.0, "p2", "s2")
    shop.item("o1", 3, 1.0, "gone", "gone").item(None, 1, 9.0)
    bronze = shop.bronze()
    row = rows(denormalized_orders(bronze))[0]
    assert [(i["order_item_id"], i["product_category"]) for i in row["order_items_array"]] == [
        (1, "Garden"), (1, "Toys"), (2, "Health Beauty"), (3, None),
    ]
    assert [(x["order_item_id"], x["seller_id"], x["seller_state"]) for x in row["sellers_array"]] == [
        (1, "s1", "MG"), (1, "s1", "SP"), (2, "s2", "RJ"), (3, None, None),
    ]
    assert float(row["calculated_order_cost"]) == 8


def test_flat_children_of_other_orders_are_left_out_before_they_move(spark):
    from shopmart.sources.sample import sample_bronze

    folder = "/root/testdata/sf0.001"
    flat = lambda: Silver.from_bronze(sample_bronze(spark, folder, shared=True))
    for build in (features.ltv_features, gold.seller_performance):
        plan = plan_of_all_joins(spark, lambda: build(flat()))
        moved = [i for i, x in enumerate(plan) if re.search(r"Exchange hashpartitioning\((product_id|item_seller)", x)]
        assert sum(any("LeftSemi" in x for x in plan[i : i + 12]) for i in moved) >= 2
        # Lines move by order once; whatever is joined or grouped by order later on finds them there.
        assert sum("Exchange hashpartitioning(l_orderkey" in x and "Reused" not in x for x in plan) == 1


def test_flat_features_of_orders_and_customers_stored_twice(shop):
    shop.order("o0", "2017-01-01").order("o1", "2018-01-01").order("o2", "2018-01-02").order("o3", "2018-12-31", status="canceled")
    for o in ("o0", "o1", "o2"):
        shop.item(o, 1, 5.0).item(o, 2, 3.0, "p2", "s2").payment(o, 1, 8.0)
    shop.item(None, 1, 9.0).payment(None, 1, 9.0).product("p1", "garden")
    shop.rows["orders"] += [shop.rows["orders"][1]]
    shop.rows["customers"] += [shop.rows["customers"][1]]
    bronze = shop.bronze()
    flat, nested = (Silver.from_bronze(bronze), Silver.from_table(denormalized_orders(bronze)))
    first, second = (sorted(map(str, rows(features.ltv_features(s)))) for s in (flat, nested))
    assert first == second and len(first) == 2
