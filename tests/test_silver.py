from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import at, by, day, rows
from shopmart.functions.columns import hour_boundaries, not_in, title_case
from shopmart.operators import silver
from shopmart.operators.silver import Silver, denormalized_orders


def facts(shop):
    return by(Silver.from_bronze(shop.bronze()).orders, "order_id")


@pytest.mark.parametrize(
    "text, title",
    [
        ("MOGI-GUACU", "Mogi-Guacu"),
        ("santa barbara d'oeste", "Santa Barbara D'oeste"),
        ("a.b c", "A.B C"),
        ("rio  de janeiro", "Rio  De Janeiro"),
        ("x_y", "X_Y"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, text, title):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(title_case(F.col("x"))).first()[0] == title


def test_untranslated_category_keeps_its_name(shop):
    shop.translation("health_beauty", "beauty_health").order("o1", "2018-01-01").item("o1", 1, 5.0).item(
        "o1", 2, 5.0, "p2"
    ).item("o1", 3, 5.0, "unknown")
    items = by(Silver.from_bronze(shop.bronze()).items, "order_item_id")
    assert [items[i]["product_category"] for i in (1, 2, 3)] == ["Toys", "Beauty Health", None]


def test_first_state_breaks_ties_by_order(shop):
    shop.order("o2", "2018-01-01", state="RJ").order("o1", "2018-01-01", state="SP").order("o3", "2017-05-01", "u2")
    got = facts(shop)
    assert got["o1"]["primary_state"] == got["o2"]["primary_state"] == "SP"


def test_latest_review_is_kept(shop):
    shop.order("o1", "2018-01-01").review("r1", "o1", 1, "1/2/2018 3:04").review("r2", "o1", 5, "12/02/2017 23:59")
    shop.review("r0", "o1", 3, "1/2/2018 3:04")
    got = facts(shop)["o1"]
    assert got["review_score"] == 1 and got["review_cre_datetime"] == at("2018-01-02T03:04")


def test_payment_match_order_of_cases(shop):
    shop.order("tiny", "2018-01-01").item("tiny", 1, 0.05)
    shop.order("unpaid", "2018-01-01").item("unpaid", 1, 50.0)
    shop.order("off", "2018-01-01").item("off", 1, 50.0).payment("off", 1, 49.9)
    shop.order("near", "2018-01-01").item("near", 1, 50.0).payment("near", 1, 49.91)
    shop.order("canceled", "2018-01-01", status="canceled").item("canceled", 1, 50.0)
    flags = {k: v["payment_match_flag"] for k, v in facts(shop).items()}
    assert flags == {
        "tiny": "Match",
        "unpaid": "Missing Payment",
        "off": "Discrepancy",
        "near": "Match",
        "canceled": "Discrepancy",
    }


def test_promised_midnight_is_the_limit(shop):
    promised = day("2018-02-01")
    shop.order("in", "2018-01-01", promised=promised, arrived=at("2018-02-01T00:00:00"))
    shop.order("late", "2018-01-01", promised=promised, arrived=at("2018-02-01T00:00:01"))
    shop.order("open", "2018-01-01", promised=promised, status="shipped")
    got = facts(shop)
    assert [got[k]["is_delivered_on_time"] for k in ("in", "late", "open")] == [1, 0, 0]
    assert got["open"]["num_early_delivery_days"] is None


def test_hours_are_boundaries(spark):
    df = spark.createDataFrame([(day("2018-02-02"), at("2018-02-01T22:59:00"))], "d date, t timestamp_ntz")
    assert df.select(hour_boundaries(F.col("d"), F.col("t"))).first()[0] == 2


def test_date_validity_uses_three_rules_and_skips_nulls(shop):
    shop.order("null", "2018-01-01", status="shipped")
    shop.order("bad", "2018-01-03", shipped=at("2018-01-02"), arrived=at("2018-01-05"))
    # Bought after approval is no fault here, only in the raw check.
    shop.order("early", "2018-01-03", approved=at("2018-01-01"), arrived=at("2018-01-05"))
    got = facts(shop)
    assert [got[k]["date_validity"] for k in ("null", "bad", "early")] == ["valid", "invalid", "valid"]


def test_order_without_children_has_zero_sums_and_no_arrays(shop):
    shop.order("o1", "2018-01-01", status="canceled")
    row = rows(denormalized_orders(shop.bronze()))[0]
    assert row["calculated_order_cost"] == 0 and row["total_payment_value"] == 0
    assert row["order_items_array"] is None and row["payments_array"] is None


def nested(table):
    return by(table.drop("_ingest_ts"), "order_id")


def test_sellers_repeat_per_item_in_item_order(shop):
    shop.order("o1", "2018-01-01").item("o1", 2, 1.0, seller="s1").item("o1", 1, 1.0, seller="s2")
    shop.item("o1", 3, 1.0, seller="gone")
    row = nested(denormalized_orders(shop.bronze()))["o1"]
    assert [s["seller_id"] for s in row["sellers_array"]] == ["s2", "s1", None]
    assert [i["order_item_id"] for i in row["order_items_array"]] == [1, 2, 3]


def test_all_children_stay_whatever_their_numbers(shop):
    shop.order("big", "2018-01-01").order("small", "2018-01-02")
    for number in (0, 1, None, 7, 7, 10**12):
        shop.item("big", number, 2.0, seller="s1" if number else "s2")
    shop.item("small", 3, 1.0).item("small", 7, 1.0, seller="gone").payment("big", 0, 36.0).payment("small", 1, 1.0)
    table = denormalized_orders(shop.bronze())
    got = nested(table)
    assert sorted(got) == ["big", "small"]
    assert len(got["big"]["order_items_array"]) == len(got["big"]["sellers_array"]) == 6
    assert got["big"]["calculated_order_cost"] == 12 and got["big"]["payments_array"][0]["payment_value"] == 36
    assert [s["order_item_id"] for s in got["small"]["sellers_array"]] == [3, 7]
    back, flat = Silver.from_table(table), Silver.from_bronze(shop.bronze())
    for part in ("items", "payments", "sellers"):
        columns = getattr(flat, part).columns
        assert sorted(map(str, getattr(back, part).select(columns).collect())) == sorted(
            map(str, getattr(flat, part).collect())
        )


def test_sums_are_rounded_once(shop):
    shop.order("o1", "2018-01-01")
    for number, price in enumerate((0.005, 0.005, 0.004)):
        shop.item("o1", number, price)
    assert float(facts(shop)["o1"]["calculated_order_cost"]) == 0.01


def test_not_in_follows_sql_nulls(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")

    def kept(values):
        return sorted(str(r[0]) for r in not_in(left, "k", spark.createDataFrame(values, "k string")).collect())

    assert kept([("a",)]) == ["b"]
    assert kept([("a",), (None,)]) == []
    assert kept([]) == ["None", "a", "b"]
