from __future__ import annotations

from itertools import product

from helpers import at, by, rows
from shopmart.operators import profiling, quality, rules
from shopmart.operators.silver import Silver, denormalized_orders
from shopmart.plans import catalog
from shopmart.session import cut_lineage


def test_invalid_dates_uses_five_rules(shop):
    # Bought after approval is a fault in the raw check, not in silver.
    shop.order("early", "2018-01-03", approved=at("2018-01-01"), arrived=at("2018-01-05"))
    shop.order("before", "2018-01-03", arrived=at("2018-01-01")).order("fine", "2018-01-03")
    assert sorted(r["order_id"] for r in rows(quality.invalid_dates(shop.bronze()))) == ["before", "early"]


def test_moved_pairs_equal_the_self_join(shop, spark):
    customers = []
    for i, (person, zip_code, city) in enumerate(product(["a", "b", None], [1, 2, None], ["x", "y", None])):
        for copy in range(1 + i % 3):
            customers.append((f"c{i}-{copy}", person, zip_code, city, "S"))
    shop.rows["customers"] = customers
    got = {r["customer_id"]: r["moved_pairs"] for r in rows(quality.customer_moved(shop.bronze()))}

    def differs(a, b):
        return a is not None and b is not None and a != b

    expected = {}
    for c in customers:
        n = sum(
            c[1] is not None and c[1] == d[1] and (differs(c[2], d[2]) or differs(c[3], d[3])) for d in customers
        )
        if n:
            expected[c[0]] = n
    assert got == expected


def test_latest_of_several_reviews(shop):
    shop.review("r1", "o1", 1, "1/2/2018 3:04").review("r2", "o1", 5, "1/3/2018 3:04").review("r3", "o2", 4, "1/3/2018 3:04")
    assert [r["review_score"] for r in rows(quality.multi_review_latest(shop.bronze()))] == [5]
    assert sorted(r["review_id"] for r in rows(quality.multi_review_orders(shop.bronze()))) == ["r1", "r2"]
    # Two reviews without an order leave one empty row, as an outer join does.
    shop.review("r4", None, 1, "1/3/2018 3:04").review("r5", None, 2, "1/3/2018 3:04")
    found = rows(quality.multi_review_orders(shop.bronze()))
    assert sorted(str(r["review_id"]) for r in found) == ["None", "r1", "r2"]
    latest = by(quality.multi_review_latest(shop.bronze()), "order_id")
    assert latest[None]["review_score"] is None and latest["o1"]["review_score"] == 5


def test_rules_report_failures_once_per_rule(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, None)], "k string, v int")
    report = rules.apply_rules(
        df,
        "t",
        [
            rules.unique("k"),
            *rules.not_null("k"),
            rules.accepted_values("k", "b"),
            rules.expression("v", "v >= 0"),
        ],
    )
    assert {(r["rule"], r["failing_rows"]) for r in rows(report)} == {
        ("unique", 1),
        ("not_null", 1),
        ("accepted_values", 2),
        ("v >= 0", 1),
    }


def test_describe_is_exact(spark):
    import numpy as np

    samples = {"a": [3.0, 1.0, 2.0, 2.0, 10.0, -1.0], "b": [5.0, 5.0, 5.0, 5.0, 7.0, None]}
    df = spark.createDataFrame(list(zip(*samples.values())), "a double, b double")
    wide = spark.range(20011).selectExpr("(id * 7919 % 20011) * 1.0 a", "if(id % 3 = 0, null, id % 5) * 1.0 b")
    for frame in (df, wide):
        got = by(profiling.describe(frame, ["a", "b"]), "column")
        for column in ("a", "b"):
            values = [r[0] for r in frame.select(column).collect() if r[0] is not None]
            values = np.array(values, dtype=float)
            row = got[column]
            assert row["count"] == len(values)
            for name, q in profiling.QUARTILES:
                assert abs(row[name] - np.quantile(values, q)) < 1e-9
            assert abs(row["std"] - values.std(ddof=1)) < 1e-6
            assert (row["min"], row["max"]) == (values.min(), values.max())


def test_report_derives_flat_parts_once(shop, monkeypatch):
    shop.order("o1", "2018-01-01").item("o1", 1, 5.0).item("o1", 2, 2.5, "gone", "gone").payment("o1", 1, 7.5)
    shop.order("o2", "2018-02-01", person=None, status="canceled").item("o2", 1, 1.0, "p2", "s2").payment("o2", 1, 4.0, "boleto")
    shop.order("o3", "2018-02-03").item(None, 1, 1.0).review("r1", "o1", 4, "1/2/2018 3:04")
    bronze, plans, store = shop.bronze(), [], rules.store_checked

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, *rest)

    monkeypatch.setattr(rules, "store_checked", noted)

    def report(silver):
        return sorted(tuple(r.values()) for r in rows(catalog.gold_report(silver)))

    flat = report(Silver.from_bronze(bronze))
    # Every checked table starts from files, none from the raw rows.
    assert len(plans) == 6 and not any("RDD" in p for p in plans)
    assert flat == report(Silver.from_table(cut_lineage(denormalized_orders(bronze)))) and any(r[3] for r in flat)


def test_reports_are_written_one_table_at_a_time(spark, shop, monkeypatch):
    """The disk holds the shuffles of one table, not of all that a report is on."""
    from shopmart.operators.silver import Silver, denormalized_orders
    from shopmart.plans import catalog

    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).payment("o1", 1, 10.0).review("r1", "o1", 5, "1/2/2018 3:04")
    silver = Silver.from_table(catalog.cut_lineage(denormalized_orders(shop.bronze())))
    monkeypatch.setattr(catalog, "nested_silver", lambda bronze: silver)
    monkeypatch.setattr(catalog, "sample_bronze", lambda *a, **b: None)
    running, written, write = [], [], catalog.cut_lineage

    def one(df):
        assert not running
        running.append(1)
        out = write(df)
        written.append(running.pop())
        return out

    monkeypatch.setattr(catalog, "cut_lineage", one)
    report = catalog.QUERIES["dq_rule_expression"](spark, "none")
    assert len(written) == 6 and report.count() == 23 and "Exchange" not in report._jdf.queryExecution().executedPlan().toString()
    assert catalog.gold_report(silver).count() == sum(map(len, catalog.rules.RULES.values())) and len(written) == 12
