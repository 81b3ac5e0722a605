"""Exact quartiles by narrowing, and rules counted while tables are written."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import by, rows
from shopmart.operators import models, profiling, rules
from shopmart.plans import medallion
from shopmart.session import cut_lineage

SHAPES = {
    "spread": lambda r: r.uniform(-5, 5),
    "few": lambda r: float(r.randint(0, 2)),
    "halves": lambda r: 0.0 if r.random() < 0.5 else 1.0,
    "heavy": lambda r: 7.0 if r.random() < 0.6 else r.uniform(0, 10),
    "edges": lambda r: r.choice([0.0, 1.0]) if r.random() < 0.8 else r.random(),
    "gaps": lambda r: None if r.random() < 0.3 else r.expovariate(1),
    "none": lambda r: None,
    "same": lambda r: 3.0,
}


@pytest.mark.parametrize("held", [100_000, 50, 3])
def test_quartiles_are_exact(spark, monkeypatch, held):
    monkeypatch.setattr(profiling, "EXACT_VALUES", held)
    r = random.Random(held)
    data = [tuple(shape(r) for shape in SHAPES.values()) for _ in range(2501)]
    df = cut_lineage(spark.createDataFrame(data, ", ".join(f"{c} double" for c in SHAPES)).repartition(5))
    got = by(profiling.describe(df, list(SHAPES)), "column")
    for i, column in enumerate(SHAPES):
        values = np.array([row[i] for row in data if row[i] is not None])
        row = got[column]
        assert row["count"] == len(values)
        if not len(values):
            assert [row[q] for q in ("mean", "std", "min", "q25", "median", "q75", "max")] == [None] * 7
            continue
        want = np.quantile(values, [0.25, 0.5, 0.75])
        assert np.allclose([row["q25"], row["median"], row["q75"]], want, rtol=0, atol=1e-12)
        assert (row["min"], row["max"]) == (values.min(), values.max())
        assert np.isclose(row["mean"], values.mean()) and np.isclose(row["std"], values.std(ddof=1), atol=1e-12)


def test_no_rows(spark):
    row = rows(profiling.describe(spark.createDataFrame([], "a double"), ["a"]))[0]
    assert row["count"] == 0 and row["median"] is None


def test_one_row(spark):
    row = rows(profiling.describe(spark.createDataFrame([(2.0,)], "a double"), ["a"]))[0]
    assert (row["q25"], row["median"], row["q75"], row["std"]) == (2.0, 2.0, 2.0, None)


def test_rules_counted_while_writing_agree_with_a_second_read(spark):
    data = [("a", 1, 5.0, 1.0, 1.0, None), ("a", 0, -1.0, None, 1.0, 2.0), (None, None, 1.0, 1.0, -3.0, 2.0)]
    names = ["customer_unique_id", "total_orders", "historical_ltv", "historical_aov", "predicted_ltv_6m_heuristic", "historical_profit_contribution"]
    df = spark.createDataFrame(data, "{} string, {} bigint, {} double, {} double, {} double, {} double".format(*names))
    stored, report = rules.store_checked(df, "customer_ltv", cut_lineage)
    want = rules.apply_rules(df, "customer_ltv", rules.RULES["customer_ltv"])
    assert sorted(map(str, rows(report))) == sorted(map(str, rows(want)))
    assert sum(r["failing_rows"] for r in rows(report)) > 5 and stored.count() == 3


def test_reports_of_stored_gold(spark, shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).payment("o1", 1, 10.0)
    reports = {}
    stored = medallion.build(spark, shop.bronze(), reports=reports)
    assert set(reports) == set(rules.RULES) - {"denormalized_orders"}
    again = by(medallion.quality_report(stored), "table", "column", "rule")
    for name, report in reports.items():
        for r in rows(report):
            assert r == again[name, r["column"], r["rule"]]


def test_models_score_in_a_session_that_was_observed(spark):
    seen = Observation("any")
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    table = cut_lineage(spark.range(80).selectExpr("concat('k', id) key", "cast(id % 7 as double) x", "cast(id % 2 as int) y"))
    for kind in ("logistic", "decision_tree"):
        assert models.train_and_score(table, ["x"], "key", "y", kind)[1].count() > 0
