from __future__ import annotations

import random

import pytest

from helpers import by, rows
from shopmart.operators import evaluation, models


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    data = []
    for i in range(400):
        label = int(rng.random() < 0.4)
        data.append((f"k{i}", label, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * label, 0.2))), 2)))
    return data, spark.createDataFrame(data, "k string, y int, s double").selectExpr("*", "int(s >= 0.5) as p").cache()


def test_metrics_with_ties(scored):
    data, df = scored
    got = rows(evaluation.metrics(df, "y", "s", "p"))[0]
    positive = [s for _, y, s in data if y]
    negative = [s for _, y, s in data if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in positive for b in negative)
    assert got["roc_auc"] == pytest.approx(wins / len(positive) / len(negative), abs=1e-6)
    precision_sum, before = 0.0, 0
    for t in sorted({s for *_, s in data}, reverse=True):
        tp = sum(s >= t for s in positive)
        precision_sum += (tp - before) / len(positive) * tp / sum(s >= t for *_, s in data)
        before = tp
    assert got["average_precision"] == pytest.approx(precision_sum, abs=1e-6)
    tp = sum(s >= 0.5 for s in positive)
    assert got["recall"] == pytest.approx(tp / len(positive))


def test_curves_end_at_one(scored):
    _, df = scored
    roc = rows(evaluation.roc_curve(df, "y", "s"))
    last = min((r for r in roc if r["threshold"] is not None), key=lambda r: r["threshold"])
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)
    pr = by(evaluation.pr_curve(df, "y", "s"), "threshold")
    assert pr[min(t for t in pr if t is not None)]["recall"] == 1.0
    assert (pr[None]["precision"], pr[None]["recall"]) == (1.0, 0.0)


def test_split_depends_on_the_key_only(scored):
    _, df = scored
    split = evaluation.train_test_split(df, "k")
    again = evaluation.train_test_split(df.repartition(7), "k")
    assert {(r["k"], r["split"]) for r in rows(split)} == {(r["k"], r["split"]) for r in rows(again)}
    share = sum(r["split"] == "test" for r in rows(split)) / 400
    assert 0.18 < share < 0.32


def test_stratified_split_keeps_class_shares(scored):
    _, df = scored
    got = rows(evaluation.stratified_split(df, "k", "y"))
    for label in (0, 1):
        members = [r for r in got if r["y"] == label]
        train = sum(r["stratified_split"] == "train" for r in members)
        assert train == pytest.approx(0.8 * len(members), abs=1.5)


def test_recalibration_is_taken_as_published(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.5,), (0.0,)], "p double")
    got = [r[0] for r in df.select(evaluation.recalibrated(F.col("p"), F.lit(4.0))).collect()]
    assert got == [0.8, 0.0]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    got = rows(evaluation.regression_metrics(df, "y", "p"))[0]
    assert got["mse"] == pytest.approx(2 / 3) and got["r2"] == pytest.approx(1 - 2 / 8)


@pytest.mark.parametrize("kind, weighted", [("decision_tree", False), ("logistic", False), ("boosted_trees", True)])
def test_classifiers_learn(spark, monkeypatch, kind, weighted):
    monkeypatch.setattr(models, "TREES", 5)
    rng = random.Random(3)
    data = [(f"k{i}", float(x := rng.random()), rng.random(), int(x > 0.6)) for i in range(300)]
    table = spark.createDataFrame(data, "k string, a double, b double, y int").cache()
    model, scored = models.train_and_score(table, ["a", "b"], "k", "y", kind, weighted)
    figures = rows(models.evaluate(scored, "y", kind))[0]
    assert figures["roc_auc"] > 0.9 and figures["model"] == kind
    if kind != "logistic":
        assert models.top_features(model, ["a", "b"], 1) == ["a"]


def test_forest_is_saved_and_loaded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "TREES", 3)
    rng = random.Random(3)
    data = [(f"k{i}", float(x := rng.random()), int(x > 0.5)) for i in range(100)]
    table = spark.createDataFrame(data, "k string, a double, y int").cache()
    model, scored = models.train_and_score(table, ["a"], "k", "y", "random_forest")
    models.save_model(model, str(tmp_path / "m"))
    again = models.score(models.load_random_forest(str(tmp_path / "m")), models.assemble(table, ["a"]), "k", "y")
    kept = models.drop_true_positives(again, "y", "prediction")
    assert again.count() == 100 and kept.where("y = 1 AND prediction = 1").count() == 0
    assert rows(models.compare_importances({"forest": model}, ["a"]))[0]["forest"] == 1.0


def test_close_scores_stay_apart(spark):
    from shopmart.operators import evaluation

    scored = spark.createDataFrame(
        [(1, 0.90004, 1), (0, 0.90001, 1), (1, 0.50002, 1), (0, 0.50001, 1)], "y int, s double, hit int"
    )
    row = evaluation.metrics(scored, "y", "s", "hit").first()
    assert (row["roc_auc"], row["average_precision"]) == (0.75, 0.833333)
    assert evaluation.roc_curve(scored, "y", "s").count() == 5
    assert evaluation.train_test_split(scored.withColumn("k", scored["s"].cast("string")), "k", 1.0).where("split = 'test'").count() == 4
