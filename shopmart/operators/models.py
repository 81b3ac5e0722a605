"""Churn classifiers and lifetime-value regressors on Spark MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.functions.columns import count_where, ratio
from shopmart.operators import evaluation
from shopmart.session import shared_dir

# Model settings.
SEED = evaluation.SEED
DEPTH = 5
TREES = 100
STEP = 0.1
TEST_SHARE = 0.25
TOP_CHURN = 5
TOP_LTV = 6

WEIGHT = "class_weight"
ROUNDING = 1e-9
CHANCE = 0.5  # area under the ROC curve


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the vector column `features`; a missing number counts as 0."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(filled)


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Weighs positives with negatives / positives, everything else with 1."""
    counts = df.agg(count_where(F.col(label) == 0).alias("n"), count_where(F.col(label) == 1).alias("p"))
    weight = counts.select(F.try_divide(F.col("n").cast("double"), F.col("p").cast("double"))).scalar()
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.coalesce(weight, F.lit(1.0))).otherwise(1.0))


def classifier(kind: str, label: str, weighted: bool = False):
    """An untrained classifier; boosted trees optionally weigh the classes."""
    common = {"featuresCol": "features", "labelCol": label}
    if weighted:
        common["weightCol"] = WEIGHT
    if kind == "decision_tree":
        return DecisionTreeClassifier(maxDepth=DEPTH, seed=SEED, **common)
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, **common)
    if kind == "boosted_trees":
        return GBTClassifier(maxIter=TREES, stepSize=STEP, maxDepth=DEPTH, seed=SEED, **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=TREES, **common)
    raise ValueError(kind)


def regressor(kind: str, label: str):
    common = {"featuresCol": "features", "labelCol": label, "maxDepth": DEPTH, "seed": SEED}
    if kind == "random_forest":
        return RandomForestRegressor(numTrees=TREES, **common)
    if kind == "boosted_trees":
        return GBTRegressor(maxIter=TREES, stepSize=STEP, **common)
    raise ValueError(kind)


def positive_probability() -> Column:
    return F.get(vector_to_array(F.col("probability")), F.lit(1))


def train(
    table: DataFrame,
    columns: Sequence[str],
    key: str,
    label: str,
    kind: str,
    weighted: bool = False,
    stratified: bool = False,
) -> tuple[Model, DataFrame]:
    """Fits on the training keys; the model, and all rows with their vectors and `split`.

    `table` should be stored: every tree level reads it. Three quarters of the
    keys train, or with `stratified` four fifths of every class.
    """
    vectors = assemble(table, columns)
    if stratified:
        split = evaluation.stratified_split(vectors, key, label, name="split")
    else:
        split = evaluation.train_test_split(vectors, key, TEST_SHARE)
    rows = split.where("split = 'train'")
    if weighted:
        rows = with_class_weight(rows, label)
    return without_summary(classifier(kind, label, weighted).fit(rows)), split


def without_summary(model: Model) -> Model:
    """The model as it is read back from storage.

    A fresh one may keep a summary of its training and with it the session,
    which cannot be sent to tasks once a query of the session was observed.
    """
    path = f"{shared_dir(SparkSession.active())}/fitted-{uuid4().hex}"
    save_model(model, path)
    return type(model).load(path)


def train_and_score(
    table: DataFrame,
    columns: Sequence[str],
    key: str,
    label: str,
    kind: str,
    weighted: bool = False,
    stratified: bool = False,
) -> tuple[Model, DataFrame]:
    """Fits on the training keys and scores the test keys."""
    model, split = train(table, columns, key, label, kind, weighted, stratified)
    return model, score(model, split.where("split = 'test'"), key, label)


def score(model: Model, vectors: DataFrame, key: str, label: str) -> DataFrame:
    """Key, label, class at 0.5 and probability of the positive class."""
    scored = model.transform(vectors)
    return scored.select(
        key,
        label,
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability().alias("probability"),
    )


def evaluate(scored: DataFrame, label: str, name: str) -> DataFrame:
    figures = evaluation.metrics(scored, label, "probability", "prediction")
    return figures.select(F.lit(name).alias("model"), "*")


def fits_class(prediction: Column, probability: Column) -> Column:
    """Whether a probability lies in 0..1 and on the side of 0.5 that its class says."""
    side = F.when(prediction == 1, probability >= 0.5 - ROUNDING).otherwise(probability <= 0.5 + ROUNDING)
    return probability.between(0, 1) & side


def check(scored: DataFrame, trained_on: DataFrame, label: str, name: str) -> DataFrame:
    """Size of a scored test set and whether its scores, classes and figures hold together, one row.

    `figures_agree` counts precision and recall anew. `learned` tells whether the model ranks the rows it was
    trained on better than chance; on the test rows it need not, if the inputs say nothing about the label.
    """
    hit = count_where((F.col(label) == 1) & (F.col("prediction") == 1))
    called, positive = count_where(F.col("prediction") == 1), count_where(F.col(label) == 1)
    figures = evaluate(scored, label, name)

    def agrees(column: str, own: Column) -> Column:
        given = figures.select(column).scalar()
        return F.coalesce(F.abs(given - own) < ROUNDING, given.isNull() & own.isNull())

    counts = scored.agg(
        F.count("*").alias("test_rows"),
        positive.alias("positives"),
        F.bool_and(fits_class(F.col("prediction"), F.col("probability"))).alias("scores_valid"),
        hit.alias("hit"),
        called.alias("called"),
    )
    return counts.select(
        F.lit(name).alias("model"),
        "test_rows",
        "positives",
        "scores_valid",
        (
            agrees("precision", ratio(F.col("hit"), F.col("called")))
            & agrees("recall", ratio(F.col("hit"), F.col("positives")))
        ).alias("figures_agree"),
        (evaluate(trained_on, label, name).select("roc_auc").scalar() > CHANCE).alias("learned"),
    )


def recalibrated_figures(scored: DataFrame, label: str, weight: Column) -> DataFrame:
    """Mean, ROC area and average precision of the probabilities of a weighted model after the correction."""
    calibrated = evaluation.recalibrated(F.col("probability"), weight)
    fair = scored.withColumn("probability", calibrated)
    means = fair.agg(F.avg("probability").alias("mean_calibrated"), F.avg(label).alias("positive_share"))
    figures = evaluate(fair, label, "calibrated")
    return means.select(
        "*", *[figures.select(c).scalar().alias(c) for c in ("roc_auc", "average_precision")]
    )


def importances(model: Model, columns: Sequence[str], name: str) -> DataFrame:
    """(feature, score) rows, one per model input."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, f"feature string, {name} double")


def compare_importances(models: dict[str, Model], columns: Sequence[str]) -> DataFrame:
    """Importances of several models side by side, ranked by the first."""
    tables = [importances(m, columns, name) for name, m in models.items()]
    joined = reduce(lambda a, b: a.join(b, "feature"), tables)
    return joined.orderBy(F.col(next(iter(models))).desc(), "feature")


def top_features(model: Model, columns: Sequence[str], k: int) -> list[str]:
    """The k most important inputs; the list is as long as the model is wide."""
    ranked = sorted(zip(columns, model.featureImportances.toArray()), key=lambda pair: (-pair[1], pair[0]))
    return [c for c, _ in ranked[:k]]


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_random_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def drop_true_positives(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows the churn model did not rightly call churned; the base of the value model."""
    return scored.where(~((F.col(label) == 1) & (F.col(prediction) == 1)))


def train_regressor(
    table: DataFrame, columns: Sequence[str], key: str, label: str, kind: str
) -> tuple[Model, DataFrame]:
    split = evaluation.train_test_split(assemble(table, columns), key, TEST_SHARE)
    model = regressor(kind, label).fit(split.where("split = 'train'"))
    return model, model.transform(split.where("split = 'test'")).select(key, label, "prediction")
