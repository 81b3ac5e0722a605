"""Stored tree models as column expressions.

A stored decision tree, forest or boosted ensemble is read back as the rows of
its nodes and written out as nested CASE expressions over plain columns, so that
scoring needs neither the model class nor feature vectors and is a plain
projection of a query. Only the nodes pass the driver, whose number the depth
and the number of trees bound.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class names in the metadata of stored models.
TREE, FOREST, BOOSTED = "DecisionTreeClassificationModel", "RandomForestClassificationModel", "GBTClassificationModel"
LEAF = -1  # child number of a node without children


def _metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def _nodes(spark: SparkSession, path: str, kind: str) -> dict[int, dict[int, object]]:
    """Nodes by tree and number."""
    data = spark.read.parquet(f"{path}/data")
    rows = data.select(F.lit(0).alias("tree"), F.struct("*").alias("node")) if kind == TREE else data.select(
        F.col("treeID").alias("tree"), F.col("nodeData").alias("node")
    )
    trees: dict[int, dict[int, object]] = {}
    for row in rows.collect():
        trees.setdefault(row["tree"], {})[row["node"]["id"]] = row["node"]
    return trees


def _case(nodes: dict[int, object], at: int, columns: Sequence[str], leaf) -> str:
    """The subtree below a node as SQL; a missing number counts as 0, as in training."""
    node = nodes[at]
    if node["leftChild"] == LEAF:
        return leaf(node)
    split = node["split"]
    if split["numCategories"] != -1:
        raise ValueError("splits on categories are not supported")
    name = "`" + columns[split["featureIndex"]].replace("`", "``") + "`"
    limit = f"{float(split['leftCategoriesOrThreshold'][0])!r}D"
    left, right = (_case(nodes, node[side], columns, leaf) for side in ("leftChild", "rightChild"))
    return f"CASE WHEN coalesce(CAST({name} AS DOUBLE), 0D) <= {limit} THEN {left} ELSE {right} END"


def _share(node) -> str:
    """Share of the positive class in a leaf."""
    stats = list(node["impurityStats"])
    return f"{stats[1] / sum(stats)!r}D" if sum(stats) else "0D"


def _added(terms: Sequence[str]) -> Column:
    """A sum in the order of the trees, over an array: as one expression it would be too long to be compiled."""
    return F.aggregate(F.array(*map(F.expr, terms)), F.lit(0.0), lambda total, term: total + term)


def scoring_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[Column, Column]:
    """Class and probability of the positive class of a stored binary tree model over `columns`, its inputs in order."""
    meta = _metadata(spark, path)
    kind = meta["class"].rsplit(".", 1)[-1]
    trees = _nodes(spark, path, kind)
    if kind == BOOSTED:
        weighted = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight")
        weights = {r["tree"]: r["weight"] for r in weighted.select("tree", "weight").collect()}
        terms = [
            f"{float(weights[t])!r}D * {_case(n, 0, columns, lambda node: repr(float(node['prediction'])) + 'D')}"
            for t, n in sorted(trees.items())
        ]
        margin = _added(terms)
        return (margin > 0).cast("int"), 1 / (1 + F.exp(-2 * margin))
    if kind not in (TREE, FOREST):
        raise ValueError(f"no expression for {kind}")
    terms = [_case(n, 0, columns, _share) for _, n in sorted(trees.items())]
    probability = _added(terms) / F.lit(float(len(terms)))
    return (probability > 0.5).cast("int"), probability


def score_stored(df: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """`df` with `prediction` and `probability` of a stored model."""
    prediction, probability = scoring_columns(df.sparkSession, path, columns)
    return df.withColumn("probability", probability).withColumn("prediction", prediction)
