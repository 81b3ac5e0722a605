"""Splits, class weights and evaluation of scored rows.

Curves and areas are exact: scores are neither rounded nor sampled. Distinct
scores are dealt out by range, summed per task, and every task starts its
running sums from the totals of the tasks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmart.functions.columns import count_where, ratio
from shopmart.session import cut_lineage

SEED = 6199
THRESHOLD = 0.5
HEX = 16  # digits of the hash, 64 bits
BUCKET_HEX = 4  # leading digits by which hashes are counted


def key_hash(key: Column, seed: int = SEED) -> Column:
    """64 bits as hex text; depends on the key alone, not on partitions."""
    return F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), key)), 1, HEX)


def train_test_split(df: DataFrame, key: str, test_share: float = 0.25, seed: int = SEED) -> DataFrame:
    """Adds `split`: 'test' for about `test_share` of the keys, else 'train'."""
    cut = round(test_share * 16**HEX)
    is_test = F.lit(True) if cut >= 16**HEX else key_hash(F.col(key), seed) < format(max(cut, 0), f"0{HEX}x")
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def stratified_split(
    df: DataFrame, key: str, label: str, train_share: float = 0.8, name: str = "stratified_split"
) -> DataFrame:
    """Adds a split with the same share of every class; rows without a label are left out.

    The rows of a class are counted per leading digits of the hash, at most
    65,536 counts a class. They tell the bucket in which the wanted share is
    reached; only the rows of that bucket are ranked by their whole hash.
    """
    df = df.where(F.col(label).isNotNull())
    full = key_hash(F.col(key))
    hashes = df.select(F.col(label).alias("class"), full.alias("hash"), F.substring(full, 1, BUCKET_HEX).alias("bucket"))
    counts = hashes.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("class").orderBy("bucket")
    whole = Window.partitionBy("class")
    wanted = F.lit(train_share) * F.sum("n").over(whole)
    reached = counts.select("class", "bucket", (F.sum("n").over(upto) - F.col("n")).alias("before"), wanted.alias("wanted"))
    cut_bucket = reached.where(F.col("before") < F.col("wanted")).groupBy("class").agg(
        F.max_by(F.struct("bucket", "before", "wanted"), "bucket").alias("cut")
    )
    # Broadcasts: one row per class; a shuffle by class would use a task per class.
    inside = hashes.join(F.broadcast(cut_bucket), "class").where(F.col("bucket") == F.col("cut.bucket"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("hash"))
    cuts = (
        inside.withColumn("rank", rank)
        .where(F.col("cut.before") + F.col("rank") >= F.col("cut.wanted"))
        .groupBy("class")
        .agg(F.min("hash").alias("cut"))
    )
    marked = df.join(F.broadcast(cuts), F.col(label) == F.col("class"), "left")
    return marked.withColumn(name, F.when(full <= F.col("cut"), "train").otherwise("test")).drop("class", "cut")


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negative and positive rows and the weight that balances them."""
    negative, positive = count_where(F.col(label) == 0), count_where(F.col(label) == 1)
    return df.agg(
        negative.alias("negative"),
        positive.alias("positive"),
        ratio(negative, positive).alias("imbalance_ratio"),
        ratio(positive, negative).alias("positive_per_negative"),
    )


def confusion_matrix(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("rows")
    )


def score_table(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: rows of both classes, at it and at or above it."""
    counts = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        count_where(F.col(label) == 1).alias("positives"), count_where(F.col(label) == 0).alias("negatives")
    )
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(
        counts.repartitionByRange(parts, F.col("threshold").desc()).withColumn("part", F.spark_partition_id())
    )
    # One row per part.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = dealt.groupBy("part").agg(F.sum("positives").alias("tp"), F.sum("negatives").alias("fp"))
    starts = totals.select(
        "part",
        F.coalesce(F.sum("tp").over(earlier), F.lit(0)).alias("tp_before"),
        F.coalesce(F.sum("fp").over(earlier), F.lit(0)).alias("fp_before"),
        F.sum("tp").over(whole).alias("p"),
        F.sum("fp").over(whole).alias("n"),
    )
    down = Window.partitionBy("part").orderBy(F.col("threshold").desc())
    return dealt.join(F.broadcast(starts), "part").select(
        "threshold",
        "positives",
        "negatives",
        (F.col("tp_before") + F.sum("positives").over(down)).alias("tp"),
        (F.col("fp_before") + F.sum("negatives").over(down)).alias("fp"),
        "p",
        "n",
    )


def _with_end(curve: DataFrame, **end: float) -> DataFrame:
    """The curve and the point above all thresholds."""
    point = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(k) for k, v in end.items()]
    )
    return curve.unionByName(point)


def roc_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    curve = score_table(scored, label, score).select(
        "threshold", ratio(F.col("fp"), F.col("n")).alias("fpr"), ratio(F.col("tp"), F.col("p")).alias("tpr")
    )
    return _with_end(curve, fpr=0.0, tpr=0.0)


def pr_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    curve = score_table(scored, label, score).select(
        "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("p")).alias("recall"),
    )
    return _with_end(curve, precision=1.0, recall=0.0)


def metrics(scored: DataFrame, label: str, score: str, prediction: str) -> DataFrame:
    """Precision, recall, F1, area under ROC, average precision and area under the PR curve, one row.

    The ROC area counts pairs of classes, ties half; average precision is the
    step sum of precision over gained recall, the PR area its trapezoids.
    """
    hit = (F.col(label) == 1) & (F.col(prediction) == 1)
    tp, called = count_where(hit), count_where(F.col(prediction) == 1)
    positive = count_where(F.col(label) == 1)
    rates = scored.agg(
        ratio(tp, called).alias("precision"),
        ratio(tp, positive).alias("recall"),
        ratio(tp * 2, called + positive).alias("f1"),
    )
    wide = "decimal(38,0)"
    above = F.col("tp") - F.col("positives")
    pairs = F.sum(F.col("negatives").cast(wide) * (above * 2 + F.col("positives")).cast("decimal(19,0)"))
    all_pairs = F.max("p").cast("double") * F.max("n").cast("double") * 2
    steps = F.sum(ratio(F.col("positives"), F.col("p")) * ratio(F.col("tp"), F.col("tp") + F.col("fp")))
    higher = above + F.col("fp") - F.col("negatives")
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    precision_above = F.coalesce(ratio(above, higher), F.lit(1.0))
    trapezoids = F.sum(ratio(F.col("positives"), F.col("p")) * (precision + precision_above) / 2)
    areas = score_table(scored, label, score).agg(
        F.round(ratio(pairs, all_pairs), 6).alias("roc_auc"),
        F.round(steps, 6).alias("average_precision"),
        F.round(trapezoids, 6).alias("pr_auc"),
    )
    # Both sides are one row.
    return rates.withColumn("one", F.lit(1)).join(areas.withColumn("one", F.lit(1)), "one").drop("one")


def recalibrated(probability: Column, weight: Column) -> Column:
    """p / (p + (1 - p) / weight), the correction as published."""
    return ratio(probability, probability + (F.lit(1.0) - probability) / weight)


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean squared error, its root and R squared, one row."""
    y, error = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    sums = scored.agg(
        F.count("*").alias("n"), F.sum(error * error).alias("sse"), F.var_pop(y).alias("variance")
    )
    mse = ratio(F.col("sse"), F.col("n"))
    return sums.select(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - ratio(mse, F.col("variance"))).alias("r2"),
    )
