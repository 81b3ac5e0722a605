"""Every query by name, each a function of (session, folder of sample tables)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.operators import evaluation, features, gold, models, profiling, quality, rules, scoring, silver, star
from shopmart.functions.columns import title_case
from shopmart.operators.silver import Silver
from shopmart.session import cut_lineage, shared_dir
from shopmart.sources import storage
from shopmart.sources.bronze import SCHEMAS, Bronze, read_checked_csv, read_csv
from shopmart.sources.sample import dirty_bronze, sample_bronze, thirds_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# What queries on the sample do with its raw tables or silver, for callers that have these stored.
FROM_BRONZE: dict[str, Callable[[Bronze], DataFrame]] = {}
FROM_SILVER: dict[str, Callable[[Silver], DataFrame]] = {}


def register(name: str, build: Query) -> None:
    QUERIES[name] = build


def on_bronze(name: str, build: Callable[[Bronze], DataFrame], shared: bool = False) -> None:
    FROM_BRONZE[name] = build
    register(name, lambda spark, sf_dir: build(sample_bronze(spark, sf_dir, shared)))


def on_silver(name: str, build: Callable[[Silver], DataFrame], shared: bool = False) -> None:
    FROM_SILVER[name] = build
    register(name, lambda spark, sf_dir: build(Silver.from_bronze(sample_bronze(spark, sf_dir, shared))))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


# ---------------------------------------------------------------- silver


def plain_money(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the published type."""
    decimals = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


AMOUNTS = ("price", "freight_value", "payment_value")


def list_text(array: str, fields: tuple[str, ...]) -> Column:
    """An array of structs as one comparable text; amounts without trailing zeros."""

    def text(x: Column, field: str) -> Column:
        return (x[field].cast("double") if field in AMOUNTS else x[field]).cast("string")

    return F.array_join(F.transform(array, lambda x: F.concat_ws("|", *[text(x, f) for f in fields])), ";")


def flat_arrays(df: DataFrame) -> DataFrame:
    """Nested arrays as text columns."""
    fields = {
        "order_items_array": ("item_list", silver.ITEM_FIELDS),
        "payments_array": ("payment_list", silver.PAYMENT_FIELDS),
        "sellers_array": (
            "seller_list",
            ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ),
    }
    for array, (name, struct_fields) in fields.items():
        if array in df.columns:
            df = df.withColumn(name, list_text(array, struct_fields)).drop(array)
    return plain_money(df)


def _items_agg(bronze: Bronze) -> DataFrame:
    return flat_arrays(silver.items_agg(bronze))


def _sellers_agg(bronze: Bronze) -> DataFrame:
    return flat_arrays(silver.sellers_agg(bronze))


def _denormalized(bronze: Bronze) -> DataFrame:
    return flat_arrays(silver.denormalized_orders(bronze).drop("_ingest_ts", silver.COPIES))


def _exploded(part: str) -> Callable[[Bronze], DataFrame]:
    return lambda bronze: plain_money(silver.exploded(silver.denormalized_orders(bronze), part))


on_bronze("silver_items_agg", _items_agg)
on_bronze("silver_payments_agg", lambda b: flat_arrays(silver.payments_agg(b.order_payments)))
on_bronze("silver_sellers_agg", _sellers_agg)
on_bronze("silver_core_order", lambda b: silver.core_order(b.orders, b.customers))
on_bronze("silver_latest_review", lambda b: silver.latest_review(b.order_reviews))
on_silver(
    "silver_payment_match",
    lambda s: plain_money(
        s.orders.select("order_id", "calculated_order_cost", "total_payment_value", "payment_match_flag")
    ),
)
on_silver(
    "silver_delivery_flags",
    lambda s: plain_money(
        s.orders.select("order_id", "is_delivered_on_time", "num_early_delivery_days", "date_validity")
    ),
)
on_bronze("silver_denormalized_orders", _denormalized, shared=True)
on_bronze("silver_items_exploded", _exploded("items"))
on_bronze("silver_payments_exploded", _exploded("payments"))
on_bronze("silver_sellers_exploded", _exploded("sellers"))

# ---------------------------------------------------------------- gold

on_silver("gold_sales_kpi", gold.sales_kpi)
on_silver("gold_customer_ltv", gold.customer_ltv)
on_silver("gold_seller_performance", gold.seller_performance, shared=True)
on_silver("gold_payment_behavior", gold.payment_behavior)
on_silver("gold_cohort_retention_all", gold.cohort_retention_all)
on_silver("gold_cohort_retention_product", gold.cohort_retention_product)
on_silver("gold_order_summary", gold.order_summary)
on_silver("gold_customer_metrics", lambda s: gold.customer_metrics(gold.order_summary(s)))

# The same tables from the stored nested table, from orders and products that are stored twice, and from both.
GOLD_TABLES: dict[str, Callable[[Silver], DataFrame]] = {
    "gold_sales_kpi": gold.sales_kpi,
    "gold_customer_ltv": gold.customer_ltv,
    "gold_seller_performance": gold.seller_performance,
    "gold_payment_behavior": gold.payment_behavior,
    "gold_cohort_retention_all": gold.cohort_retention_all,
    "gold_cohort_retention_product": gold.cohort_retention_product,
    "gold_order_summary": gold.order_summary,
    "gold_customer_metrics": lambda s: gold.customer_metrics(gold.order_summary(s)),
    "gold_ltv_features": features.ltv_features,
}
DIRTY_TABLES = (
    "gold_sales_kpi",
    "gold_customer_ltv",
    "gold_seller_performance",
    "gold_payment_behavior",
    "gold_ltv_features",
)


# Those that read items and reviews of the flat parts in one plan.
ALL_CHILDREN = ("gold_seller_performance", "gold_ltv_features")


def nested_silver(bronze: Bronze) -> Silver:
    """Silver read back from the stored nested table."""
    return Silver.from_table(cut_lineage(silver.denormalized_orders(bronze)))


def _on(source: Callable[..., Bronze], form: Callable[[Bronze], object], build, shared: bool = False) -> Query:
    """`shared` for builds that read items, payments and reviews in one plan."""
    return lambda spark, sf_dir: build(form(source(spark, sf_dir, shared)))


for _name, _gold in GOLD_TABLES.items():
    register(f"{_name}_nested", _on(sample_bronze, nested_silver, _gold, shared=True))
for _name in DIRTY_TABLES:
    register(f"{_name}_dirty", _on(dirty_bronze, Silver.from_bronze, GOLD_TABLES[_name], shared=_name in ALL_CHILDREN))
    register(f"{_name}_dirty_nested", _on(dirty_bronze, nested_silver, GOLD_TABLES[_name], shared=True))

THIRDS_TABLES: dict[str, Callable[[Bronze], DataFrame]] = {
    "silver_items_agg": _items_agg,
    "silver_payments_agg": lambda b: flat_arrays(silver.payments_agg(b.order_payments)),
    "silver_denormalized_orders": _denormalized,
    "star_seller_performance": star.star_seller_performance,
}
for _name, _thirds in THIRDS_TABLES.items():
    register(f"{_name}_thirds", _on(thirds_bronze, lambda bronze: bronze, _thirds, shared=_thirds is _denormalized))
for _name in DIRTY_TABLES:
    register(f"{_name}_thirds", _on(thirds_bronze, Silver.from_bronze, GOLD_TABLES[_name], shared=_name in ALL_CHILDREN))
    register(f"{_name}_thirds_nested", _on(thirds_bronze, nested_silver, GOLD_TABLES[_name], shared=True))

# ---------------------------------------------------------------- star schema

on_bronze("star_customer_ltv", star.star_customer_ltv)
on_bronze("star_payment_behavior", star.star_payment_behavior)
on_bronze("star_seller_performance", star.star_seller_performance)
on_bronze("star_sales_kpi", star.star_sales_kpi)
on_bronze("star_cohort_retention_all", star.star_cohort_retention_all)
on_bronze("star_cohort_retention_product", star.star_cohort_retention_product)

# ---------------------------------------------------------------- quality

# Key checks that find nothing in clean data run on the sample with planted faults.
FAULT_CHECKS = (
    quality.orders_null_keys,
    quality.orders_dup_order_id,
    quality.orders_customer_ratio,
    quality.orders_dup_customer_id,
    quality.products_dup,
    quality.distinct_orders,
    quality.distinct_order_customers,
)
CHECKS = (
    quality.customers_distinct_ratio,
    quality.multi_payment_orders,
    quality.repeat_customers,
    quality.customer_moved,
    quality.multi_review_orders,
    quality.multi_review_latest,
    quality.untranslated_categories,
    quality.orders_without_review,
    quality.reviews_without_order,
    quality.items_without_product,
    quality.invalid_dates,
    quality.orders_without_payment,
    quality.orders_without_items,
    quality.cost_payment_mismatch,
)


def _plain(build: Callable[[Bronze], DataFrame]) -> Callable[[Bronze], DataFrame]:
    return lambda bronze: plain_money(build(bronze))


def _on_dirty(build: Callable[[Bronze], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(dirty_bronze(spark, sf_dir))


for _build in FAULT_CHECKS:
    register(f"dq_{_build.__name__}", _on_dirty(_plain(_build)))
for _build in CHECKS:
    on_bronze(f"dq_{_build.__name__}", _plain(_build))


def _tables(s: Silver) -> dict[str, DataFrame]:
    return {
        "denormalized_orders": s.orders,
        "customer_ltv": gold.customer_ltv(s),
        "cohort_retention_product": gold.cohort_retention_product(s),
        "cohort_retention_all": gold.cohort_retention_all(s),
        "payment_behavior": gold.payment_behavior(s),
        "seller_performance": gold.seller_performance(s),
        "sales_kpi": gold.sales_kpi(s),
    }


def _rule_query(kinds: tuple[str, ...] | None, faults: bool = False, store: bool = False) -> Query:
    """`store` writes the nested table first, for reports on many gold tables, and then one report after the other."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        form = nested_silver if store else Silver.from_bronze
        tables = _tables(form(sample_bronze(spark, sf_dir, shared=store)))
        if faults:
            tables["denormalized_orders"] = Silver.from_bronze(dirty_bronze(spark, sf_dir)).orders
        if not store:
            return rules.report(tables, kinds)
        asked = [name for name in tables if rules.asked(name, kinds)]
        return reduce(DataFrame.unionByName, [cut_lineage(rules.report({name: tables[name]}, kinds)) for name in asked])

    return build


register("dq_rule_unique", _rule_query(("unique",), faults=True))
register("dq_rule_not_null", _rule_query(("not_null",), faults=True, store=True))
register("dq_rule_accepted_values", _rule_query(("accepted_values",)))
register("dq_rule_expression", _rule_query(("expression",), store=True))


# What the checked tables read of the flat parts.
CHECKED_FIELDS = {
    "orders": (
        "order_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        "calculated_order_cost",
        "total_payment_value",
        "payment_match_flag",
        "is_delivered_on_time",
        "num_early_delivery_days",
        "review_score",
    ),
    "items": ("order_id", "order_item_id", "product_category", "price"),
    "payments": ("order_id", "payment_type", "payment_installments"),
    "sellers": ("order_id", "seller_id", "seller_state"),
}


def gold_report(s: Silver) -> DataFrame:
    """All rules: those of gold are counted while its tables are written, those of silver in one pass.

    Flat parts are written first, because seven tables read them and each would derive them anew. Tables are written one
    after the other, so that the disk holds the shuffles of one.
    """
    if s.table is None:
        s = replace(s, **{part: getattr(s, part).select(*fields) for part, fields in CHECKED_FIELDS.items()}).stored()
    tables = _tables(s)
    orders = tables.pop("denormalized_orders")
    done = [rules.store_checked(table, name, cut_lineage)[1] for name, table in tables.items()]
    return reduce(DataFrame.unionByName, [rules.report({"denormalized_orders": orders}), *done])


on_silver("dq_gold_report", gold_report, shared=True)
GOLD_TABLES["dq_gold_report"] = gold_report
register("dq_gold_report_nested", _on(sample_bronze, nested_silver, gold_report, shared=True))

# ---------------------------------------------------------------- features

on_silver("gold_ltv_features", features.ltv_features, shared=True)
on_silver("ltv_target", features.ltv_target)


def labelled_sellers(s: Silver) -> DataFrame:
    return features.churn_label(features.ltv_features(s))


on_silver("ml_churn_label", lambda s: labelled_sellers(s).select("seller_id", "ltv_6m", "churn_6m"))
on_silver("churn_features_customer", features.churn_features_customer)
on_silver("ml_fill_missing", lambda s: features.fill_missing(features.churn_features_customer(s)))

# ---------------------------------------------------------------- profiles


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Figures that depend on the order of summing, at comparable precision."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _locations(bronze: Bronze) -> DataFrame:
    parts = {
        "customer": bronze.customers.select(
            F.col("customer_city").alias("city"), F.col("customer_state").alias("state")
        ),
        "seller": bronze.sellers.select(F.col("seller_city").alias("city"), F.col("seller_state").alias("state")),
    }
    return profiling.union_all(parts, "source")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of all orders and categories of all products, as titles."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    products = sample_bronze(spark, sf_dir).products
    texts = {
        "priority": orders.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("text")),
        "category": products.select(F.col("product_id").alias("key"), F.col("product_category_name").alias("text")),
    }
    return profiling.union_all(texts, "kind").select("kind", "key", title_case(F.col("text")).alias("title"))


on_bronze("set_union_all", _locations)
register("fn_title_case", _titles)
on_silver(
    "profile_describe",
    lambda s: _rounded(
        profiling.describe(cut_lineage(features.ltv_features(s)), [*features.LTV_FEATURES, "ltv_6m"]),
        mean=3, std=3, q25=6, median=6, q75=6,
    ),
)
on_silver("profile_nulls", lambda s: profiling.null_profile(features.churn_features_customer(s)))
on_silver(
    "profile_value_counts", lambda s: profiling.value_counts(cut_lineage(labelled_sellers(s)), "churn_6m"), shared=True
)
on_silver("profile_positive_share", lambda s: profiling.share_above(features.ltv_features(s), "ltv_6m", 0.1))

# ---------------------------------------------------------------- evaluation


def scored_sellers(s: Silver) -> DataFrame:
    """Sellers with a plain score, so that evaluation does not depend on a trained model."""
    score = F.round(F.try_divide(F.col("recency_days").cast("double"), F.lit(366.0)), 4)
    return labelled_sellers(s).select(
        "seller_id",
        "ltv_6m",
        "total_spent",
        "churn_6m",
        score.alias("score"),
        F.when(score >= evaluation.THRESHOLD, 1).otherwise(0).alias("prediction"),
    )


def _split(s: Silver) -> DataFrame:
    sellers = cut_lineage(labelled_sellers(s).select("seller_id", "churn_6m"))
    split = evaluation.train_test_split(sellers, "seller_id")
    return evaluation.stratified_split(split, "seller_id", "churn_6m")


def _recalibrated(s: Silver) -> DataFrame:
    scored = cut_lineage(scored_sellers(s))
    weight = evaluation.class_ratio(scored, "churn_6m").select("imbalance_ratio").scalar()
    return scored.select("seller_id", "score", evaluation.recalibrated(F.col("score"), weight).alias("calibrated"))


on_silver("ml_train_test_split", _split)
on_silver("ml_class_ratio", lambda s: evaluation.class_ratio(labelled_sellers(s), "churn_6m"))
on_silver("ml_confusion_matrix", lambda s: evaluation.confusion_matrix(scored_sellers(s), "churn_6m", "prediction"))
on_silver("ml_roc_curve", lambda s: evaluation.roc_curve(scored_sellers(s), "churn_6m", "score"))
on_silver("ml_pr_curve", lambda s: evaluation.pr_curve(scored_sellers(s), "churn_6m", "score"))
on_silver("ml_metrics", lambda s: evaluation.metrics(cut_lineage(scored_sellers(s)), "churn_6m", "score", "prediction"))
on_silver("ml_probability_recalibration", _recalibrated)
on_silver(
    "ml_regression_metrics",
    lambda s: _rounded(
        evaluation.regression_metrics(scored_sellers(s), "ltv_6m", "total_spent"), mse=0, rmse=2, r2=6
    ),
)

# ---------------------------------------------------------------- models

KEY, LABEL = "seller_id", "churn_6m"


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled sellers, written once: training reads them many times."""
    return cut_lineage(labelled_sellers(Silver.from_bronze(sample_bronze(spark, sf_dir, shared=True))))


Fit = Callable[[SparkSession, str], tuple[Model, DataFrame]]


def _seller_fit(kind: str) -> Fit:
    return lambda spark, sf_dir: models.train(training_table(spark, sf_dir), features.LTV_FEATURES, KEY, LABEL, kind)


def _figures(fit: Fit, key: str, label: str, kind: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, rows = fit(spark, sf_dir)
        return models.evaluate(models.score(model, rows.where("split = 'test'"), key, label), label, kind)

    return build


def _checked(fitted: tuple[Model, DataFrame], key: str, label: str, kind: str) -> DataFrame:
    model, rows = fitted
    test, train = (cut_lineage(models.score(model, rows.where(F.col("split") == s), key, label)) for s in ("test", "train"))
    return models.check(test, train, label, kind)


def _checks(fit: Fit, key: str, label: str, kind: str) -> Query:
    return lambda spark, sf_dir: _checked(fit(spark, sf_dir), key, label, kind)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = training_table(spark, sf_dir)
    return models.train_and_score(table, features.LTV_FEATURES, KEY, LABEL, "random_forest")[1]


def _predictions_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = models.fits_class(F.col("prediction"), F.col("probability"))
    return _predictions(spark, sf_dir).select(KEY, LABEL, valid.alias("scores_valid"))


RANKED_KINDS = ("random_forest", "boosted_trees")
CLASSIFIER_KINDS = ("decision_tree", *RANKED_KINDS)


def _importances_on(table: DataFrame, inputs: Sequence[str]) -> DataFrame:
    trained = {kind: models.train_and_score(table, inputs, KEY, LABEL, kind)[0] for kind in RANKED_KINDS}
    return models.compare_importances(trained, inputs)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _importances_on(training_table(spark, sf_dir), features.LTV_FEATURES)


def _importance_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every input with whether its shares are shares, and whether those of each model add up to 1."""
    table = _importance(spark, sf_dir)
    sums = table.agg(*[F.sum(kind).alias(kind) for kind in RANKED_KINDS])
    whole = [F.abs(sums.select(kind).scalar() - 1) < models.ROUNDING for kind in RANKED_KINDS]
    valid = [F.col(kind).between(0, 1) for kind in RANKED_KINDS]
    return table.select("feature", (valid[0] & valid[1]).alias("shares_valid"), (whole[0] & whole[1]).alias("sums_to_one"))


def _top_forest(table: DataFrame) -> tuple[list[str], Model, DataFrame]:
    """The forest trained again on the inputs that mattered most the first time."""
    first, _ = models.train_and_score(table, features.LTV_FEATURES, KEY, LABEL, "random_forest")
    chosen = models.top_features(first, features.LTV_FEATURES, models.TOP_CHURN)
    forest, scored = models.train_and_score(table, chosen, KEY, LABEL, "random_forest")
    return chosen, forest, scored


def _top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, _, scored = _top_forest(training_table(spark, sf_dir))
    return models.evaluate(scored, LABEL, "random_forest").withColumn("inputs", F.lit(", ".join(chosen)))


def _top_inputs(table: DataFrame) -> list[str]:
    return _top_forest(table)[0]


def _top_features_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All classifiers trained again on the forest's most important inputs."""
    table = training_table(spark, sf_dir)
    chosen = _top_inputs(table)
    scored = {kind: models.train_and_score(table, chosen, KEY, LABEL, kind)[1] for kind in CLASSIFIER_KINDS}
    return reduce(DataFrame.unionByName, [models.evaluate(s, LABEL, kind) for kind, s in scored.items()])


def _top_features_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of the second training, side by side."""
    table = training_table(spark, sf_dir)
    return _importances_on(table, _top_inputs(table))


def _top_features_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = training_table(spark, sf_dir)
    chosen = _top_inputs(table)
    rows = []
    for kind in CLASSIFIER_KINDS:
        checked = _checked(models.train(table, chosen, KEY, LABEL, kind), KEY, LABEL, kind)
        rows.append(checked.withColumn("inputs", F.lit(len(set(chosen)))))
    return reduce(DataFrame.unionByName, rows)


def not_true_positives(spark: SparkSession, table: DataFrame) -> DataFrame:
    """Scores all sellers with the stored forest and drops the rightly called churners."""
    chosen, forest, _ = _top_forest(table)
    path = f"{shared_dir(spark)}/churn-forest-{uuid4().hex}"
    models.save_model(forest, path)
    stored = models.load_random_forest(path)
    called = stored.transform(models.assemble(table, chosen))
    marked = called.select(*table.columns, F.col("prediction").cast("int").alias("churn_6m_pred"))
    return models.drop_true_positives(marked, LABEL, "churn_6m_pred")


def _score_and_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = not_true_positives(spark, training_table(spark, sf_dir))
    return rest.select(KEY, LABEL, "churn_6m_pred", "ltv_6m")


def _score_and_filter_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sellers without churn, who must all be left, and whether any true positive is."""
    rest = cut_lineage(_score_and_filter(spark, sf_dir))
    churned = rest.where(F.col(LABEL) == 1)
    left = churned.agg(F.coalesce(F.bool_and(F.col("churn_6m_pred") == 0), F.lit(True)).alias("ok"))
    return rest.where(F.col(LABEL) == 0).select(KEY, "ltv_6m", left.scalar().alias("no_true_positive"))


def _ltv_regression_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of inputs of each regressor and whether its figures hold together."""
    inputs = F.when(F.col("inputs") == "all", len(features.LTV_FEATURES)).otherwise(F.size(F.split("inputs", ", ")))
    root = F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) <= models.ROUNDING * (F.col("mse") + 1)
    return _ltv_regression(spark, sf_dir).select(
        "model", inputs.alias("inputs"), root.alias("root_agrees"), (F.col("r2") <= 1).alias("r2_valid")
    )


def _ltv_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of both regressors on all inputs and on the most important ones.

    The second training uses the filtered sellers as the first one does.
    """
    table = cut_lineage(not_true_positives(spark, training_table(spark, sf_dir)))
    reports = []

    def report(inputs: Sequence[str], note: str) -> dict[str, Model]:
        trained = {}
        for kind in ("random_forest", "boosted_trees"):
            trained[kind], scored = models.train_regressor(table, inputs, KEY, "ltv_6m", kind)
            figures = evaluation.regression_metrics(scored, "ltv_6m", "prediction")
            reports.append(figures.select(F.lit(kind).alias("model"), F.lit(note).alias("inputs"), "*"))
        return trained

    forest = report(features.LTV_FEATURES, "all")["random_forest"]
    top = models.top_features(forest, features.LTV_FEATURES, models.TOP_LTV)
    report(top, ", ".join(top))
    return reduce(DataFrame.unionByName, reports)


PERSON, PERSON_LABEL = "customer_unique_id", "churn_flag"


def person_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = features.churn_features_customer(Silver.from_bronze(sample_bronze(spark, sf_dir)))
    return cut_lineage(features.fill_missing(persons))


def _person_fitted(table: DataFrame, kind: str, weighted: bool) -> tuple[Model, DataFrame]:
    """The rare churn of persons: missing values filled, classes kept in proportion."""
    return models.train(table, features.CHURN_FEATURES, PERSON, PERSON_LABEL, kind, weighted, stratified=True)


def _person_fit(kind: str, weighted: bool) -> Fit:
    return lambda spark, sf_dir: _person_fitted(person_table(spark, sf_dir), kind, weighted)


def _recalibrated_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted model of persons, with the weight of the classes taken out of its probabilities again."""
    model, rows = _person_fitted(person_table(spark, sf_dir), "boosted_trees", weighted=True)
    scored = cut_lineage(models.score(model, rows.where("split = 'test'"), PERSON, PERSON_LABEL))
    ratio = evaluation.class_ratio(rows.where("split = 'train'"), PERSON_LABEL).select("imbalance_ratio").scalar()
    return models.recalibrated_figures(scored, PERSON_LABEL, F.coalesce(ratio, F.lit(1.0)))


def scored_both_ways(spark: SparkSession, table: DataFrame, kind: str) -> DataFrame:
    """Key, and class and probability of a model and of the expression made of its stored form."""
    model, rows = models.train(table, features.LTV_FEATURES, KEY, LABEL, kind)
    path = _scratch(spark, f"model-{kind}")
    models.save_model(model, path)
    given = models.score(model, rows, KEY, LABEL).select(KEY, F.col("prediction").alias("given_class"), F.col("probability").alias("given"))
    own = scoring.score_stored(table, path, features.LTV_FEATURES).select(
        F.col(KEY).alias("own_key"), "prediction", "probability"
    )
    return own.join(given, F.col("own_key").eqNullSafe(F.col(KEY)), "full")


def _scoring_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each kind of model scores, and whether its expression gives all of them the same class and probability."""
    table = training_table(spark, sf_dir)
    figures = []
    for kind in CLASSIFIER_KINDS:
        both = scored_both_ways(spark, table, kind)
        close = F.abs(F.col("probability") - F.col("given")) < models.ROUNDING
        # On the fence the order of adding decides about the class.
        fence = F.abs(F.col("given") - 0.5) < models.ROUNDING
        same = (F.col("prediction") == F.col("given_class")) | fence
        figures.append(
            both.agg(
                F.lit(kind).alias("model"),
                F.count("*").alias("rows"),
                F.bool_and(F.coalesce(same, F.lit(False))).alias("same_class"),
                F.bool_and(F.coalesce(close, F.lit(False))).alias("same_probability"),
            )
        )
    return reduce(DataFrame.unionByName, figures)


def _recalibrated_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the correction keeps the order of the probabilities and moves them to the side that the ratio says."""
    model, rows = _person_fitted(person_table(spark, sf_dir), "boosted_trees", weighted=True)
    scored = cut_lineage(models.score(model, rows.where("split = 'test'"), PERSON, PERSON_LABEL))
    ratio = evaluation.class_ratio(rows.where("split = 'train'"), PERSON_LABEL).select("imbalance_ratio").scalar()
    weight = F.coalesce(ratio, F.lit(1.0))
    fair = models.recalibrated_figures(scored, PERSON_LABEL, weight)
    plain = models.recalibrated_figures(scored, PERSON_LABEL, F.lit(1.0))

    def same(column: str) -> Column:
        given = plain.select(column).scalar()
        return F.coalesce(F.abs(F.col(column) - given) < models.ROUNDING, given.isNull() & F.col(column).isNull())

    moved = F.col("mean_calibrated") - plain.select("mean_calibrated").scalar()
    return fair.select(
        F.col("mean_calibrated").between(0, 1).alias("mean_valid"),
        F.when(weight >= 1, moved >= -models.ROUNDING).otherwise(moved <= models.ROUNDING).alias("moved_rightly"),
        (same("roc_auc") & same("average_precision")).alias("same_order"),
    )


SIGNAL_AREA = 0.7


def with_planted_signal(table: DataFrame) -> DataFrame:
    """A label that follows from the inputs, wrong for a tenth of the sellers."""
    middle = table.agg(F.percentile_approx("avg_order_value", 0.5)).scalar()
    wrong = F.crc32(KEY) % 10 == 0
    return table.withColumn(LABEL, ((F.col("avg_order_value") > middle) != wrong).cast("int"))


def _planted_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each classifier finds a planted signal again in the sellers it was not trained on."""
    table = cut_lineage(with_planted_signal(training_table(spark, sf_dir)))
    found = []
    for kind in (*CLASSIFIER_KINDS, "logistic"):
        scored = models.train_and_score(table, features.LTV_FEATURES, KEY, LABEL, kind)[1]
        area = models.evaluate(scored, LABEL, kind).select("model", (F.col("roc_auc") > SIGNAL_AREA).alias("found"))
        found.append(area)
    return reduce(DataFrame.unionByName, found)


for _name, _kind in (("decision_tree", "decision_tree"), ("random_forest", "random_forest"), ("gbt", "boosted_trees")):
    register(f"ml_{_name}", _figures(_seller_fit(_kind), KEY, LABEL, _kind))
    register(f"ml_{_name}_checks", _checks(_seller_fit(_kind), KEY, LABEL, _kind))
for _name, _kind, _weighted in (("gbt_weighted", "boosted_trees", True), ("logistic", "logistic", False)):
    register(f"ml_{_name}", _figures(_person_fit(_kind, _weighted), PERSON, PERSON_LABEL, _kind))
    register(f"ml_{_name}_checks", _checks(_person_fit(_kind, _weighted), PERSON, PERSON_LABEL, _kind))
register("ml_scoring_expressions", _scoring_expressions)
register("ml_planted_signal", _planted_signal)
register("ml_recalibrated_metrics_checks", _recalibrated_checks)
register("ml_recalibrated_metrics", _recalibrated_metrics)
register("ml_predictions", _predictions)
register("ml_predictions_checks", _predictions_checks)
register("ml_feature_importance_checks", _importance_checks)
register("ml_top_features_models", _top_features_models)
register("ml_top_features_importance", _top_features_importance)
register("ml_top_features_checks", _top_features_checks)
register("ml_score_and_filter_checks", _score_and_filter_checks)
register("ml_ltv_regression_checks", _ltv_regression_checks)
register("ml_feature_importance", _importance)
register("ml_top_features", _top_features)
register("ml_score_and_filter", _score_and_filter)
register("ml_ltv_regression", _ltv_regression)

# ---------------------------------------------------------------- storage

def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "order_items")
    storage.write_csv(sample_bronze(spark, sf_dir).order_items, path)
    return read_csv(spark, "order_items", path)


def spoiled_lines(items: DataFrame) -> DataFrame:
    """Order items as CSV lines, some with a price that is no number, without their last values, or with one too many."""
    line, kind = F.to_csv(F.struct(*items.columns)), F.col("order_item_id") % 7
    return items.select(
        F.when(kind == 3, F.regexp_replace(line, r",[^,]*,([^,]*)$", ",n/a,$1"))
        .when(kind == 5, F.regexp_replace(line, r",[^,]*,[^,]*$", ""))
        .when(kind == 6, F.concat(line, F.lit(",9")))
        .when(kind == 4, F.regexp_replace(line, r"^[^,]*,", ","))
        .otherwise(line)
        .alias("value")
    )


def _csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows, and rejected lines with the item they were and why."""
    path = _scratch(spark, "spoiled")
    spoiled_lines(sample_bronze(spark, sf_dir).order_items).write.text(path)
    checked = read_checked_csv(spark, SCHEMAS["order_items"], path, header=False, required=["order_id"])
    fields_of = F.split("line", ",")
    none = F.lit(None).cast("string")
    good = checked.good.select(none.alias("reason"), "order_id", "order_item_id", "product_id", "price")
    return good.unionByName(
        checked.rejected.select(
            "reason",
            F.nullif(F.get(fields_of, F.lit(0)), F.lit("")).alias("order_id"),
            F.get(fields_of, F.lit(1)).cast("bigint").alias("order_item_id"),
            F.get(fields_of, F.lit(2)).alias("product_id"),
            F.lit(None).cast("double").alias("price"),
        )
    )


def _in_three_loads(orders: DataFrame, path: str) -> DataFrame:
    """A load of the older half, one of all with repeated and null keys, and one that must add nothing."""
    bought = "order_purchase_timestamp"
    middle = orders.agg(F.percentile_approx(F.col(bought).cast("date"), 0.5)).scalar()
    table = storage.KeyedTable(orders.sparkSession, path, orders.schema, ["order_id"], bought)
    table.load(orders.where(F.col(bought) < middle), "first")
    nulls = orders.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in orders.schema]).limit(2)
    more = orders.unionByName(orders.where("order_status = 'canceled'")).unionByName(nulls)
    table.load(more, "second")
    table.load(more, "third")
    return table.rows()


def _incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Silver.from_bronze(sample_bronze(spark, sf_dir)).orders
    return plain_money(_in_three_loads(cut_lineage(orders), _scratch(spark, "silver")))


def _append_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = silver.denormalized_orders(sample_bronze(spark, sf_dir, shared=True)).drop("_ingest_ts", silver.COPIES)
    return flat_arrays(_in_three_loads(cut_lineage(table), _scratch(spark, "silver")))


register("bronze_csv_roundtrip", _csv_roundtrip)
register("silver_incremental_append", _incremental_append)
register("silver_append_nested", _append_nested)
register("bronze_csv_quarantine", _csv_quarantine)
