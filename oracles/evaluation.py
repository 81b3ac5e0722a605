"""Profiles, splits and evaluation in SQL."""

from __future__ import annotations

import oracles.features  # noqa: F401 - its parts are used here
from oracles.compose import part, query
from oracles.silver import title
from shopmart.operators.features import LTV_FEATURES

NUMBERS = (*LTV_FEATURES, "ltv_6m")


def describe(column: str) -> str:
    x = f"cast({column} as double)"
    return f"""
select '{column}' "column", count({x}) "count", RND(avg({x}), 3) mean, RND(stddev_samp({x}), 3) std, min({x}) "min",
  RND(quantile_cont({x}, 0.25), 6) q25, RND(quantile_cont({x}, 0.5), 6) median,
  RND(quantile_cont({x}, 0.75), 6) q75, max({x}) "max" from {{ltv_features}}"""


def nulls(column: str) -> str:
    return f"""
select '{column}' "column", count(*) filter ({column} is null) nulls,
  DIV(count(*) filter ({column} is null), count(*)) null_fraction from {{churn_customers}}"""


# A score every engine computes alike: the longer ago the last sale, the likelier the churn.
part(
    "scored",
    """
select seller_id, ltv_6m, total_spent, churn_6m, RND(DIV(recency_days, 366), 4) score,
  case when RND(DIV(recency_days, 366), 4) >= 0.5 then 1 else 0 end prediction
from {labelled_sellers}
""",
)
part(
    "class_counts",
    "select count(*) filter (churn_6m = 0) negative, count(*) filter (churn_6m = 1) positive from {scored}",
)
part(
    "thresholds",
    """
select t.score threshold, count(*) filter (s.churn_6m = 1) tp, count(*) filter (s.churn_6m = 0) fp,
  any_value(positive) p, any_value(negative) n
from (select distinct score from {scored}) t join {scored} s on s.score >= t.score cross join {class_counts}
group by 1
""",
)
part(
    "buckets",
    """
select seller_id, churn_6m, substr(md5(concat_ws('-', '6199', seller_id)), 1, 16) bucket from {labelled_sellers}
""",
)
part(
    "cuts",
    """
select churn_6m, min(bucket) cut from (select churn_6m, bucket,
  count(*) over (partition by churn_6m order by bucket) seen, count(*) over (partition by churn_6m) total from {buckets})
where seen >= cast(0.8 as double) * total group by 1
""",
)

# The test rows of the models. Flags of the queries must all hold; figures of the models are not known here.
part("test_sellers", "select b.* from {buckets} b where bucket < '4000000000000000'")
part(
    "person_buckets",
    """
select customer_unique_id, churn_flag, substr(md5(concat_ws('-', '6199', customer_unique_id)), 1, 16) bucket
from {churn_customers}
""",
)
part(
    "test_persons",
    """
select b.* from {person_buckets} b join (select churn_flag, min(bucket) cut from (select churn_flag, bucket,
  count(*) over (partition by churn_flag order by bucket) seen, count(*) over (partition by churn_flag) total
  from {person_buckets}) where seen >= cast(0.8 as double) * total group by 1) c on c.churn_flag = b.churn_flag
where bucket > cut
""",
)


def model_checks(kind: str, rows: str, label: str, more: str = "") -> str:
    return f"""select '{kind}' model, count(*) test_rows, count(*) filter ({label} = 1) positives,
  true scores_valid, true figures_agree, true learned{more} from {{{rows}}}"""


CLASSIFIERS = ("decision_tree", "random_forest", "boosted_trees")
CHURN_COLUMNS = (
    "customer_unique_id num_orders distinct_categories avg_order_value lifetime_value avg_basket_size pct_on_time "
    "days_since_last_purchase avg_review_score pct_negative_reviews distinct_payment_types num_orders_180d ltv_180d "
    "num_canceled_orders churn_flag"
).split()


def words(x: str, mark: str) -> str:
    """Words also start after `mark`."""
    pieces = f"list_transform(string_split({title(x)}, '{mark}'), lambda p: upper(p[1]) || p[2:])"
    return f"array_to_string({pieces}, '{mark}')"


ORACLES: dict[str, str] = {
    "set_union_all": query("""
select 'customer' source, customer_city city, customer_state state from {customers}
union all select 'seller', seller_city, seller_state from {sellers}"""),
    "fn_title_case": query(f"""
select 'priority' kind, cast(o_orderkey as varchar) key, {words("o_orderpriority", "-")} title from orders
union all select 'category', product_id, {words("product_category_name", "_")} from {{products}}"""),
    "profile_describe": query("\nunion all\n".join(describe(c) for c in NUMBERS)),
    "profile_nulls": query("\nunion all\n".join(nulls(c) for c in CHURN_COLUMNS)),
    "profile_value_counts": query("""
select churn_6m "value", count(*) "rows", DIV(count(*), (select count(*) from {labelled_sellers})) "share"
from {labelled_sellers} group by 1"""),
    "profile_positive_share": query("select DIV(count(*) filter (ltv_6m > 0.1), count(*)) share_above from {ltv_features}"),
    "ml_train_test_split": query("""
select seller_id, b.churn_6m, case when bucket < '4000000000000000' then 'test' else 'train' end split,
  case when bucket <= cut then 'train' else 'test' end stratified_split
from {buckets} b join {cuts} c on c.churn_6m = b.churn_6m"""),
    "ml_class_ratio": query("""
select negative, positive, DIV(negative, positive) imbalance_ratio, DIV(positive, negative) positive_per_negative
from {class_counts}"""),
    "ml_confusion_matrix": query("""
select churn_6m "label", prediction, count(*) "rows" from {scored} group by 1, 2"""),
    "ml_roc_curve": query("select threshold, DIV(fp, n) fpr, DIV(tp, p) tpr from {thresholds} union all select null, 0, 0"),
    "ml_pr_curve": query("select threshold, DIV(tp, tp + fp) \"precision\", DIV(tp, p) recall from {thresholds} union all select null, 1, 0"),
    "ml_metrics": query("""
with rates as (select count(*) filter (churn_6m = 1 and prediction = 1) tp, count(*) filter (prediction = 1) called,
    count(*) filter (churn_6m = 1) pos from {scored}),
  pairs as (select DIV(sum(case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0 end), count(*)) auc
    from {scored} a join {scored} b on a.churn_6m = 1 and b.churn_6m = 0),
  steps as (select sum(DIV(tp - coalesce(before, 0), p) * DIV(tp, tp + fp)) ap,
      sum(DIV(tp - coalesce(before, 0), p) * (DIV(tp, tp + fp) + coalesce(DIV(before, before + fp_before), 1)) / 2) area
    from (select *, lag(tp) over (order by threshold desc) before, lag(fp) over (order by threshold desc) fp_before
      from {thresholds}))
select DIV(tp, called) "precision", DIV(tp, pos) recall, DIV(tp * 2, called + pos) f1, RND(auc, 6) roc_auc,
  RND(ap, 6) average_precision, RND(area, 6) pr_auc
from rates cross join pairs cross join steps"""),
    "ml_probability_recalibration": query("""
select seller_id, score, DIV(score, score + (cast(1 as double) - score) / DIV(negative, positive)) calibrated
from {scored} cross join {class_counts}"""),
    "ml_decision_tree_checks": query(model_checks("decision_tree", "test_sellers", "churn_6m")),
    "ml_random_forest_checks": query(model_checks("random_forest", "test_sellers", "churn_6m")),
    "ml_gbt_checks": query(model_checks("boosted_trees", "test_sellers", "churn_6m")),
    "ml_gbt_weighted_checks": query(model_checks("boosted_trees", "test_persons", "churn_flag")),
    "ml_logistic_checks": query(model_checks("logistic", "test_persons", "churn_flag")),
    "ml_scoring_expressions": query(
        "\nunion all\n".join(
            f"select '{k}' model, count(*) \"rows\", true same_class, true same_probability from {{labelled_sellers}}"
            for k in CLASSIFIERS
        )
    ),
    "ml_planted_signal": "select unnest([" + ", ".join(f"'{k}'" for k in (*CLASSIFIERS, "logistic")) + "]) model, true found",
    "ml_recalibrated_metrics_checks": "select true mean_valid, true moved_rightly, true same_order",
    "ml_predictions_checks": query("select seller_id, churn_6m, true scores_valid from {test_sellers}"),
    "ml_feature_importance_checks": "select unnest([" + ", ".join(f"'{c}'" for c in LTV_FEATURES)
    + "]) feature, true shares_valid, true sums_to_one",
    "ml_top_features_checks": query(
        "\nunion all\n".join(model_checks(k, "test_sellers", "churn_6m", ", 5 inputs") for k in CLASSIFIERS)
    ),
    "ml_score_and_filter_checks": query(
        "select seller_id, ltv_6m, true no_true_positive from {labelled_sellers} where churn_6m = 0"
    ),
    "ml_ltv_regression_checks": f"""
select model, inputs, true root_agrees, true r2_valid
from (select unnest(['random_forest', 'boosted_trees']) model) cross join (select unnest([{len(LTV_FEATURES)}, 6]) inputs)""",
    "ml_regression_metrics": query("""
select RND(avg((ltv_6m - total_spent) * (ltv_6m - total_spent)), 0) mse,
  RND(sqrt(avg((ltv_6m - total_spent) * (ltv_6m - total_spent))), 2) rmse,
  RND(1 - DIV(avg((ltv_6m - total_spent) * (ltv_6m - total_spent)), var_pop(ltv_6m)), 6) r2
from {scored}"""),
}
