"""Features, split, score quality, predictions and risk views.

Trained scores cannot be recomputed in SQL, so everything after the model is compared on a fixed score: a formula
over each order's own columns. The trained model itself is checked by its rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelqueries.registry import pick, query
from parcelqueries.star import Star
from parcelmart.operators.ordering import quantile, quantiles, with_ntile
from parcelmart.operators.ranking import alert_quality, ranking_quality
from parcelmart.plans import features, risk_views
from parcelmart.plans.late_model import ALERT_RATE
from parcelmart.shared import written

FEATURE_COLUMNS = (
    "order_id @purchase_date is_late purchase_month purchase_weekday estimated_days n_items n_sellers n_products "
    "items_value freight_value freight_ratio total_weight_g total_volume_cm3 main_category payment_type "
    "payment_installments customer_state seller_state same_state"
)


def feature_table(spark, folder) -> DataFrame:
    star = Star(spark, folder)
    return features.late_delivery_features(
        star.fact_orders(), star.order_lines(), star.dim_date(), star.dim_customer(), star.dim_product(),
        star.dim_seller(),
    )


def split(spark, folder) -> DataFrame:
    """The features are written once: the cut dates and the split both read them."""
    return features.split_by_time(written(feature_table(spark, folder), "features"))


def scored(spark, folder) -> DataFrame:
    """Validation, test and open orders with the fixed score, written once for all that is asked of it."""
    mixed = (F.col("order_id").cast("bigint") * 7919 + F.col("estimated_days") * 131) % 5003
    scores = split(spark, folder).where(F.col("data_split") != "train").select(
        "order_id", "purchase_date", "data_split", "is_late", (mixed.cast("double") / 5003).alias("probability")
    )
    return written(scores, "scored")


def tested(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("data_split") == "test").select("probability", "is_late")


def alert_threshold(scores: DataFrame) -> DataFrame:
    validation = scores.where(F.col("data_split") == "valid")
    return quantile(validation, "probability", 1 - ALERT_RATE, name="threshold")


def predicted(spark, folder) -> DataFrame:
    scores = scored(spark, folder)
    return risk_views.predictions(scores, alert_threshold(scores).first().threshold)


query("l1_late_delivery_features", pick("features", FEATURE_COLUMNS))(feature_table)


@query(
    "l2_prepared_features",
    """SELECT order_id, COALESCE(payment_type, 'unknown') AS payment_type, COALESCE(main_category, 'unknown')
       AS main_category, CAST(payment_installments AS DOUBLE) AS payment_installments,
       CAST(n_items AS DOUBLE) AS n_items, total_weight_g, CAST(is_late AS DOUBLE) AS is_late FROM features""",
)
def prepared_features(spark, folder):
    return features.prepared(feature_table(spark, folder)).select(
        "order_id", "payment_type", "main_category", "payment_installments", "n_items", "total_weight_g", "is_late"
    )


_PREPARED = ", ".join(
    {"order_id": "order_id", "@purchase_date": "CAST(purchase_date AS VARCHAR) AS purchase_date"}.get(name)
    or (f"COALESCE({name}, 'unknown') AS {name}" if name in features.CATEGORICAL_FEATURES else f"CAST({name} AS DOUBLE) AS {name}")
    for name in FEATURE_COLUMNS.split()
)


@query("l2_all_prepared_features", f"SELECT {_PREPARED} FROM features")
def all_prepared_features(spark, folder):
    """All twenty columns that training sees."""
    return features.prepared(feature_table(spark, folder))


query("l3_cut_dates", pick("cuts", "@valid_from @test_from labelled"))(
    lambda spark, folder: features.cut_dates(feature_table(spark, folder))
)
query("l3_split_by_time", pick("splits", "order_id data_split"))(
    lambda spark, folder: split(spark, folder).select("order_id", "data_split")
)
query(
    "f8_split_sizes",
    "SELECT data_split, count(*) AS orders, CAST(sum(is_late) AS BIGINT) AS late FROM splits GROUP BY data_split",
)(lambda spark, folder: features.split_sizes(split(spark, folder)))

query("l6_alert_threshold", "SELECT round(threshold, 12) AS threshold FROM threshold")(
    lambda spark, folder: alert_threshold(scored(spark, folder)).select(F.round("threshold", 12).alias("threshold"))
)


@query(
    "a14_price_quantiles",
    """SELECT CAST(0.37 AS DOUBLE) AS fraction, round(quantile_cont(l_extendedprice, 0.37), 6) AS price FROM lineitem
       UNION ALL SELECT 0.9, round(quantile_cont(l_extendedprice, 0.9), 6) FROM lineitem""",
)
def price_quantiles(spark, folder):
    prices = Star(spark, folder).given("lineitem").select("l_extendedprice")
    found = quantiles(prices, "l_extendedprice", {"low": 0.37, "high": 0.9})
    pairs = [F.struct(F.lit(fraction).alias("fraction"), F.round(name, 6).alias("price")) for fraction, name in ((0.37, "low"), (0.9, "high"))]
    return found.select(F.inline(F.array(*pairs)))


@query(
    "l7_ranking_quality",
    """SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (sum(pos) * sum(neg)), 10) AS roc_auc,
              round(sum(pos * tp / (tp + fp)) / sum(pos), 10) AS pr_auc,
              CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(pos) + sum(neg) AS BIGINT) AS rows
       FROM (SELECT pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp
             FROM (SELECT probability AS p, sum(is_late) AS pos, sum(1 - is_late) AS neg FROM tested GROUP BY 1))""",
)
def ranking(spark, folder):
    quality = ranking_quality(tested(scored(spark, folder)), "probability", "is_late")
    return quality.select(
        F.round("roc_auc", 10).alias("roc_auc"), F.round("pr_auc", 10).alias("pr_auc"), "positives", "rows"
    )


@query(
    "l9_alert_quality",
    """SELECT round(late_rate, 10) AS late_rate, round(late_rate, 10) AS baseline_pr_auc,
              round(flagged_pct, 10) AS flagged_pct, round(flagged_precision, 10) AS flagged_precision,
              round(flagged_recall, 10) AS flagged_recall, round(flagged_precision / late_rate, 10) AS lift
       FROM (SELECT avg(is_late) AS late_rate, avg(CAST(probability >= threshold AS INTEGER)) AS flagged_pct,
                    avg(is_late) FILTER (WHERE probability >= threshold) AS flagged_precision,
                    sum(is_late) FILTER (WHERE probability >= threshold) / sum(is_late) AS flagged_recall
             FROM tested CROSS JOIN threshold)""",
)
def alerts(spark, folder):
    scores = scored(spark, folder)
    threshold = alert_threshold(scores).first().threshold
    quality = alert_quality(tested(scores), "probability", "is_late", threshold)
    return quality.select(*[F.round(name, 10).alias(name) for name in quality.columns])


query(
    "l11_predictions",
    pick("predicted", "order_id data_split @purchase_date $late_probability risk_level actual_is_late"),
)(predicted)


@query(
    "l13_open_orders_at_risk",
    """SELECT p.order_id, CAST(p.purchase_date AS VARCHAR) AS purchase_date, o.order_status, c.state AS customer_state,
              CAST(p.late_probability AS DOUBLE) AS late_probability, p.risk_level
       FROM predicted p JOIN f_orders o ON o.order_id = p.order_id
       JOIN dim_customer c ON c.customer_unique_id = o.customer_unique_id WHERE p.data_split = 'open'""",
)
def open_orders(spark, folder):
    star = Star(spark, folder)
    orders = star.fact_orders("order_id", "order_status", "customer_key")
    at_risk = risk_views.open_orders_at_risk(predicted(spark, folder), orders, star.dim_customer())
    return at_risk.orderBy(F.col("late_probability").desc(), "order_id")


@query(
    "l14_test_risk_deciles",
    """SELECT CAST(risk_group AS INTEGER) AS risk_group, count(*) AS orders, CAST(round(avg(late_probability), 4) AS DOUBLE) AS avg_predicted,
              CAST(round(avg(CAST(actual_is_late AS INTEGER)), 4) AS DOUBLE) AS actual_late_rate,
              CAST(sum(CAST(actual_is_late AS INTEGER)) AS BIGINT) AS late_orders
       FROM (SELECT late_probability, actual_is_late, ntile(10) OVER (ORDER BY late_probability, order_id) AS risk_group
             FROM predicted WHERE data_split = 'test') GROUP BY risk_group""",
)
def deciles(spark, folder):
    return risk_views.test_risk_deciles(predicted(spark, folder)).orderBy("risk_group")


@query(
    "w13_ntile_over_orders",
    """SELECT order_id, CAST(ntile(10) OVER (ORDER BY payment_value, order_id) AS INTEGER) AS bucket FROM payments_per_order""",
)
def ntile_over_orders(spark, folder):
    orders = Star(spark, folder).fact_orders("order_id", "payment_value").where(F.col("payment_value").isNotNull())
    return with_ntile(orders, 10, F.col("payment_value"), F.col("order_id")).select("order_id", "bucket")


@query(
    "w13_ntile_over_all_orders",
    """SELECT order_id, CAST(ntile(10) OVER (ORDER BY payment_value ASC NULLS LAST, order_id) AS INTEGER) AS bucket
       FROM f_orders""",
)
def ntile_over_all_orders(spark, folder):
    """Every order has a bucket; those without a payment come behind the dearest."""
    orders = Star(spark, folder).fact_orders("order_id", "payment_value")
    return with_ntile(orders, 10, F.col("payment_value").asc_nulls_last(), F.col("order_id")).select("order_id", "bucket")
