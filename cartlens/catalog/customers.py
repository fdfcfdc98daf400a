"""Customer features, churn profile and value."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import days, money
from cartlens.catalog.registry import Data, query, rounded
from cartlens.operators import aggregates as agg
from cartlens.operators import stattests, weighted
from cartlens.plans import factored, rfm
from cartlens.plans.features import CORRELATED, FEATURES, late_per_customer


@query(
    "e5_customer_features",
    """SELECT customer_unique_id, last_recency AS recency, frequency, monetary_value, customer_tenure, late_total AS late_deliveries, num_orders FROM feat""",
)
def e5(d: Data):
    return d.facts.customers.drop("first_purchase", "last_purchase")


@query(
    "e5_recency_per_row",
    "SELECT customer_unique_id, recency, count(*) AS n_rows FROM frows GROUP BY ALL",
)
def e5b(d: Data):
    return d.facts.counted_rows.groupBy("customer_unique_id", "recency").agg(F.sum("n_rows").alias("n_rows"))


@query("e6_late_per_customer", "SELECT customer_id, CAST(sum(late_deliveries) AS BIGINT) AS total_late_deliveries FROM frows GROUP BY 1")
def e6(d: Data):
    return late_per_customer(d.facts)


_ROLLUP_MEANS = ("purchased_approved", "purchased_delivered", "review_score")


@query(
    "e7_customer_rollup",
    f"""SELECT customer_unique_id, max(customer_zip_code_prefix) AS customer_zip_code_prefix, max(customer_city) AS customer_city,
        max(customer_state) AS customer_state, count(DISTINCT order_id) AS order_id,
        round(avg({days('order_approved_at', 'order_purchase_timestamp')}), 6) AS purchased_approved,
        min({days('order_estimated_delivery_date', 'order_delivered_customer_date')}) AS delivered_estimated,
        round(avg({days('order_delivered_customer_date', 'order_purchase_timestamp')}), 6) AS purchased_delivered,
        count(DISTINCT product_id) AS product_id, {money('price')} AS price, {money('freight_value')} AS freight_value,
        max(payment_type) AS payment_type, max(payment_installments) AS payment_installments, {money('payment_value')} AS payment_value,
        round(avg(review_score), 6) AS review_score, max(recency) AS recency, count(DISTINCT num_orders) AS num_orders, avg(frequency) AS frequency,
        CAST(sum(CAST(monetary_value AS DECIMAL(18,2))) AS DOUBLE) AS monetary_value, max(customer_tenure) AS customer_tenure,
        CAST(sum(late_deliveries) AS BIGINT) AS late_deliveries FROM frows GROUP BY customer_unique_id""",
)
def e7(d: Data):
    return rounded(factored.rollup(d.cleaned), 6, *_ROLLUP_MEANS)


_BEHAVIOUR = f"""SELECT product_id, count(DISTINCT order_id) AS orders, {money('price')} AS price, {money('freight_value')} AS freight_value,
    avg(product_weight_g) AS product_weight_g, avg(product_length_cm) AS product_length_cm, avg(product_height_cm) AS product_height_cm,
    avg(product_width_cm) AS product_width_cm, round(avg(review_score), 6) AS review_score
    FROM wide GROUP BY product_id ORDER BY orders DESC, product_id LIMIT 10"""


@query("e8_product_behaviour", _BEHAVIOUR)
def e8(d: Data):
    return rounded(factored.behaviour(d.cleaned), 6, "review_score")


def _corr_sql(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM {source}"
        for a in columns
        for b in columns
    )


@query("e16_correlation_pairs", _corr_sql(CORRELATED, "frows"))
def e16(d: Data):
    return rounded(weighted.correlation_pairs(d.facts.counted_rows, CORRELATED, "n_rows"), 6, "correlation")


_LOGGED = """WITH t AS (SELECT ln(1 + (ln(1 + (recency + 1)) + 1)) AS recency, ln(1 + ln(1 + frequency)) AS frequency,
    ln(1 + ln(1 + monetary_value)) AS monetary_value, review_score, late_deliveries FROM frows) """
_LOG_COLUMNS = ("recency", "frequency", "monetary_value", "review_score", "late_deliveries")


@query("e16_log_correlation_matrix", _LOGGED + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, "
    + ", ".join(f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS {b}" for b in _LOG_COLUMNS)
    + " FROM t"
    for a in _LOG_COLUMNS
))
def e16b(d: Data):
    logged = rfm.log_features(d.facts.counted_rows)
    return rounded(weighted.correlation_matrix(logged, _LOG_COLUMNS, "n_rows"), 6, *_LOG_COLUMNS)


@query(
    "e16_score_correlation",
    _corr_sql(("recency_score", "frequency_score", "monetary_score", "rfm_score"), "scored"),
)
def e16c(d: Data):
    columns = ("recency_score", "frequency_score", "monetary_score", "rfm_score")
    return rounded(weighted.correlation_pairs(rfm.rfm_scores(d.facts), columns, "n_rows"), 6, "correlation")


_CHURN = "WITH t AS (SELECT *, CASE WHEN recency > 180 THEN 1 ELSE 0 END AS churn FROM frows)"


@query(
    "e17_correlation_with_churn",
    _CHURN
    + ", c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr(CAST({c} AS DOUBLE), CAST(churn AS DOUBLE))), 6) AS correlation FROM t"
        for c in CORRELATED
    )
    + ") SELECT * FROM c",
)
def e17(d: Data):
    rows = rfm.churn_rows(d.facts).withColumn("churn", F.col("churn").cast("int"))
    return rounded(weighted.correlation_with(rows, "churn", CORRELATED, "n_rows"), 6, "correlation")


@query(
    "e17_strongly_correlated",
    _CHURN
    + ", c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr(CAST({c} AS DOUBLE), CAST(churn AS DOUBLE))), 6) AS correlation FROM t"
        for c in CORRELATED
    )
    + ") SELECT * FROM c WHERE correlation > 0.2",
)
def e17b(d: Data):
    rows = rfm.churn_rows(d.facts).withColumn("churn", F.col("churn").cast("int"))
    return rounded(weighted.correlation_with(rows, "churn", CORRELATED, "n_rows", above=0.2), 6, "correlation")


_BEHAVIOUR_COLUMNS = ("orders", "price", "freight_value", "product_weight_g", "product_length_cm", "review_score")


@query("e18_top_product_correlation", f"WITH t AS ({_BEHAVIOUR}) {_corr_sql(_BEHAVIOUR_COLUMNS, 't')}")
def e18(d: Data):
    top = rounded(factored.behaviour(d.cleaned), 6, "review_score")
    return rounded(weighted.correlation_pairs(top, _BEHAVIOUR_COLUMNS), 6, "correlation")


@query(
    "e28_churn_profile",
    _CHURN
    + " SELECT CAST(churn AS VARCHAR) AS churn, "
    + ", ".join(f"round(avg({c}), 4) AS {c}" for c in FEATURES)
    + " FROM t GROUP BY 1",
)
def e28(d: Data):
    return rounded(rfm.churn_profile(d.facts), 4, *FEATURES)


@query(
    "e28_churn_profile_standardised",
    _CHURN
    + ", s AS (SELECT churn, "
    + ", ".join(f"({c} - (SELECT avg({c}) FROM t)) / (SELECT stddev_pop({c}) FROM t) AS {c}" for c in FEATURES)
    + " FROM t), g AS (SELECT CAST(churn AS VARCHAR) AS churn, "
    + ", ".join(f"round(avg({c}), 6) AS {c}" for c in FEATURES)
    + " FROM s GROUP BY 1) "
    + " UNION ALL ".join(f"SELECT churn, '{c}' AS feature, {c} AS mean_value FROM g" for c in FEATURES),
)
def e28b(d: Data):
    means = agg.melt(rfm.churn_profile(d.facts, standardised=True), ["churn"], "feature", "mean_value")
    return rounded(means, 6, "mean_value")


@query(
    "e29_historical_clv",
    """SELECT round(avg(monetary_value), 4) AS average_purchase_value, round(avg(frequency), 6) AS purchase_frequency,
       round(avg(customer_tenure), 6) AS average_customer_lifespan, round(avg(monetary_value) * avg(frequency) * avg(customer_tenure) / 1e6, 0) AS clv_millions FROM frows""",
)
def e29(d: Data):
    clv = rfm.historical_clv(d.facts).withColumn("clv_millions", F.round(F.col("historical_clv") / 1e6, 0))
    places = {"average_purchase_value": 4, "purchase_frequency": 6, "average_customer_lifespan": 6}
    return rounded(clv.drop("historical_clv"), places)


@query(
    "e29_historical_clv_per_customer",
    """SELECT round(avg(monetary_value), 4) AS average_purchase_value, round(avg(frequency), 6) AS purchase_frequency,
       round(avg(customer_tenure), 6) AS average_customer_lifespan, round(avg(monetary_value) * avg(frequency) * avg(customer_tenure) / 1e6, 0) AS clv_millions FROM feat""",
)
def e29b(d: Data):
    clv = rfm.historical_clv(d.facts, "customer").withColumn("clv_millions", F.round(F.col("historical_clv") / 1e6, 0))
    places = {"average_purchase_value": 4, "purchase_frequency": 6, "average_customer_lifespan": 6}
    return rounded(clv.drop("historical_clv"), places)


def _anova(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round((b - s * s / n) / (k - 1) / ((q - b) / (n - k)), 4) AS f_statistic,
        CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within FROM
        (SELECT count(*) AS k, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM
         (SELECT rfm_score, CAST(count(*) AS DOUBLE) AS n, CAST(sum({c}) AS DOUBLE) AS s, CAST(sum({c} * {c}) AS DOUBLE) AS q FROM scored GROUP BY rfm_score))"""


_ANOVA = " UNION ALL ".join(_anova(c) for c in rfm.SCORES)


@query("s1_anova", _ANOVA)
def s1(d: Data):
    return rounded(stattests.anova(rfm.rfm_scores(d.facts), "rfm_score", rfm.SCORES, "n_rows"), 4, "f_statistic")


@query("s1_anova_with_p_values", f"SELECT *, TRUE AS p_in_range FROM ({_ANOVA})")
def s1b(d: Data):
    tests = stattests.with_f_p_value(stattests.anova(rfm.rfm_scores(d.facts), "rfm_score", rfm.SCORES, "n_rows"))
    checked = tests.withColumn("p_in_range", F.col("p_value").between(0, 1)).drop("p_value")
    return rounded(checked, 4, "f_statistic")
