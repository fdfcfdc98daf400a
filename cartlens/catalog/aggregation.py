"""E: grouped aggregates and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import days, money, stamp
from cartlens.catalog.registry import Data, query, rounded, text
from cartlens.catalog.scalars import REGION_SQL, REGIONS
from cartlens.operators import aggregates as agg
from cartlens.plans import explore, kpis
from cartlens.plans.features import late_column


@query("e1_count_per_key", "SELECT seller_state, count(*) AS n FROM wide GROUP BY 1 ORDER BY n DESC, 1")
def e1(d: Data):
    return agg.counts(d.counted_wide(items=["seller_state"]), "seller_state").orderBy(F.desc("n"), "seller_state")


@query(
    "e2_relative_frequency",
    """WITH g AS (SELECT review_score, count(*) AS n FROM wide GROUP BY 1)
       SELECT review_score, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM g), 6) AS share FROM g""",
)
def e2(d: Data):
    return agg.frequencies(d.counted_wide(reviews=["review_score"]), "review_score", digits=6)


@query(
    "e3_count_distinct",
    """SELECT seller_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products FROM c_items GROUP BY seller_id""",
)
def e3(d: Data):
    return d["order_items"].groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("product_id").alias("products")
    )


@query(
    "e3_count_distinct_approximate",
    "SELECT seller_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products, TRUE AS near FROM c_items GROUP BY seller_id",
)
def e3b(d: Data):
    """Exact counts, and whether the sketches (2 % standard error) lie within a tenth of them."""
    counted = {"orders": "order_id", "products": "product_id"}
    rows = agg.distinct_and_sketched(d["order_items"], "seller_id", counted, 0.02)
    near = F.lit(True)
    for name in counted:
        near = near & (F.abs(F.col(f"{name}_sketch") - F.col(name)) <= F.greatest(F.col(name) * 0.1, F.lit(1.0)))
    return rows.select("seller_id", *counted, near.alias("near"))


@query(
    "e4_sum_mean_min_max",
    f"""SELECT product_id, {money('price')} AS total, round({money('price')} / count(*), 9) AS mean, min(price) AS lowest, max(price) AS highest
        FROM c_items GROUP BY product_id""",
)
def e4(d: Data):
    grouped = d["order_items"].groupBy("product_id").agg(
        agg.money_sum("price").alias("total"),
        agg.money_avg("price").alias("mean"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
    )
    return rounded(grouped, 9, "mean")


@query(
    "e9_status_summary",
    """WITH t AS (SELECT order_status, customer_id, order_id,
              CASE WHEN hour(order_approved_at) < 8 THEN 1 WHEN hour(order_approved_at) < 18 THEN 2 ELSE 3 END AS part FROM c_orders),
       m AS (SELECT DISTINCT ON (order_status) order_status, part FROM
             (SELECT order_status, part, count(*) AS n FROM t GROUP BY ALL) ORDER BY order_status, n DESC, part)
       SELECT order_status, count(DISTINCT customer_id) AS customer_id_unique, count(DISTINCT order_id) AS order_id_unique,
              any_value(m.part) AS time_of_day_mode FROM t JOIN m USING (order_status) GROUP BY order_status""",
)
def e9(d: Data):
    return explore.status_summary(d["orders"], "order_approved_at")


@query(
    "e10_mean_median_mode",
    """SELECT 'Mean Review Score' AS measure, round(avg(review_score), 6) AS value FROM dash
       UNION ALL SELECT 'Median Review Score', median(CAST(review_score AS DOUBLE)) FROM dash
       UNION ALL SELECT 'Mode Review Score', CAST((SELECT review_score FROM dash GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS DOUBLE)""",
)
def e10(d: Data):
    return rounded(kpis.score_summary(d.view), 6, "value")


_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "e19_pivot_and_melt",
    f"""WITH m AS (SELECT DISTINCT strftime(order_purchase_timestamp, '%Y-%m') AS month FROM c_orders),
        p AS (SELECT DISTINCT payment_type FROM c_payments),
        g AS (SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, payment_type, {money('payment_value')} AS total
              FROM c_orders JOIN c_payments USING (order_id) GROUP BY ALL)
        SELECT month, payment_type, coalesce(total, 0) AS total FROM (SELECT * FROM m, p) LEFT JOIN g USING (month, payment_type)""",
)
def e19(d: Data):
    paid = d["orders"].select("order_id", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month"))
    return agg.dense_grid(paid.join(d["order_payments"], "order_id"), "month", "payment_type", "payment_value")


def _live(minutes: int) -> str:
    return f"""SELECT created_date, salesordernumber, count(*) AS num_transactions, count(DISTINCT salesordernumber) AS num_orders,
        CAST(trunc(round(sum(CAST(salesamount AS DECIMAL(38,10))), 2)) AS INTEGER) AS sales FROM c_sales
        WHERE created_date >= (SELECT max(created_date) FROM c_sales) - INTERVAL {minutes} MINUTE GROUP BY ALL"""


@query(
    "e20_live_sales",
    f"SELECT strftime(created_date, '%Y-%m-%d %H:%M:%S') AS created_date, * EXCLUDE (created_date) FROM ({_live(10000)})",
)
def e20(d: Data):
    return text(kpis.live_sales(d["live_sales"], 10_000), "created_date")


@query(
    "e20_live_net_sales",
    """SELECT strftime(created_date, '%Y-%m-%d %H:%M:%S') AS created_date, salesordernumber, count(*) AS num_transactions,
        count(DISTINCT salesordernumber) AS num_orders,
        CAST(trunc(round(sum(CAST(salesamount * 0.9375 AS DECIMAL(38,10))), 2)) AS INTEGER) AS sales FROM c_sales
        WHERE created_date >= (SELECT max(created_date) FROM c_sales) - INTERVAL 10000 MINUTE GROUP BY created_date, salesordernumber""",
)
def e20_net(d: Data):
    """Amounts after a fee of a sixteenth, which have parts of a cent."""
    net = d["live_sales"].withColumn("salesamount", F.col("salesamount") * 0.9375)
    return text(kpis.live_sales(net, 10_000), "created_date")


@query(
    "e4_discounts_by_supplier",
    f"""SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey,
        {money("CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(9,4))")} AS discounts FROM lineitem GROUP BY l_suppkey""",
)
def e4_discounts(d: Data):
    """Sums of amounts below a cent, which must not be rounded before they are added."""
    given = F.col("l_extendedprice").cast("decimal(18,4)") * F.col("l_discount").cast("decimal(9,4)")
    return d.raw("lineitem").groupBy(F.col("l_suppkey").cast("bigint").alias("l_suppkey")).agg(agg.money_sum(given).alias("discounts"))


TOTALS_SQL = " UNION ALL ".join(
    f"""SELECT CAST({m} AS INTEGER) AS minutes, CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
        CAST(sum(num_orders) AS BIGINT) AS num_orders, CAST(sum(sales) AS BIGINT) AS sales FROM ({_live(m)})"""
    for m in (60, 30, 10, 5)
)


@query("e20_live_totals", TOTALS_SQL)
def e20b(d: Data):
    return kpis.live_totals(d["live_sales"])


@query(
    "e21_melt_group_means",
    f"""WITH g AS (SELECT seller_state, round({money('price')} / count(*), 6) AS price, round({money('freight_value')} / count(*), 6) AS freight_value
              FROM wide GROUP BY 1)
        SELECT seller_state, 'price' AS feature, price AS mean_value FROM g UNION ALL SELECT seller_state, 'freight_value', freight_value FROM g""",
)
def e21(d: Data):
    means = d.wide.groupBy("seller_state").agg(
        agg.money_avg("price").alias("price"), agg.money_avg("freight_value").alias("freight_value")
    )
    return rounded(agg.melt(means, ["seller_state"], "feature", "mean_value"), 6, "mean_value")


@query(
    "e22_crosstab",
    "SELECT review_score, "
    + ", ".join(f"""count(*) FILTER (WHERE payment_type = '{t}') AS "{t}" """ for t in _TYPES)
    + " FROM raw_wide GROUP BY review_score",
)
def e22(d: Data):
    return agg.crosstab(d.counted_raw(reviews=["review_score"], payments=["payment_type"]), "review_score", "payment_type")


@query(
    "e23_orders_per_quarter",
    """WITH s AS (SELECT date_trunc('quarter', order_purchase_timestamp) AS q, CAST(sum(num_orders) AS BIGINT) AS n FROM frows GROUP BY 1),
       t AS (SELECT unnest(generate_series((SELECT min(q) FROM s)::TIMESTAMP, (SELECT max(q) FROM s)::TIMESTAMP, INTERVAL 3 MONTH)) AS q)
       SELECT strftime(last_day(t.q + INTERVAL 2 MONTH), '%Y-%m-%d') AS quarter_end, coalesce(n, 0) AS num_orders FROM t LEFT JOIN s ON t.q = s.q""",
)
def e23(d: Data):
    per_order = d.facts.orders.join(d.facts.customers.select("customer_unique_id", "num_orders"), "customer_unique_id")
    weighted = per_order.withColumn("num_orders", F.col("num_orders") * F.col("n_rows"))
    return explore.orders_by_quarter(weighted).withColumn("quarter_end", F.col("quarter_end").cast("string"))


@query(
    "e24_late_by_time_and_region",
    f"""SELECT {stamp('order_purchase_timestamp')} AS order_purchase_timestamp, {REGION_SQL} AS region,
        CAST(sum(late_deliveries) AS BIGINT) AS late_deliveries FROM frows GROUP BY ALL""",
)
def e24(d: Data):
    rows = d.wide.withColumn("late_deliveries", late_column())
    return text(explore.late_by_time_and_region(rows, REGIONS), "order_purchase_timestamp")


@query(
    "e25_groups_above_limit",
    """SELECT customer_state, customer_city, count(DISTINCT customer_unique_id) AS n FROM c_customers GROUP BY ALL HAVING count(DISTINCT customer_unique_id) > 2""",
)
def e25(d: Data):
    grouped = d["customers"].groupBy("customer_state", "customer_city").agg(F.count_distinct("customer_unique_id").alias("n"))
    return grouped.filter(F.col("n") > 2)


@query(
    "e26_state_city_rollup",
    """WITH g AS (SELECT customer_state, customer_city, count(*) AS n FROM c_customers GROUP BY ALL)
       SELECT customer_state, customer_city, CAST(sum(n) AS BIGINT) AS n, CAST(grouping(customer_state, customer_city) AS INTEGER) AS level
       FROM g GROUP BY ROLLUP (customer_state, customer_city)""",
)
def e26(d: Data):
    return agg.state_city_totals(agg.counts(d["customers"], "customer_state", "customer_city"), "customer_state", "customer_city", "n")


_GAPS = f"""WITH r AS (SELECT review_score, {days('order_delivered_carrier_date', 'order_approved_at')} AS approved_carrier,
    {days('order_delivered_customer_date', 'order_delivered_carrier_date')} AS carrier_delivered,
    {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delivered_estimated,
    {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS purchased_delivered FROM c_reviews JOIN c_orders USING (order_id))"""


@query(
    "e27_on_time_and_late_means",
    _GAPS
    + " UNION ALL ".join(
        f""" SELECT '{m}' AS metric, round(avg({m}) FILTER (WHERE delivered_estimated > 0), 6) AS on_time,
             round(avg({m}) FILTER (WHERE delivered_estimated < 0), 6) AS late FROM r"""
        for m in ("review_score", "approved_carrier", "carrier_delivered", "delivered_estimated", "purchased_delivered")
    ),
)
def e27(d: Data):
    from cartlens.plans.wide import with_intervals

    rows = d["order_reviews"].select("order_id", "review_score").join(with_intervals(d["orders"]), "order_id")
    return rounded(explore.delivery_comparison(rows), 6, "on_time", "late")


@query("e33_distinct_values", "SELECT DISTINCT customer_state, payment_type FROM raw_wide")
def e33(d: Data):
    return agg.distinct_values(d.counted_raw("customer_state", payments=["payment_type"]), "customer_state", "payment_type")


@query(
    "e34_basket_size",
    "SELECT basket_size, count(*) AS orders FROM (SELECT order_id, count(*) AS basket_size FROM c_items GROUP BY order_id) GROUP BY basket_size",
)
def e34(d: Data):
    return kpis.basket_sizes(d["order_items"])
