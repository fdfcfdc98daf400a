"""D, F, G, H: joins, per-key values next to rows, top-k and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import FIVE, days, money, qcut, stamp
from cartlens.catalog.registry import Data, query, rounded, text
from cartlens.functions import dates, labels
from cartlens.operators import aggregates as agg
from cartlens.operators import clean
from cartlens.operators.keyjoin import attach_per_key
from cartlens.plans import rfm, wide
from cartlens.session import materialize, scratch_path
from cartlens.sources import bucketed

_WIDE_COLUMNS = (
    "order_id", "customer_id", "product_id", "seller_id", "order_item_id", "price", "freight_value", "payment_type",
    "payment_value", "review_id", "review_score", "customer_unique_id", "customer_state", "seller_state",
    "product_category_name_english",
)


@query("d1_wide_join", f"SELECT {', '.join(_WIDE_COLUMNS)}, {stamp('order_delivered_customer_date')} AS delivered FROM wide")
def d1(d: Data):
    joined = wide.build_wide(d.tables)
    return text(joined.select(*_WIDE_COLUMNS, F.col("order_delivered_customer_date").alias("delivered")), "delivered")


@query("d1_wide_join_with_hot_orders", f"SELECT {', '.join(_WIDE_COLUMNS)} FROM wide")
def d1b(d: Data):
    """The same join with the orders that hold most rows spread over several tasks."""
    hot = wide.hot_orders(d.tables, part_rows=10)
    return wide.build_wide(d.tables, hot=hot).select(*_WIDE_COLUMNS)


@query("d1_bucketed_wide_join", f"SELECT {', '.join(_WIDE_COLUMNS)} FROM wide")
def d1c(d: Data):
    """The same join over order tables that are stored in buckets of the order, some orders apart."""
    prefix = f"shop_{uuid.uuid4().hex}"
    hot = wide.hot_orders(d.tables, part_rows=10)
    bucketed.write_order_tables(d.cleaned, prefix, scratch_path(d.spark, "buckets"), buckets=8, hot=hot)
    return bucketed.join_stored(d.spark, prefix, d.cleaned).select(*_WIDE_COLUMNS)


_PER_PERSON = f"""p AS (SELECT customer_unique_id, count(*) AS frequency, {money('payment_value')} AS monetary_value,
    {days('max(order_purchase_timestamp)', 'min(order_purchase_timestamp)')} AS customer_tenure
    FROM c_orders JOIN c_customers USING (customer_id) JOIN c_payments USING (order_id) GROUP BY customer_unique_id)"""


def _person_orders(d: Data):
    return (
        d["orders"]
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(d["customers"].select("customer_id", "customer_unique_id"), "customer_id")
        .join(d["order_payments"].select("order_id", "payment_value"), "order_id")
    )


def _per_person(rows):
    return rows.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("frequency"),
        agg.money_sum("payment_value").alias("monetary_value"),
        dates.whole_days(F.max("order_purchase_timestamp"), F.min("order_purchase_timestamp")).alias("customer_tenure"),
    )


def _with_person(d: Data):
    rows = _person_orders(d)
    people = materialize(_per_person(rows), "people")
    return attach_per_key(rows, people, "customer_unique_id", "frequency", ["order_id"], how="left")


@query(
    "d2_left_join_aggregate",
    f"""WITH {_PER_PERSON} SELECT order_id, customer_unique_id, customer_tenure
        FROM c_orders JOIN c_customers USING (customer_id) JOIN c_payments USING (order_id) LEFT JOIN p USING (customer_unique_id)""",
)
def d2(d: Data):
    return _with_person(d).select("order_id", "customer_unique_id", "customer_tenure")


@query(
    "d3_map_aggregate",
    f"""WITH {_PER_PERSON} SELECT order_id, frequency, monetary_value
        FROM c_orders JOIN c_customers USING (customer_id) JOIN c_payments USING (order_id) JOIN p USING (customer_unique_id)""",
)
def d3(d: Data):
    return _with_person(d).select("order_id", "frequency", "monetary_value")


@query(
    "d4_projected_join",
    f"""SELECT order_id, review_score, CAST({days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS DOUBLE) AS delivered_estimated,
        {days('order_approved_at', 'order_purchase_timestamp')} AS purchased_approved,
        CAST({days('order_delivered_customer_date', 'order_delivered_carrier_date')} AS DOUBLE) AS carrier_delivered
        FROM c_reviews JOIN c_orders USING (order_id)""",
)
def d4(d: Data):
    reviews = d["order_reviews"].select("order_id", "review_score")
    gaps = wide.with_intervals(d["orders"]).select(
        "order_id",
        F.col("delivered_estimated").cast("double").alias("delivered_estimated"),
        "purchased_approved",
        F.col("carrier_delivered").cast("double").alias("carrier_delivered"),
    )
    return reviews.join(gaps, "order_id")


@query("d7_orders_without_review", "SELECT order_id FROM c_orders ANTI JOIN c_some_reviews USING (order_id)")
def d7(d: Data):
    return agg.without(d["orders"].select("order_id"), d["some_reviews"], "order_id")


@query(
    "d8_rows_of_top_categories",
    """WITH t AS (SELECT product_category_name_english AS c FROM wide GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
       SELECT order_id, product_id, product_category_name_english FROM wide WHERE product_category_name_english IN (SELECT c FROM t)""",
)
def d8(d: Data):
    rows = d.wide.select("order_id", "product_id", "product_category_name_english")
    return agg.keep_top_keys(rows, "product_category_name_english", 3, F.count(F.lit(1)))


_RATED = "r AS (SELECT DISTINCT customer_unique_id, product_id FROM wide)"
_BUSIEST = "b AS (SELECT customer_unique_id FROM r GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "d9_unrated_items_of_customer",
    f"""WITH {_RATED}, {_BUSIEST} SELECT DISTINCT product_id FROM r
        WHERE product_id NOT IN (SELECT product_id FROM r WHERE customer_unique_id = (SELECT customer_unique_id FROM b))""",
)
def d9(d: Data):
    from cartlens.models.recommend import unrated_items

    rated = d.wide.select("customer_unique_id", "product_id").distinct()
    sizes = agg.counts(rated, "customer_unique_id")
    busiest = sizes.orderBy(F.desc("n"), "customer_unique_id").limit(1).select("customer_unique_id").scalar()
    return unrated_items(rated, busiest, "customer_unique_id", "product_id")


@query(
    "d10_align_to_list",
    """WITH l AS (SELECT CAST(i - 1 AS INTEGER) AS position, ['1-URGENT', '9-UNUSED', '3-MEDIUM', '2-HIGH'][i] AS payment_type FROM range(1, 5) r(i)),
       c AS (SELECT payment_type, count(*) AS n FROM c_payments GROUP BY 1) SELECT position, payment_type, CAST(n AS DOUBLE) AS n FROM l LEFT JOIN c USING (payment_type)""",
)
def d10(d: Data):
    found = agg.counts(d["order_payments"], "payment_type").withColumn("n", F.col("n").cast("double"))
    return agg.align_to(found, "payment_type", ["1-URGENT", "9-UNUSED", "3-MEDIUM", "2-HIGH"])


# -- F: window-shaped ---------------------------------------------------------------------

_SCORE_COLUMNS = "customer_unique_id, recency, frequency, monetary_value, recency_score, frequency_score, monetary_score"


@query(
    "f1_quartile_scores",
    f"SELECT {_SCORE_COLUMNS}, count(*) AS n_rows FROM scored GROUP BY ALL",
)
def f1(d: Data):
    return rfm.rfm_scores(d.facts).select(*_SCORE_COLUMNS.split(", "), "n_rows")


def _customer_scored(invert: bool) -> str:
    recency = qcut("last_recency", "qr")
    if invert:
        recency = f"CAST(3 - {recency} AS INTEGER)"
    return f"""s AS (SELECT customer_unique_id, {recency} AS recency_score, {qcut('frequency', 'qf')} AS frequency_score,
        {qcut('monetary_value', 'qm')} AS monetary_score FROM feat,
        (SELECT quantile_cont(CAST(last_recency AS DOUBLE), {FIVE}) AS qr, quantile_cont(CAST(frequency AS DOUBLE), {FIVE}) AS qf,
                quantile_cont(monetary_value, {FIVE}) AS qm FROM feat))"""


@query(
    "f1_quartile_scores_per_customer",
    f"WITH {_customer_scored(True)} SELECT * FROM s",
)
def f1b(d: Data):
    scored = rfm.rfm_scores(d.facts, grain="customer", invert_recency=True)
    return scored.select("customer_unique_id", "recency_score", "frequency_score", "monetary_score")


@query(
    "f2_rfm_score",
    """SELECT customer_unique_id, recency, rfm_score, segment, count(*) AS n_rows FROM scored GROUP BY ALL""",
)
def f2(d: Data):
    return rfm.rfm_scores(d.facts).groupBy("customer_unique_id", "recency", "rfm_score", "segment").agg(
        F.sum("n_rows").alias("n_rows")
    )


@query(
    "f2_rfm_score_lowest_included",
    f"""WITH {_customer_scored(False)}, t AS (SELECT *, recency_score + frequency_score + monetary_score AS rfm_score FROM s)
        SELECT customer_unique_id, rfm_score, CASE WHEN rfm_score <= 3 THEN 'Inactive' WHEN rfm_score <= 6 THEN 'Regular' ELSE 'Engaged' END AS segment FROM t""",
)
def f2b(d: Data):
    scored = rfm.rfm_scores(d.facts, grain="customer", include_lowest=True)
    return scored.select("customer_unique_id", "rfm_score", "segment")


@query(
    "f3_features_next_to_rows",
    """SELECT order_id, product_id, seller_id, customer_unique_id, recency, late_deliveries, frequency, monetary_value, customer_tenure, num_orders FROM frows""",
)
def f3(d: Data):
    return d.facts.rows().select(
        "order_id", "product_id", "seller_id", "customer_unique_id", "recency", "late_deliveries", "frequency",
        "monetary_value", "customer_tenure", "num_orders",
    )


@query(
    "f4_first_item_per_order",
    """SELECT DISTINCT ON (order_id) order_id, order_item_id, product_id, price FROM c_items
       ORDER BY order_id, order_item_id, product_id, price""",
)
def f4(d: Data):
    items = d["order_items"].select("order_id", "order_item_id", "product_id", "price")
    return clean.keep_one(items, ["order_id"], ["order_item_id", "product_id", "price"])


@query(
    "f5_share_of_total",
    f"""WITH g AS (SELECT customer_state, {money('payment_value')} AS total FROM c_customers JOIN c_payments ON customer_id = order_id GROUP BY 1)
        SELECT customer_state, total, round(100.0::DOUBLE * total / (SELECT sum(total) FROM g), 6) AS share FROM g""",
)
def f5(d: Data):
    paid = d["customers"].join(d["order_payments"], F.col("customer_id") == F.col("order_id"))
    totals = paid.groupBy("customer_state").agg(agg.money_sum("payment_value").alias("total"))
    return rounded(agg.share_of_total(totals, "total", "share"), 6, "share")


@query(
    "f6_top_items_per_customer",
    """WITH g AS (SELECT customer_unique_id, product_id, max(review_score) AS score, count(*) AS n FROM wide GROUP BY ALL)
       SELECT customer_unique_id, product_id, score, n, CAST(row_number() OVER (PARTITION BY customer_unique_id ORDER BY score DESC, n DESC, product_id) AS INTEGER) AS place
       FROM g QUALIFY place <= 5""",
)
def f6(d: Data):
    scored = d.wide.groupBy("customer_unique_id", "product_id").agg(
        F.max("review_score").alias("score"), F.count(F.lit(1)).alias("n")
    )
    return agg.top_per_group(scored, "customer_unique_id", 5, [F.desc("score"), F.desc("n"), F.asc("product_id")])


# -- G, H ----------------------------------------------------------------------------------


@query(
    "g1_top_products",
    f"SELECT product_id, {money('price')} AS revenue FROM c_items GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 10",
)
def g1(d: Data):
    revenue = d["order_items"].groupBy("product_id").agg(agg.money_sum("price").alias("revenue"))
    return agg.top_k(revenue, "revenue", 10, ["product_id"])


@query("g2_sorted_by_key", "SELECT payment_installments, count(*) AS n FROM c_payments GROUP BY 1 ORDER BY 1")
def g2(d: Data):
    return agg.counts(d["order_payments"], "payment_installments").orderBy("payment_installments")


@query(
    "g3_largest_keys",
    "SELECT customer_city, count(*) AS n FROM c_customers GROUP BY 1 ORDER BY n DESC, customer_city LIMIT 10",
)
def g3(d: Data):
    return agg.top_k(agg.counts(d["customers"], "customer_city"), "n", 10, ["customer_city"])


@query(
    "g4_custom_order",
    """WITH l AS (SELECT CAST(i - 1 AS INTEGER) AS position,
              ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i] AS weekday FROM range(1, 8) r(i))
       SELECT position, weekday, n FROM l LEFT JOIN (SELECT dayname(order_purchase_timestamp) AS weekday, count(*) AS n FROM c_orders GROUP BY 1) USING (weekday)""",
)
def g4(d: Data):
    days_ = d["orders"].select(dates.weekday_name(F.col("order_purchase_timestamp")).alias("weekday"))
    return agg.align_to(agg.counts(days_, "weekday"), "weekday", labels.WEEKDAYS)


@query(
    "h1_append_row",
    """SELECT order_status AS label, count(*) AS n FROM c_orders GROUP BY 1
       UNION ALL SELECT 'No review', count(*) FROM c_orders ANTI JOIN c_some_reviews USING (order_id)""",
)
def h1(d: Data):
    found = agg.counts(d["orders"], "order_status").withColumnRenamed("order_status", "label")
    missing = agg.without(d["orders"], d["some_reviews"], "order_id")
    return agg.append_row(found, missing.agg(F.lit("No review").alias("label"), F.count(F.lit(1)).alias("n")))


@query("h3_set_difference", "SELECT product_id FROM c_products EXCEPT SELECT product_id FROM c_items JOIN d_orders USING (order_id)")
def h3(d: Data):
    sold = d["order_items"].join(wide.clean_orders(d["orders"]).select("order_id"), "order_id").select("product_id")
    return agg.set_difference(d["products"].select("product_id"), sold)


@query("h4_distinct_rows", "SELECT DISTINCT customer_state, customer_city FROM c_customers")
def h4(d: Data):
    return clean.drop_duplicates(d["customers"].select("customer_state", "customer_city"))
