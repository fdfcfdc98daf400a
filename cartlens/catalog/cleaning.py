"""B: filters, null handling, de-duplication and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import stamp
from cartlens.catalog.registry import Data, query, rounded, text
from cartlens.functions import dates, labels
from cartlens.operators import aggregates as agg
from cartlens.operators import clean, profile, quantiles
from cartlens.plans import wide
from cartlens.session import materialize
from cartlens.streaming.joins import PRODUCT_DEFAULTS


@query("b1_delivered_orders", "SELECT order_id, customer_id, order_status FROM c_orders WHERE order_status = 'delivered'")
def b1(d: Data):
    return clean.keep_status(d["orders"]).select("order_id", "customer_id", "order_status")


@query(
    "b2_fill_delivery_date",
    f"SELECT order_id, {stamp('coalesce(order_delivered_customer_date, order_estimated_delivery_date)')} AS order_delivered_customer_date FROM c_orders",
)
def b2(d: Data):
    filled = clean.fill_from(d["orders"], "order_delivered_customer_date", "order_estimated_delivery_date")
    return text(filled.select("order_id", "order_delivered_customer_date"), "order_delivered_customer_date")


@query("b3_drop_columns", "SELECT product_id, product_category_name FROM c_products")
def b3(d: Data):
    return d["products"].drop(*wide.PRODUCT_DROPS)


@query("b4_fill_category", "SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name FROM c_products")
def b4(d: Data):
    return wide.clean_products(d["products"]).select("product_id", "product_category_name")


@query(
    "b5_fill_many_columns",
    """SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name,
       coalesce(product_name_lenght, 48.0) AS product_name_lenght,
       coalesce(product_description_lenght, 771.0) AS product_description_lenght,
       coalesce(product_photos_qty, 2.0) AS product_photos_qty FROM c_products""",
)
def b5(d: Data):
    return clean.fill_values(d["products"], PRODUCT_DEFAULTS).select("product_id", *PRODUCT_DEFAULTS)


_SCORED = "o AS (SELECT order_id, review_score FROM c_orders LEFT JOIN c_some_reviews USING (order_id))"


@query(
    "b6_impute_truncated_mean",
    f"""WITH {_SCORED}, m AS (SELECT CAST(trunc(avg(coalesce(review_score, 0))) AS INTEGER) AS v FROM o)
        SELECT order_id, CAST(coalesce(review_score, v) AS INTEGER) AS review_score FROM o, m""",
)
def b6(d: Data):
    scored = d["orders"].select("order_id").join(d["some_reviews"].select("order_id", "review_score"), "order_id", "left")
    return clean.impute_truncated_mean(scored, "review_score")


@query("b7_require_review_columns", "SELECT review_id, order_id, review_score FROM d_reviews")
def b7(d: Data):
    return wide.clean_reviews(d["order_reviews"]).select("review_id", "order_id", "review_score")


_ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
)


@query(
    "b8_null_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS null_count,
            round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_percent FROM c_orders"""
        for c in _ORDER_COLUMNS
    ),
)
def b8(d: Data):
    return rounded(clean.null_report(d["orders"]), 6, "null_percent")


@query(
    "b9_null_rows_report",
    """WITH n AS (SELECT CAST((review_comment_title IS NULL)::INT + (review_comment_message IS NULL)::INT
                 + (review_answer_timestamp IS NULL)::INT AS INTEGER) AS n FROM c_reviews)
       SELECT count(*) FILTER (WHERE n > 0) AS rows_with_null, count(*) FILTER (WHERE n = 0) AS rows_without_null,
              max(n) AS max_nulls_in_row FROM n""",
)
def b9(d: Data):
    return clean.null_rows_report(d["order_reviews"])


@query("b10_before_month", "SELECT order_id FROM c_orders WHERE order_purchase_timestamp < TIMESTAMP '2001-07-01'")
def b10(d: Data):
    return clean.before_month(d["orders"], "order_purchase_timestamp", "2001-07").select("order_id")


@query(
    "b11_in_lists",
    """SELECT order_id, seller_state, customer_state FROM wide
       WHERE seller_state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_7', 'NATION_9')
         AND customer_state IN ('NATION_1', 'NATION_2', 'NATION_4', 'NATION_8', 'NATION_11')""",
)
def b11(d: Data):
    lists = {
        "seller_state": ["NATION_1", "NATION_2", "NATION_3", "NATION_7", "NATION_9"],
        "customer_state": ["NATION_1", "NATION_2", "NATION_4", "NATION_8", "NATION_11"],
    }
    return clean.in_lists(d.wide, lists).select("order_id", "seller_state", "customer_state")


@query(
    "b12_year_month_predicate",
    """SELECT order_id FROM c_orders WHERE year(order_purchase_timestamp) = 2000 AND month(order_purchase_timestamp) > 8""",
)
def b12(d: Data):
    return clean.in_year_from_month(d["orders"], "order_purchase_timestamp", 2000, 8).select("order_id")


_ITEM_KEYS = "order_id, order_item_id"


@query(
    "b13_duplicate_report",
    f"""WITH g AS (SELECT {_ITEM_KEYS}, count(*) AS n FROM c_items GROUP BY ALL)
        SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows FROM g""",
)
def b13(d: Data):
    return clean.duplicate_report(d["order_items"].select("order_id", "order_item_id"))


@query("b13_drop_duplicates", f"SELECT DISTINCT {_ITEM_KEYS} FROM c_items")
def b13b(d: Data):
    return clean.drop_duplicates(d["order_items"].select("order_id", "order_item_id"))


def _one_review(direction: str) -> str:
    return f"""SELECT DISTINCT ON (order_id) order_id, review_id, review_score FROM c_reviews
               ORDER BY order_id, review_creation_date {direction}, review_id {direction}"""


@query("b14_first_review_per_order", _one_review("ASC"))
def b14(d: Data):
    one = clean.keep_one(d["order_reviews"], ["order_id"], ["review_creation_date", "review_id"])
    return one.select("order_id", "review_id", "review_score")


@query("b14_last_review_per_order", _one_review("DESC"))
def b14b(d: Data):
    one = clean.keep_one(d["order_reviews"], ["order_id"], ["review_creation_date", "review_id"], last=True)
    return one.select("order_id", "review_id", "review_score")


def _z(column: str) -> str:
    return f"abs(({column} - (SELECT avg({column}) FROM i)) / (SELECT stddev_pop({column}) FROM i))"


_I = """WITH i AS (SELECT order_id, product_id, price, freight_value, payment_installments
                  FROM c_items JOIN c_payments USING (order_id))"""


def _item_rows(d: Data):
    rows = d["order_items"].select("order_id", "product_id", "price", "freight_value")
    return rows.join(d["order_payments"].select("order_id", "payment_installments"), "order_id")


@query("b15_zscore_last_column", f"{_I} SELECT * FROM i WHERE {_z('freight_value')} < 1.5")
def b15(d: Data):
    columns = ["payment_installments", "price", "freight_value"]
    return profile.zscore_filter(_item_rows(d), columns, limit=1.5)


@query(
    "b15_zscore_all_columns",
    f"{_I} SELECT * FROM i WHERE {_z('payment_installments')} < 1.5 AND {_z('price')} < 1.5 AND {_z('freight_value')} < 1.5",
)
def b15b(d: Data):
    columns = ["payment_installments", "price", "freight_value"]
    return profile.zscore_filter(_item_rows(d), columns, limit=1.5, mode="all")


def _limits(column: str) -> str:
    return f"""l AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
               (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM c_items))"""


@query(
    "b16_iqr_fence",
    f"WITH {_limits('freight_value')} SELECT order_id, product_id, freight_value FROM c_items, l WHERE freight_value >= lo AND freight_value <= hi",
)
def b16(d: Data):
    return quantiles.iqr_filter(d["order_items"], "freight_value").select("order_id", "product_id", "freight_value")


@query(
    "b16_iqr_fence_strict",
    f"WITH {_limits('freight_value')} SELECT order_id, product_id, freight_value FROM c_items, l WHERE freight_value > lo AND freight_value < hi",
)
def b16b(d: Data):
    strict = quantiles.iqr_filter(d["order_items"], "freight_value", strict=True)
    return strict.select("order_id", "product_id", "freight_value")


@query(
    "b16_iqr_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(lo, 6) AS low_limit, round(hi, 6) AS high_limit,
            count(*) FILTER (WHERE {c} > lo AND {c} < hi) AS inliers,
            count(*) FILTER (WHERE NOT ({c} > lo AND {c} < hi)) AS outliers
            FROM c_items, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
                (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM c_items)) GROUP BY lo, hi"""
        for c in ("price", "freight_value")
    ),
)
def b16c(d: Data):
    return rounded(quantiles.iqr_counts(d["order_items"], ["price", "freight_value"]), 6, "low_limit", "high_limit")


@query(
    "b17_quantile_trim",
    """WITH a AS (SELECT product_id, product_weight_g AS w FROM c_products
                  WHERE product_weight_g < (SELECT quantile_cont(product_weight_g, 0.78) FROM c_products))
       SELECT product_id, w AS product_weight_g FROM a WHERE w > (SELECT quantile_cont(w, 0.05) FROM a)""",
)
def b17(d: Data):
    return quantiles.quantile_trim(d["products"], "product_weight_g").select("product_id", "product_weight_g")


@query(
    "b18_numeric_columns",
    """SELECT payment_installments, payment_value, order_id, payment_sequential FROM c_payments""",
)
def b18(d: Data):
    payments = d["order_payments"]
    return payments.select(*clean.columns_of_type(payments, "numeric"))


_LOW = ("order_status", "payment_type", "payment_installments", "customer_state")


@query(
    "b19_low_cardinality_values",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM raw_wide
            WHERE (SELECT count(DISTINCT {c}) FROM raw_wide) < 10 GROUP BY {c}"""
        for c in _LOW
    ),
)
def b19(d: Data):
    """From counted combinations of the columns; they are written once, as three passes read them."""
    rows = d.counted_raw("order_status", "customer_state", payments=["payment_type", "payment_installments"])
    rows = materialize(rows.groupBy(*_LOW).agg(F.sum(agg.JOINED_ROWS).alias(agg.JOINED_ROWS)), "low-cardinality")
    return agg.value_listing(rows, agg.low_cardinality_columns(rows, 10, _LOW))


@query("b20_rename", "SELECT customer_id, order_id AS num_orders FROM c_orders")
def b20(d: Data):
    return d["orders"].select("customer_id", "order_id").withColumnsRenamed({"order_id": "num_orders"})


_SELLER = ("seller_id", "seller_city", "seller_state")
_REVIEW = ("review_id", "order_id", "review_score")


@query("b21_projection_union", "SELECT seller_id, seller_city, seller_state, review_id, order_id, review_score FROM dash")
def b21(d: Data):
    return d.view.select(*clean.projection(_SELLER, _REVIEW, _SELLER))


@query(
    "b22_casts",
    f"""SELECT CAST(product_id AS VARCHAR) AS product_id, {stamp('shipping_limit_date')} AS shipping_limit_date,
        CAST(NULL AS VARCHAR) AS unparsable FROM c_items""",
)
def b22(d: Data):
    as_text = d["order_items"].select(
        F.col("product_id").cast("string").alias("product_id"),
        F.date_format("shipping_limit_date", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
    )
    parsed = as_text.select(
        "product_id",
        dates.parse_timestamp(F.col("stamp")).alias("shipping_limit_date"),
        dates.parse_timestamp(F.concat(F.lit("x"), "stamp")).cast("string").alias("unparsable"),
    )
    return text(parsed, "shipping_limit_date")


@query(
    "b23_null_safe_flag",
    """SELECT order_id, CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late FROM c_orders""",
)
def b23(d: Data):
    late = labels.flag(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))
    return d["orders"].select("order_id", late.alias("late"))
