"""SQL twins of the table mapping, written for DuckDB over the raw parquet views."""

from __future__ import annotations

import re


def days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def money(column: str) -> str:
    """Exact sum. Doubles pass through text, as the direct casts from and to so wide a decimal are off in the last digit."""
    return f"CAST(CAST(coalesce(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,10))), 0) AS VARCHAR) AS DOUBLE)"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def review_lag(d: str) -> str:
    return (
        f"CASE WHEN {d} < 0 THEN 'Before Delivery' WHEN {d} = 0 THEN 'Within 1 day' "
        f"WHEN {d} <= 7 THEN 'Within 1 Week' WHEN {d} <= 31 THEN 'Within 1 Month' ELSE 'After 1 Month' END"
    )


def answer_lag(d: str) -> str:
    return (
        f"CASE WHEN {d} = 0 THEN 'Within 1 day' WHEN {d} <= 2 THEN 'Within 2 days' "
        f"WHEN {d} <= 7 THEN 'Within 1 Week' WHEN {d} <= 31 THEN 'Within 1 Month' ELSE 'After 1 Month' END"
    )


def qcut(x: str, q: str) -> str:
    """Quartile score from a five-number list; equal edges collapse."""
    return (
        f"CAST((CASE WHEN {q}[2] > {q}[1] AND {x} > {q}[2] THEN 1 ELSE 0 END"
        f" + CASE WHEN {q}[3] > {q}[2] AND {x} > {q}[3] THEN 1 ELSE 0 END"
        f" + CASE WHEN {q}[4] > {q}[3] AND {x} > {q}[4] THEN 1 ELSE 0 END) AS INTEGER)"
    )


FIVE = "[0.0, 0.25, 0.5, 0.75, 1.0]"

CTES = {
    "c_orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + to_hours(36 + o_orderkey % 24) AS order_approved_at,
               o_orderdate + to_hours(48 + o_orderkey % 72) AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_hours((o_orderkey % 41) * 19) END AS order_delivered_customer_date,
               o_orderdate + to_hours(600) AS order_estimated_delivery_date
        FROM orders""",
    "c_customers": """
        SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
               CAST(c_custkey % 1000 AS INTEGER) AS customer_zip_code_prefix,
               'CITY_' || (c_custkey % 40) AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "c_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS freight_value
        FROM lineitem""",
    "c_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
               CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments, o_totalprice AS payment_value
        FROM orders""",
    "c_reviews": """
        SELECT o_orderkey * 10 + nth AS review_id, o_orderkey AS order_id,
               CASE WHEN nth = 1 THEN 1 ELSE CAST(1 + (o_orderkey * 7) % 5 AS INTEGER) END AS review_score,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'title ' || (o_orderkey % 25) END AS review_comment_title,
               CASE WHEN o_orderkey % 5 = 0 THEN 'message ' || (o_orderkey % 100) END AS review_comment_message,
               o_orderdate + to_hours((o_orderkey % 53) * 21 + nth * 48) AS review_creation_date,
               CASE WHEN o_orderkey % 29 <> 0 THEN
                   o_orderdate + to_hours((o_orderkey % 53) * 21 + nth * 48 + (o_orderkey % 37) * 31 - 20) END AS review_answer_timestamp
        FROM orders JOIN (SELECT 0 AS nth UNION ALL SELECT 1) ON nth = 0 OR o_orderkey % 17 = 0""",
    "c_some_reviews": "SELECT * FROM c_reviews WHERE order_id % 11 <> 0",
    "c_sellers": """
        SELECT s_suppkey AS seller_id, CAST(s_suppkey % 1000 AS INTEGER) AS seller_zip_code_prefix,
               'CITY_' || (s_suppkey % 40) AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "c_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 19 <> 0 THEN lower(p_type) END AS product_category_name,
               CASE WHEN p_partkey % 23 <> 0 THEN CAST(length(p_name) AS DOUBLE) END AS product_name_lenght,
               CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_size * 10 AS DOUBLE) END AS product_description_lenght,
               CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_size % 5 + 1 AS DOUBLE) END AS product_photos_qty,
               CAST(p_size * 100 AS DOUBLE) AS product_weight_g, CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size % 7 + 1 AS DOUBLE) AS product_height_cm, CAST(p_size % 11 + 1 AS DOUBLE) AS product_width_cm
        FROM part""",
    "c_translation": """
        SELECT DISTINCT lower(p_type) AS product_category_name, p_type AS product_category_name_english FROM part""",
    "c_geolocation": """
        SELECT CAST(c_custkey % 1000 AS INTEGER) AS geolocation_zip_code_prefix,
               (c_custkey % 720) / 4.0::DOUBLE - 90.0::DOUBLE AS geolocation_lat,
               (c_custkey % 1440) / 4.0::DOUBLE - 180.0::DOUBLE AS geolocation_lng,
               'CITY_' || (c_custkey % 40) AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "c_sales": """
        SELECT ts AS created_date, CAST(user_id AS VARCHAR) AS salesordernumber, value AS salesamount
        FROM events WHERE event_type = 'purchase'""",
    "d_orders": """
        SELECT * REPLACE (coalesce(order_delivered_customer_date, order_estimated_delivery_date) AS order_delivered_customer_date)
        FROM c_orders WHERE order_status = 'delivered'""",
    "d_products": """
        SELECT * REPLACE (coalesce(product_category_name, 'unknown') AS product_category_name) FROM c_products""",
    "d_reviews": """
        SELECT * FROM c_reviews WHERE order_id IS NOT NULL AND review_id IS NOT NULL AND review_score IS NOT NULL
               AND review_creation_date IS NOT NULL AND review_answer_timestamp IS NOT NULL""",
    "wide": """
        SELECT * FROM d_orders JOIN c_customers USING (customer_id) JOIN c_items USING (order_id)
               JOIN c_payments USING (order_id) JOIN d_reviews USING (order_id) JOIN d_products USING (product_id)
               JOIN c_translation USING (product_category_name) JOIN c_sellers USING (seller_id)""",
    "raw_wide": """
        SELECT * FROM c_orders JOIN c_customers USING (customer_id) JOIN c_items USING (order_id)
               JOIN c_payments USING (order_id) JOIN c_reviews USING (order_id) JOIN c_products USING (product_id)
               JOIN c_translation USING (product_category_name) JOIN c_sellers USING (seller_id)""",
    "dash": f"""
        SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS order_month_year,
               dayname(order_purchase_timestamp) AS weekday,
               CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_purchase_hour,
               {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS difference_purchased_delivered,
               {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS estimated_delivered_difference,
               CASE WHEN {days('order_estimated_delivery_date', 'order_delivered_customer_date')} < 0
                    THEN 'Delay' ELSE 'No Delay' END AS delay_or_no_delay,
               {days('review_answer_timestamp', 'review_creation_date')} AS review_answer_time_difference,
               {days('review_creation_date', 'order_delivered_customer_date')} AS delivery_review_time_difference
        FROM wide WHERE order_status = 'delivered' AND order_purchase_timestamp < TIMESTAMP '2001-07-01'""",
    "feat": f"""
        SELECT customer_unique_id, count(*) AS frequency,
               {money('payment_value')} AS monetary_value,
               {days('max(order_purchase_timestamp)', 'min(order_purchase_timestamp)')} AS customer_tenure,
               count(DISTINCT order_id) AS num_orders,
               CAST(sum(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END) AS BIGINT) AS late_total,
               {days('(SELECT max(order_purchase_timestamp) FROM wide)', 'max(order_purchase_timestamp)')} AS last_recency
        FROM wide GROUP BY customer_unique_id""",
    "frows": f"""
        SELECT w.*, {days('(SELECT max(order_purchase_timestamp) FROM wide)', 'order_purchase_timestamp')} AS recency,
               CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late_deliveries,
               f.frequency, f.monetary_value, f.customer_tenure, f.num_orders
        FROM wide w JOIN feat f USING (customer_unique_id)""",
    "scored": f"""
        SELECT r.*, r.recency_score + r.frequency_score + r.monetary_score AS rfm_score,
               CASE WHEN r.recency_score + r.frequency_score + r.monetary_score BETWEEN 1 AND 3 THEN 'Inactive'
                    WHEN r.recency_score + r.frequency_score + r.monetary_score BETWEEN 4 AND 6 THEN 'Regular'
                    WHEN r.recency_score + r.frequency_score + r.monetary_score BETWEEN 7 AND 9 THEN 'Engaged' END AS segment
        FROM (SELECT customer_unique_id, recency, frequency, monetary_value,
                     {qcut('recency', 'qr')} AS recency_score, {qcut('frequency', 'qf')} AS frequency_score,
                     {qcut('monetary_value', 'qm')} AS monetary_score
              FROM frows, (SELECT quantile_cont(CAST(recency AS DOUBLE), {FIVE}) AS qr,
                                  quantile_cont(CAST(frequency AS DOUBLE), {FIVE}) AS qf,
                                  quantile_cont(monetary_value, {FIVE}) AS qm FROM frows)) r""",
    "churn_raw": """
        SELECT DISTINCT customer_state, price, freight_value, payment_type, payment_installments,
               CAST(coalesce(review_score, (SELECT trunc(avg(coalesce(review_score, 0))) FROM wide)) AS INTEGER) AS review_score,
               recency, frequency, monetary_value, customer_tenure, num_orders,
               CASE WHEN recency > 180 THEN 1 ELSE 0 END AS churn
        FROM frows""",
    "churn_kept": """
        SELECT * FROM churn_raw
        WHERE abs((payment_installments - (SELECT avg(payment_installments) FROM churn_raw))
                  / (SELECT stddev_pop(payment_installments) FROM churn_raw)) < 3""",
}

_NAME = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def with_tables(body: str) -> str:
    """Prefix body with the definitions it uses."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    if not needed:
        return body.strip()
    listed = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    body = body.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    body = body[5:] if joiner == ",\n" else body
    return f"WITH {listed}{joiner}{body}"
