"""A: sources and sinks, each exercised by a round trip over a whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartlens import schemas
from cartlens.catalog.base_sql import money, stamp
from cartlens.catalog.registry import Data, query, text
from cartlens.operators import aggregates as agg
from cartlens.plans.wide import build_wide
from cartlens.session import scratch_path
from cartlens.sources import readers, writers
from cartlens.streaming import sources as stream_sources


def _order_text(d: Data):
    return d["orders"].select(*[F.col(c).cast("string").alias(c) for c in ("order_id", "customer_id")], *d["orders"].columns[2:])


@query(
    "a1_csv_scan",
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
        {stamp('order_purchase_timestamp')} AS order_purchase_timestamp, {stamp('order_delivered_customer_date')} AS order_delivered_customer_date FROM c_orders""",
)
def a1(d: Data):
    path = scratch_path(d.spark, "orders-csv")
    writers.write_csv(_order_text(d), path)
    orders = readers.read_csv(d.spark, path, schemas.ORDERS)
    kept = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date")
    return text(orders.select(*kept), "order_purchase_timestamp", "order_delivered_customer_date")


@query(
    "a1_csv_scan_inferred",
    "SELECT payment_type, payment_installments, payment_value FROM c_payments",
)
def a1b(d: Data):
    path = scratch_path(d.spark, "payments-csv")
    writers.write_csv(d["order_payments"], path)
    return readers.read_csv(d.spark, path).select("payment_type", "payment_installments", "payment_value")


@query(
    "a2_table_projection",
    "SELECT customer_id, product_id, product_category_name_english, review_score FROM wide",
)
def a2(d: Data):
    name = f"wide_{uuid.uuid4().hex}"
    writers.write_state_table(build_wide(d.tables), name, scratch_path(d.spark, "wide-table"))
    return readers.read_table(d.spark, name, ["customer_id", "product_id", "product_category_name_english", "review_score"])


@query("a3_parquet_with_schema", "SELECT p_partkey, p_type, p_size FROM part")
def a3(d: Data):
    return readers.read_parquet(d.spark, f"{d.folder}/part.parquet", "p_partkey bigint, p_type string, p_size int")


@query("a7_csv_sink", f"SELECT product_id, {money('price')} AS revenue FROM c_items GROUP BY product_id")
def a7(d: Data):
    path = scratch_path(d.spark, "revenue-csv")
    revenue = d["order_items"].groupBy("product_id").agg(agg.money_sum("price").alias("revenue"))
    writers.write_csv(revenue, path)
    return readers.read_csv(d.spark, path, revenue.schema)


@query(
    "a8_state_partitioned_table",
    f"""SELECT customer_state, count(*) AS n, {money('price')} AS sales FROM wide GROUP BY 1""",
)
def a8(d: Data):
    name = f"wide_{uuid.uuid4().hex}"
    writers.write_state_table(build_wide(d.tables), name, scratch_path(d.spark, "state-table"), files_per_state=2)
    stored = readers.read_table(d.spark, name)
    return stored.groupBy("customer_state").agg(F.count(F.lit(1)).alias("n"), agg.money_sum("price").alias("sales"))


@query(
    "a11_rows_as_json",
    "SELECT review_id, order_id, review_score FROM c_reviews",
)
def a11(d: Data):
    messages = writers.json_values(d["order_reviews"].select("review_id", "order_id", "review_score"), key="order_id")
    number = F.get_json_object("value", "$.review_id").cast("bigint")
    score = F.get_json_object("value", "$.review_score").cast("int")
    return messages.select(number.alias("review_id"), F.col("key").cast("bigint").alias("order_id"), score.alias("review_score"))


@query(
    "a12_keyed_messages",
    """SELECT CAST(row_number() OVER (ORDER BY order_id) - 1 AS VARCHAR) AS key, order_id, payment_value FROM c_payments""",
)
def a12(d: Data):
    payments = d["order_payments"].select("order_id", "payment_type", "payment_value")
    messages = stream_sources.keyed_messages(payments, ["order_id"])
    read = F.from_json("value", "order_id bigint, payment_value double")
    return messages.select("key", read["order_id"].alias("order_id"), read["payment_value"].alias("payment_value"))


@query("a13_preview", f"SELECT order_id, order_status, {stamp('order_purchase_timestamp')} AS order_purchase_timestamp FROM c_orders ORDER BY order_id LIMIT 10")
def a13(d: Data):
    orders = d["orders"].select("order_id", "order_status", "order_purchase_timestamp")
    return text(readers.preview(orders, ["order_id"], 10), "order_purchase_timestamp")


_REVIEW_TYPES = (
    ("review_id", "bigint"), ("order_id", "bigint"), ("review_score", "int"), ("review_comment_title", "string"),
    ("review_comment_message", "string"), ("review_creation_date", "timestamp"), ("review_answer_timestamp", "timestamp"),
)


@query(
    "a14_schema_report",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{t}' AS type, count({c}) AS non_null, count(*) AS rows FROM c_reviews"""
        for i, (c, t) in enumerate(_REVIEW_TYPES)
    ),
)
def a14(d: Data):
    return readers.schema_report(d["order_reviews"])
