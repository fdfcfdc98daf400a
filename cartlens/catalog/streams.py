"""A4, A5, A9, A10, D5, D6, I: streams over the given tables, run until they are drained."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartlens import schemas
from cartlens.catalog.aggregation import TOTALS_SQL
from cartlens.catalog.base_sql import money, stamp
from cartlens.catalog.registry import Data, query, rounded, text
from cartlens.session import scratch_path
from cartlens.sources import testdata
from cartlens.streaming import accounts, joins, live, sinks, sources


def _streams(d: Data) -> dict:
    """The five streamed tables, with the order time as arrival time of each message."""
    read = testdata.stream_reader(d.spark, d.folder)
    batch = testdata.batch_reader(d.spark, d.folder)
    return {
        "orders": testdata.orders(read),
        "customers": testdata.customers(read, batch),
        "order_items": testdata.order_items(read),
        "order_payments": testdata.order_payments(read),
        "order_reviews": testdata.order_reviews(read),
    }


def _messages(stream):
    return stream.select(F.to_json(F.struct("*")).alias("value"))


@query(
    "a4_json_topic_to_columns",
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, order_status, {stamp('order_purchase_timestamp')} AS order_purchase_timestamp FROM c_orders""",
)
def a4(d: Data):
    parsed = sources.parse_json(_messages(_streams(d)["orders"]), schemas.ORDERS)
    drained = sinks.drain(parsed.select("order_id", "order_status", "order_purchase_timestamp"), "orders-stream")
    return text(drained, "order_purchase_timestamp")


@query(
    "a5_bounded_poll",
    "SELECT CAST(order_id AS VARCHAR) AS order_id, product_id, price FROM (SELECT order_id, CAST(product_id AS VARCHAR) AS product_id, price FROM c_items)",
)
def a5(d: Data):
    items = sources.parse_json(_messages(_streams(d)["order_items"]), schemas.ORDER_ITEMS)
    return sinks.drain(items.select("order_id", "product_id", "price"), "poll")


@query("a9_stream_append", "SELECT order_id, payment_type, payment_value FROM c_payments")
def a9(d: Data):
    """The stream appended to the console, which shows its first rows, and to files, which are read back."""
    rows = _streams(d)["order_payments"].select("order_id", "payment_type", "payment_value")
    sinks.to_console(rows, f"{scratch_path(d.spark, 'console')}/checkpoint").awaitTermination()
    return sinks.drain(rows, "payments-stream")


@query("a10_micro_batches_to_table", "SELECT order_id, product_id, price FROM c_items")
def a10(d: Data):
    path, table = scratch_path(d.spark, "items-table"), f"items_{uuid.uuid4().hex}"
    stream = _streams(d)["order_items"].select("order_id", "product_id", "price")
    sinks.to_batches(stream, sinks.batch_writer(f"{path}/rows", table), f"{path}/checkpoint").awaitTermination()
    return d.spark.table(table).drop("batch_id")


_JOINED = """SELECT order_id, customer_id, customer_unique_id, product_id, seller_id, price, payment_value, review_id, review_score
    FROM c_orders JOIN c_customers USING (customer_id) JOIN c_items USING (order_id) JOIN c_payments USING (order_id) JOIN c_reviews USING (order_id)"""
_JOINED_COLUMNS = (
    "order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "price", "payment_value", "review_id",
    "review_score",
)


def _arrived(d: Data) -> dict:
    """The streams with arrival times: messages about an order come at the order time, its reviews when
    they are written."""
    streams = _streams(d)
    ordered_at = d["orders"].select("order_id", "order_purchase_timestamp")
    arrived = {
        "orders": streams["orders"].withColumn("orders_at", F.col("order_purchase_timestamp")),
        "order_reviews": streams["order_reviews"].withColumn("order_reviews_at", F.col("review_creation_date")),
    }
    for name, key in (("customers", "customer_id"), ("order_items", "order_id"), ("order_payments", "order_id")):
        times = ordered_at.toDF(key, f"{name}_at")
        arrived[name] = streams[name].join(times, key)
    return arrived


# reviews are written within 49 days of the order, so this loses none
_WITHIN = "60 days"


@query("d5_stream_stream_join", _JOINED)
def d5(d: Data):
    joined = joins.join_streams(_arrived(d), delay="10 days", within=_WITHIN)
    return sinks.drain(joined.select(*_JOINED_COLUMNS), "joined-stream", empty_batches=False)


@query(
    "d6_stream_static_join",
    """SELECT order_id, product_id, seller_id, price, coalesce(product_category_name, 'unknown') AS product_category_name,
       coalesce(product_photos_qty, 2.0) AS product_photos_qty, seller_state FROM c_items JOIN c_products USING (product_id) JOIN c_sellers USING (seller_id)""",
)
def d6(d: Data):
    rows = joins.enrich(_streams(d)["order_items"], d["products"], d["sellers"])
    columns = ("order_id", "product_id", "seller_id", "price", "product_category_name", "product_photos_qty", "seller_state")
    return sinks.drain(rows.select(*columns), "enriched-stream")


@query(
    "i1_typed_streams",
    """SELECT 'orders' AS "table", count(*) AS n FROM c_orders UNION ALL SELECT 'customers', count(*) FROM c_customers
       UNION ALL SELECT 'order_items', count(*) FROM c_items UNION ALL SELECT 'order_payments', count(*) FROM c_payments
       UNION ALL SELECT 'order_reviews', count(*) FROM c_reviews""",
)
def i1(d: Data):
    counted = None
    for name, stream in _streams(d).items():
        parsed = sources.parse_json(_messages(stream), schemas.TABLES[name])
        key = schemas.TABLES[name].names[0]
        rows = sinks.drain(parsed, f"typed-{name}").filter(F.col(key).isNotNull())
        one = rows.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"))
        counted = one if counted is None else counted.unionByName(one)
    return counted


@query(
    "i2_bounded_stream_join",
    _JOINED + " WHERE review_creation_date <= order_purchase_timestamp + INTERVAL 20 DAY",
)
def i2(d: Data):
    joined = joins.join_streams(_arrived(d), delay="10 days", within="20 days")
    return sinks.drain(joined.select(*_JOINED_COLUMNS), "bounded-stream", empty_batches=False)


@query(
    "i2_join_account",
    """WITH r AS (SELECT order_id, review_creation_date >= order_purchase_timestamp - INTERVAL 20 DAY
                    AND review_creation_date <= order_purchase_timestamp + INTERVAL 20 DAY AS inside
                  FROM c_reviews LEFT JOIN c_orders USING (order_id)),
       o AS (SELECT order_id, customer_id, order_id IN (SELECT order_id FROM c_items) AND order_id IN (SELECT order_id FROM c_payments)
                    AND customer_id IN (SELECT customer_id FROM c_customers) AS others, order_id IN (SELECT order_id FROM r) AS reviewed,
                    order_id IN (SELECT order_id FROM r WHERE inside) AS reviewed_inside FROM c_orders),
       s AS (SELECT 'orders' AS "table", CASE WHEN others AND reviewed_inside THEN 'joined' WHEN NOT others OR NOT reviewed THEN 'no partner'
                    ELSE 'outside bound' END AS status FROM o
             UNION ALL SELECT 'customers', CASE WHEN others AND reviewed_inside THEN 'joined' ELSE 'partner lost' END FROM c_customers JOIN o USING (customer_id)
             UNION ALL SELECT 'order_items', CASE WHEN others AND reviewed_inside THEN 'joined' ELSE 'partner lost' END FROM c_items JOIN o USING (order_id)
             UNION ALL SELECT 'order_payments', CASE WHEN others AND reviewed_inside THEN 'joined' ELSE 'partner lost' END FROM c_payments JOIN o USING (order_id)
             UNION ALL SELECT 'order_reviews', CASE WHEN inside IS NULL THEN 'no partner' WHEN NOT inside THEN 'outside bound' WHEN others THEN 'joined'
                    ELSE 'partner lost' END FROM r LEFT JOIN o USING (order_id))
       SELECT "table", status, count(*) AS n FROM s GROUP BY ALL""",
)
def i2_account(d: Data):
    streams = accounts.tagged(_arrived(d))
    joined = joins.join_streams(streams, delay="10 days", within="20 days").select(*[f"{name}_row" for name in streams])
    kept = sinks.drain(joined, "account-joined", empty_batches=False)
    return accounts.summary(accounts.row_statuses(accounts.log_arrivals(streams), kept, "20 days"))


@query(
    "i3_stream_enriched_chain",
    """SELECT order_id, customer_unique_id, product_id, price, review_score, coalesce(product_category_name, 'unknown') AS product_category_name, seller_state
       FROM c_orders JOIN c_customers USING (customer_id) JOIN c_items USING (order_id) JOIN c_payments USING (order_id) JOIN c_reviews USING (order_id)
       JOIN c_products USING (product_id) JOIN c_sellers USING (seller_id)""",
)
def i3(d: Data):
    rows = joins.enrich(joins.join_streams(_arrived(d), delay="10 days", within=_WITHIN), d["products"], d["sellers"])
    columns = ("order_id", "customer_unique_id", "product_id", "price", "review_score", "product_category_name", "seller_state")
    return sinks.drain(rows.select(*columns), "chain-stream", empty_batches=False)


@query("i4_json_messages_out", "SELECT order_id, payment_value FROM c_payments")
def i4(d: Data):
    messages = _messages(_streams(d)["order_payments"])
    read = F.from_json("value", "order_id bigint, payment_value double")
    return sinks.drain(messages, "messages-out").select(read["order_id"].alias("order_id"), read["payment_value"].alias("payment_value"))


_WINDOWS = f"""WITH w AS (SELECT unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, created_date) - INTERVAL 50 MINUTE,
                  time_bucket(INTERVAL 10 MINUTE, created_date), INTERVAL 10 MINUTE)) AS s, salesamount FROM c_sales)
    SELECT {stamp('s')} AS window_start, {stamp('s + INTERVAL 60 MINUTE')} AS window_end, count(*) AS num_transactions, {money('salesamount')} AS sales
    FROM w GROUP BY s"""


@query("i5_sales_windows", _WINDOWS)
def i5(d: Data):
    windows = live.sales_windows(d["live_sales"], 60, "10 minutes")
    return text(windows, "window_start", "window_end")


@query(
    "i5_sales_windows_stream",
    _WINDOWS + " HAVING s + INTERVAL 60 MINUTE <= (SELECT max(created_date) FROM c_sales) - INTERVAL 30 MINUTE",
)
def i5b(d: Data):
    """Windows that are final: those that end before the newest sale less the delay."""
    sales = testdata.live_sales(testdata.stream_reader(d.spark, d.folder))
    windows = live.sales_windows(sales, 60, "10 minutes", delay="30 minutes")
    return text(sinks.drain(windows, "windows-stream"), "window_start", "window_end")


@query("i5_rolling_totals", TOTALS_SQL)
def i5c(d: Data):
    """Totals of the last minutes as of the last of several micro-batches."""
    path = scratch_path(d.spark, "rolling")
    d["live_sales"].repartitionByRange(3, "created_date").write.parquet(f"{path}/topic")
    sales = d.spark.readStream.schema(d["live_sales"].schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/topic")
    live.rolling_totals(sales, path).awaitTermination()
    totals = d.spark.read.parquet(f"{path}/totals")
    last = totals.agg(F.max("batch_id")).scalar()
    return totals.filter(F.col("batch_id") == last).drop("batch_id")


def _live(d: Data) -> dict:
    """The live page over a stream of joined rows that comes in several micro-batches."""
    if not hasattr(d, "live_figures"):
        path = scratch_path(d.spark, "live")
        columns = (
            "order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
            "order_estimated_delivery_date", "review_creation_date", "review_answer_timestamp", "review_score",
            "customer_state", "customer_city", "seller_state", "freight_value", "payment_value",
        )
        rows = d.wide.select(*columns)
        rows.repartition(6).write.parquet(f"{path}/topic")
        stream = d.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/topic")
        write = sinks.figure_writer(f"{path}/partials", live.geo_partials(cutoff=testdata.MONTH_CUTOFF))
        sinks.to_batches(stream, write, f"{path}/checkpoint").awaitTermination()
        totals, places = (d.spark.read.parquet(f"{path}/partials/{name}") for name in ("totals", "places"))
        d.live_figures = live.geo_figures(totals, places)
    return d.live_figures


@query("i6_live_orders_per_state", "SELECT customer_state, count(DISTINCT order_id) AS orders FROM dash GROUP BY customer_state")
def i6(d: Data):
    return _live(d)["orders_per_state"]


@query(
    "i6_live_totals",
    f"""SELECT round({money('freight_value')} / count(freight_value), 6) AS average_freight, {money('payment_value')} AS total_payment,
        round(avg(review_score), 6) AS average_score, {money('freight_value')} AS total_freight FROM wide""",
)
def i6b(d: Data):
    return rounded(_live(d)["totals"], 6, "average_freight", "average_score")


def _slowest(column: str) -> str:
    return f"""SELECT customer_city, round(avg({column}), 6) AS mean_days FROM dash GROUP BY customer_city
        ORDER BY avg({column}), customer_city LIMIT 5"""


@query("i6_live_fastest_cities", _slowest("difference_purchased_delivered"))
def i6c(d: Data):
    return rounded(_live(d)["fastest_cities"], 6, "mean_days")


@query("i6_live_most_delayed_cities", _slowest("estimated_delivered_difference"))
def i6d(d: Data):
    return rounded(_live(d)["most_delayed_cities"], 6, "mean_days")


@query(
    "i7_paced_replay",
    "SELECT CAST(row_number() OVER (ORDER BY order_id) - 1 AS VARCHAR) AS key, order_id, payment_value FROM c_payments",
)
def i7(d: Data):
    path = scratch_path(d.spark, "replay")
    messages = sources.keyed_messages(d["order_payments"].select("order_id", "payment_value"), ["order_id"])
    sources.write_chunks(messages, f"{path}/chunks", rows_per_chunk=5000)
    read = F.from_json("value", "order_id bigint, payment_value double")
    replayed = sinks.drain(sources.replay(d.spark, f"{path}/chunks", chunks_per_trigger=4), "replayed")
    return replayed.select("key", read["order_id"].alias("order_id"), read["payment_value"].alias("payment_value"))
