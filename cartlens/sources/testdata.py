"""The supplied parquet tables seen as commerce tables.

Column formulas follow FIXTURES.md section 3. They only rename and derive columns; a
condition on the order key decides which orders have two reviews, and some_reviews leaves some
orders without one for the figures that need such orders. Operators never see these names.

Every function takes the reader of one raw table, so that the same mapping serves batch
frames and file streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RawReader = Callable[[str], DataFrame]

MONTH_CUTOFF = "2001-07"

RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def batch_reader(spark: SparkSession, folder: str) -> RawReader:
    return lambda name: spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def stream_reader(spark: SparkSession, folder: str) -> RawReader:
    """Each raw table as a file stream over the same files."""

    def read(name: str) -> DataFrame:
        stream = spark.readStream.schema(RAW_SCHEMAS[name])
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)

    return read


def _hours(n: str) -> str:
    return f"make_dt_interval(0, cast({n} as int))"


def _nation(raw: RawReader, table: str, key: str) -> DataFrame:
    nations = raw("nation").select("n_nationkey", "n_name")
    return raw(table).join(nations.withColumnRenamed("n_nationkey", key), key)


def orders(raw: RawReader) -> DataFrame:
    bought = "cast(o_orderdate as timestamp)"
    return raw("orders").selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as customer_id",
        "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end as order_status",
        f"{bought} as order_purchase_timestamp",
        f"{bought} + {_hours('36 + o_orderkey % 24')} as order_approved_at",
        f"{bought} + {_hours('48 + o_orderkey % 72')} as order_delivered_carrier_date",
        f"if(o_orderkey % 13 <> 0, {bought} + {_hours('(o_orderkey % 41) * 19')}, null) as order_delivered_customer_date",
        f"{bought} + {_hours('600')} as order_estimated_delivery_date",
    )


def customers(raw: RawReader, raw_static: RawReader | None = None) -> DataFrame:
    """One row per order (customer_id) with the person behind it."""
    people = _nation(raw_static or raw, "customer", "c_nationkey")
    placed = raw("orders").selectExpr("o_orderkey", "o_custkey as c_custkey")
    return placed.join(people, "c_custkey").selectExpr(
        "o_orderkey as customer_id",
        "c_custkey as customer_unique_id",
        "cast(c_custkey % 1000 as int) as customer_zip_code_prefix",
        "concat('CITY_', c_custkey % 40) as customer_city",
        "n_name as customer_state",
    )


def order_items(raw: RawReader) -> DataFrame:
    return raw("lineitem").selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "cast(l_shipdate as timestamp) as shipping_limit_date",
        "l_extendedprice as price",
        "cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2) as double) as freight_value",
    )


def order_payments(raw: RawReader) -> DataFrame:
    return raw("orders").selectExpr(
        "o_orderkey as order_id",
        "1 as payment_sequential",
        "o_orderpriority as payment_type",
        "cast(1 + o_orderkey % 10 as int) as payment_installments",
        "o_totalprice as payment_value",
    )


def order_reviews(raw: RawReader) -> DataFrame:
    created = f"cast(o_orderdate as timestamp) + {_hours('(o_orderkey % 53) * 21 + nth * 48')}"
    return raw("orders").selectExpr(
        "o_orderkey", "o_orderdate", "explode(if(o_orderkey % 17 = 0, array(0, 1), array(0))) as nth"
    ).selectExpr(
        "o_orderkey * 10 + nth as review_id",
        "o_orderkey as order_id",
        "if(nth = 1, 1, cast(1 + (o_orderkey * 7) % 5 as int)) as review_score",
        "if(o_orderkey % 3 <> 0, concat('title ', o_orderkey % 25), null) as review_comment_title",
        "if(o_orderkey % 5 = 0, concat('message ', o_orderkey % 100), null) as review_comment_message",
        f"{created} as review_creation_date",
        f"if(o_orderkey % 29 <> 0, {created} + {_hours('(o_orderkey % 37) * 31 - 20')}, null) as review_answer_timestamp",
    )


def some_reviews(raw: RawReader) -> DataFrame:
    """The reviews without those of every eleventh order, for figures about orders that have none."""
    return order_reviews(raw).filter("order_id % 11 <> 0")


def sellers(raw: RawReader) -> DataFrame:
    return _nation(raw, "supplier", "s_nationkey").selectExpr(
        "s_suppkey as seller_id",
        "cast(s_suppkey % 1000 as int) as seller_zip_code_prefix",
        "concat('CITY_', s_suppkey % 40) as seller_city",
        "n_name as seller_state",
    )


def products(raw: RawReader) -> DataFrame:
    described = "p_partkey % 23 <> 0"
    return raw("part").selectExpr(
        "p_partkey as product_id",
        "if(p_partkey % 19 <> 0, lower(p_type), null) as product_category_name",
        f"if({described}, cast(length(p_name) as double), null) as product_name_lenght",
        f"if({described}, cast(p_size * 10 as double), null) as product_description_lenght",
        f"if({described}, cast(p_size % 5 + 1 as double), null) as product_photos_qty",
        "cast(p_size * 100 as double) as product_weight_g",
        "cast(p_size as double) as product_length_cm",
        "cast(p_size % 7 + 1 as double) as product_height_cm",
        "cast(p_size % 11 + 1 as double) as product_width_cm",
    )


def category_translation(raw: RawReader) -> DataFrame:
    names = raw("part").selectExpr("lower(p_type) as product_category_name", "p_type as product_category_name_english")
    return names.distinct()


def geolocation(raw: RawReader) -> DataFrame:
    return _nation(raw, "customer", "c_nationkey").selectExpr(
        "cast(c_custkey % 1000 as int) as geolocation_zip_code_prefix",
        "(c_custkey % 720) / 4.0D - 90.0D as geolocation_lat",
        "(c_custkey % 1440) / 4.0D - 180.0D as geolocation_lng",
        "concat('CITY_', c_custkey % 40) as geolocation_city",
        "n_name as geolocation_state",
    )


def live_sales(raw: RawReader) -> DataFrame:
    """Purchases of the event table as a sales feed."""
    purchases = raw("events").filter("event_type = 'purchase'")
    return purchases.selectExpr(
        "cast(ts as timestamp) as created_date", "cast(user_id as string) as salesordernumber", "value as salesamount"
    )


MAPPERS = {
    "orders": orders,
    "customers": customers,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "some_reviews": some_reviews,
    "sellers": sellers,
    "products": products,
    "category_translation": category_translation,
    "geolocation": geolocation,
    "live_sales": live_sales,
}


class CommerceTables(dict):
    """Commerce tables by name, built on first use."""

    def __init__(self, raw: RawReader):
        super().__init__()
        self.raw = raw

    def __missing__(self, name: str) -> DataFrame:
        self[name] = MAPPERS[name](self.raw)
        return self[name]


def load(spark: SparkSession, folder: str) -> CommerceTables:
    return CommerceTables(batch_reader(spark, folder))
