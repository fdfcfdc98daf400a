"""Order exploration: time of day, delivery times, quarters and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions import dates, labels
from cartlens.operators import aggregates as agg


def with_time_of_day(orders: DataFrame, ts: str = "order_purchase_timestamp", quarters: bool = False) -> DataFrame:
    part = dates.day_quarter if quarters else dates.day_third
    return orders.withColumn("time_of_day", part(F.hour(ts)))


def status_summary(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Distinct customers and orders and the most frequent part of day per status. There are
    at most four parts of a day, so the mode keeps four counts per group."""
    return (
        with_time_of_day(orders, ts)
        .groupBy("order_status")
        .agg(
            F.count_distinct("customer_id").alias("customer_id_unique"),
            F.count_distinct("order_id").alias("order_id_unique"),
            F.mode("time_of_day", True).alias("time_of_day_mode"),
        )
    )


def delivery_comparison(rows: DataFrame) -> DataFrame:
    """Mean score and intervals of on-time and late rows; a margin of exactly zero is neither."""
    metrics = ["review_score", "approved_carrier", "carrier_delivered", "delivered_estimated", "purchased_delivered"]
    margin = F.col("delivered_estimated")
    return agg.conditional_means(rows, metrics, {"on_time": margin > 0, "late": margin < 0})


def orders_by_quarter(rows: DataFrame, value: str = "num_orders") -> DataFrame:
    return agg.quarterly_sum(rows, "order_purchase_timestamp", F.sum(value), value)


def late_by_time_and_region(rows: DataFrame, regions=labels.STATES_BY_REGION) -> DataFrame:
    region = labels.region_of(F.col("customer_state"), regions).alias("region")
    return rows.groupBy("order_purchase_timestamp", region).agg(F.sum("late_deliveries").alias("late_deliveries"))
