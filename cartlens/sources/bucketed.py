"""Order tables stored in buckets of the order id, so that joining them moves no rows between tasks.

Orders are stored with their customers. Every bucket is written by one task as one sorted file. An order
with an outsized share of a table would make one bucket outsized, so the rows of such orders are stored in plain
tables beside the bucketed ones and joined spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.plans import wide

BUCKETS = 200
HEADS = "order_heads"
STORED = (HEADS, *wide.ORDER_PARTS)


def write_order_tables(
    t: Mapping[str, DataFrame], prefix: str, path: str, buckets: int = BUCKETS, hot: Mapping | None = None
) -> None:
    """Store the order tables as {prefix}_{table} and {prefix}_{table}_hot, with data below path.

    buckets should make files of some hundred MB of the largest table. hot: orders to keep apart with the
    parts each is to be spread over, found by wide.hot_orders if not given.
    """
    spark = t["orders"].sparkSession
    hot = wide.hot_orders(t) if hot is None else hot
    kind = t["orders"].schema["order_id"].dataType.simpleString()
    listed = spark.createDataFrame(list(hot.items()), f"order_id {kind}, parts int")
    listed.write.option("path", f"{path}/hot").saveAsTable(f"{prefix}_hot")
    # at most 1 / share orders are hot
    names = F.broadcast(listed.select("order_id"))
    heads = t["orders"].join(t["customers"], "customer_id")
    for name in STORED:
        rows = heads if name == HEADS else t[name]
        cold = rows.join(names, "order_id", "left_anti").repartition(buckets, "order_id")
        writer = cold.write.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.option("path", f"{path}/{name}").saveAsTable(f"{prefix}_{name}")
        apart = rows.join(names, "order_id", "left_semi")
        apart.write.option("path", f"{path}/{name}_hot").saveAsTable(f"{prefix}_{name}_hot")


def join_stored(spark: SparkSession, prefix: str, others: Mapping[str, DataFrame]) -> DataFrame:
    """The wide join of stored order tables with the other tables (products, sellers, category_translation)."""
    hot = {r["order_id"]: r["parts"] for r in spark.table(f"{prefix}_hot").collect()}
    cold = wide.join_wide({**others, **{name: spark.table(f"{prefix}_{name}") for name in STORED}})
    if not hot:
        return cold
    apart = wide.join_wide({**others, **{name: spark.table(f"{prefix}_{name}_hot") for name in STORED}}, hot)
    return cold.unionByName(apart)
