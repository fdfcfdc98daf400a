"""Order tables in buckets: the same join, without moving orders."""

import re
import uuid

from conftest import rows

from cartlens.plans import wide
from cartlens.sources import bucketed, testdata


def stored(spark, folder, tmp_path, hot):
    t = wide.cleaned_tables(testdata.load(spark, folder), drop=False)
    prefix = f"t_{uuid.uuid4().hex}"
    bucketed.write_order_tables(t, prefix, str(tmp_path), buckets=4, hot=hot)
    return t, prefix


def test_no_exchange_of_orders(spark, folder, tmp_path):
    t, prefix = stored(spark, folder, tmp_path, {})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed.join_stored(spark, prefix, t)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [order_id" in plan and "Bucketed: true" in joined._jdf.queryExecution().simpleString()
        assert not re.search(r"Exchange hashpartitioning\(order_id", plan)
        assert re.search(r"Exchange hashpartitioning\(order_id", wide.join_wide(t)._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_rows_with_and_without_hot_orders(spark, folder, tmp_path):
    columns = ["order_id", "product_id", "order_item_id", "review_id", "payment_value", "customer_city"]
    for k, hot in enumerate(({}, {1: 3, 2: 2, 99_999_999: 2})):
        t, prefix = stored(spark, folder, tmp_path / str(k), hot)
        assert rows(bucketed.join_stored(spark, prefix, t).select(columns)) == rows(wide.join_wide(t).select(columns))
