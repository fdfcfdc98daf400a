"""Streams against their batch twins, late rows, idempotent batches and pacing."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartlens.session import scratch_path
from cartlens.streaming import accounts, joins, live, sinks, sources

START = datetime(2024, 1, 1)


def put(spark, path, data, schema, n):
    """One file per call, so that each is its own micro-batch."""
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{path}/{n}")


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


SALES = "created_date timestamp, salesordernumber string, salesamount double"


def test_late_sale_is_left_out_after_the_delay(spark):
    path = scratch_path(spark, "late")
    minute = lambda m: START + timedelta(minutes=m)
    put(spark, path, [(minute(1), "a", 1.0), (minute(9), "b", 2.0)], SALES, 1)
    put(spark, path, [(minute(60), "c", 4.0)], SALES, 2)
    # rows are held against the delay of the micro-batch before
    put(spark, path, [(minute(61), "c", 0.0)], SALES, 3)
    put(spark, path, [(minute(2), "late", 8.0), (minute(58), "in time", 16.0)], SALES, 4)
    put(spark, path, [(minute(200), "d", 32.0)], SALES, 5)
    put(spark, path, [(minute(201), "d", 0.0)], SALES, 6)
    windows = live.sales_windows(stream(spark, path, SALES), 10, "10 minutes", delay="10 minutes")
    got = {r["window_start"]: r["sales"] for r in sinks.drain(windows, "late-out").collect()}
    assert got[minute(0)] == 3.0  # without the late 8.0
    assert got[minute(50)] == 16.0 and got[minute(60)] == 4.0


def test_windows_equal_batch(spark):
    path = scratch_path(spark, "windows")
    data = [(START + timedelta(minutes=7 * i), str(i % 3), float(i)) for i in range(30)]
    put(spark, path, data, SALES, 1)
    batch = live.sales_windows(spark.read.schema(SALES).parquet(f"{path}/*"), 20, "5 minutes")
    final = live.sales_windows(stream(spark, path, SALES), 20, "5 minutes", delay="0 seconds")
    got = {tuple(r) for r in sinks.drain(final, "windows-out").collect()}
    assert got and got <= {tuple(r) for r in batch.collect()}


def test_rerun_batch_does_not_append_twice(spark):
    path = scratch_path(spark, "idempotent")
    write = sinks.batch_writer(path, "idempotent_rows")
    batch = spark.range(5)
    write(batch, 0)
    write(batch, 0)
    write(spark.range(3), 1)
    assert spark.table("idempotent_rows").count() == 8
    spark.sql("drop table idempotent_rows")


def test_bad_json_gives_nulls(spark):
    from cartlens import schemas

    df = spark.createDataFrame([('{"order_id": "o", "payment_value": 2.5}',), ("nonsense",)], "value string")
    got = sources.parse_json(df, schemas.ORDER_PAYMENTS).select("order_id", "payment_value")
    assert rows(got) == [("o", 2.5), (None, None)] or rows(got) == [(None, None), ("o", 2.5)]


def test_replay_one_chunk_per_trigger(spark):
    path = scratch_path(spark, "paced")
    messages = sources.keyed_messages(spark.range(100).select("id"), ["id"])
    sources.write_chunks(messages.coalesce(1), f"{path}/chunks", rows_per_chunk=35)
    sizes = []
    query = sinks.to_batches(
        sources.replay(spark, f"{path}/chunks"), lambda df, n: sizes.append(df.count()), f"{path}/checkpoint"
    )
    query.awaitTermination()
    assert sorted(sizes) == [30, 35, 35]


def test_console_and_json_sink_start(spark, capfd):
    path = scratch_path(spark, "console")
    put(spark, f"{path}/in", [(START, "a", 1.0)], SALES, 1)
    sinks.to_console(stream(spark, f"{path}/in", SALES), f"{path}/checkpoint").awaitTermination()
    with pytest.raises(Exception, match="kafka"):
        sources.kafka_stream(spark, "localhost:9", "t")


def test_console_brings_first_rows_only_to_the_driver(spark, capfd):
    path = scratch_path(spark, "console")
    put(spark, f"{path}/in", [(START, f"a{n}", 1.0) for n in range(30)], SALES, 1)
    sinks.to_console(stream(spark, f"{path}/in", SALES), f"{path}/checkpoint").awaitTermination()
    out = capfd.readouterr().out
    assert "Batch: 0" in out and "|a19" in out.replace(" ", "") and "|a20" not in out.replace(" ", "")
    assert "only showing top 20 rows" in out and "rows: 30" in out


ORDERS = "order_id string, customer_id string, orders_at timestamp"


def test_join_state_is_written_once_and_in_one_store(spark):
    path = scratch_path(spark, "state")
    put(spark, f"{path}/o", [("o1", "c1", START)], ORDERS, 1)
    streams = {"orders": stream(spark, f"{path}/o", ORDERS)}
    for name, key in joins.CHAIN:
        schema = f"{key} string, {name}_value int, {name}_at timestamp"
        put(spark, f"{path}/{name}", [("c1" if key == "customer_id" else "o1", 1, START)], schema, 1)
        streams[name] = stream(spark, f"{path}/{name}", schema)
    joined = joins.join_streams(streams, delay="1 hour", within="2 days").select("order_id")
    sinks.to_files(joined, f"{path}/rows", f"{path}/checkpoint", empty_batches=False).awaitTermination()
    assert spark.read.parquet(f"{path}/rows").count() == 1
    names = lambda at: [f for f in os.listdir(at) if not f.startswith(".") and f != "_metadata"]
    # no second micro-batch, which would only write the state again
    assert names(f"{path}/checkpoint/commits") == ["0"]
    # the four parts of a join's state lie in one store
    stores = [names(f"{path}/checkpoint/state/{join}/0") for join in range(len(joins.CHAIN))]
    assert not [f for store in stores for f in store if f.startswith(("left-", "right-"))]
    # items multiply the rows of an order, so nothing is joined behind them
    assert joins.CHAIN[-1][0] == "order_items"
    assert spark.conf.get(sinks.EMPTY_BATCHES) == "true"


def test_bounded_join_drops_what_arrives_too_late(spark):
    path = scratch_path(spark, "bounded")
    hour = lambda h: START + timedelta(hours=h)
    put(spark, f"{path}/o", [("o1", "c1", hour(0)), ("o2", "c2", hour(1))], ORDERS, 1)
    tables = {
        "customers": ("customer_id string, person string, customers_at timestamp", [("c1", "p1", hour(0)), ("c2", "p2", hour(1))]),
        "order_items": ("order_id string, item int, order_items_at timestamp", [("o1", 1, hour(1)), ("o1", 2, hour(2)), ("o2", 1, hour(1))]),
        "order_payments": ("order_id string, paid int, order_payments_at timestamp", [("o1", 5, hour(1)), ("o2", 6, hour(2))]),
        "order_reviews": ("order_id string, score int, order_reviews_at timestamp", [("o1", 4, hour(5)), ("o2", 1, hour(90))]),
    }
    streams = {"orders": stream(spark, f"{path}/o", ORDERS)}
    for name, (schema, data) in tables.items():
        put(spark, f"{path}/{name}", data, schema, 1)
        streams[name] = stream(spark, f"{path}/{name}", schema)
    bounded = joins.join_streams(streams, delay="1 hour", within="2 days").select("order_id", "item", "paid", "score")
    assert rows(sinks.drain(bounded, "bounded-out")) == [("o1", 1, 5, 4), ("o1", 2, 5, 4)]
    whole = joins.join_streams(streams, delay="1 hour", within="20 days").select("order_id", "person", "item", "paid", "score")
    assert len(rows(sinks.drain(whole, "whole-out"))) == 3


def test_live_geo_figures_over_micro_batches(spark, folder):
    from cartlens.catalog.registry import Data
    from cartlens.plans import kpis
    from cartlens.sources import testdata

    d = Data(spark, folder)
    states = [r[0] for r in d["sellers"].select("seller_state").distinct().orderBy("seller_state").limit(5).collect()]
    partials = live.geo_partials(seller_states=states, cutoff=testdata.MONTH_CUTOFF)
    # rows of one order in several batches
    part = F.pmod(F.xxhash64("order_id", "product_id", "review_id"), F.lit(3))
    merged = {}
    for name, partial in partials.items():
        for k in range(3):
            one = partial(d.wide.filter(part == k))
            merged[name] = one if k == 0 else merged[name].unionByName(one)
    got = live.geo_figures(**merged)
    view = d.view.filter(F.col("seller_state").isin(states))
    assert rows(got["orders_per_state"]) == rows(kpis.orders_per_state(view))
    assert rows(got["totals"]) == rows(kpis.live_figures(d.wide))
    assert rows(got["fastest_cities"]) == rows(kpis.fastest_cities(view))
    assert rows(got["most_delayed_cities"]) == rows(kpis.most_delayed_cities(view))


def test_account_of_a_bounded_join(spark):
    path = scratch_path(spark, "account")
    hour = lambda h: START + timedelta(hours=h)
    # the second micro-batch moves all watermarks far on, which holds for late rows two later
    batches = {
        "orders": [[("o1", "c1", hour(0)), ("o2", "c2", hour(1)), ("o3", "c3", hour(2)), ("o4", "c4", hour(2))], [("z", "z", hour(1000))], [("y", "y", hour(1001))]],
        "customers": [[(f"c{k}", "p", hour(1)) for k in (1, 2, 3, 4, 9)], [("z", "p", hour(1000))], [("y", "p", hour(1001))]],
        "order_items": [[("o1", 1, hour(1)), ("o1", 1, hour(1)), ("o2", 1, hour(1)), ("o4", 1, hour(2))], [("z", 1, hour(1000))], [("y", 1, hour(1001))], [("o3", 1, hour(2))]],
        "order_payments": [[(f"o{k}", 5, hour(1)) for k in (1, 2, 3)], [("z", 5, hour(1000))], [("y", 5, hour(1001))]],
        "order_reviews": [[("o1", 4, hour(5)), ("o1", 3, hour(90)), ("o2", 1, hour(90)), ("o3", 2, hour(3)), ("o4", 2, hour(3))], [("z", 5, hour(1000))], [("y", 5, hour(1001))]],
    }
    schemas = {
        "orders": ORDERS,
        "customers": "customer_id string, person string, customers_at timestamp",
        "order_items": "order_id string, item int, order_items_at timestamp",
        "order_payments": "order_id string, paid int, order_payments_at timestamp",
        "order_reviews": "order_id string, score int, order_reviews_at timestamp",
    }
    streams = {}
    for name, parts in batches.items():
        for n, data in enumerate(parts):
            put(spark, f"{path}/{name}", data, schemas[name], n)
        streams[name] = stream(spark, f"{path}/{name}", schemas[name])
    streams = accounts.tagged(streams)
    joined = joins.join_streams(streams, delay="1 hour", within="2 days").select("order_id", *[f"{n}_row" for n in streams])
    kept = sinks.drain(joined, "account-kept")
    assert sorted(r["order_id"] for r in kept.collect()) == ["o1", "o1", "y", "z"]
    statuses = accounts.row_statuses(accounts.log_arrivals(streams), kept, "2 days")
    got = {(r["table"], r["status"]): r["n"] for r in accounts.summary(statuses).collect()}
    assert got == {
        ("orders", "joined"): 3, ("orders", "outside bound"): 1, ("orders", "late"): 1, ("orders", "no partner"): 1,
        ("customers", "joined"): 3, ("customers", "partner lost"): 2, ("customers", "late"): 1, ("customers", "no partner"): 1,
        ("order_items", "joined"): 4, ("order_items", "partner lost"): 2, ("order_items", "late"): 1,
        ("order_payments", "joined"): 3, ("order_payments", "partner lost"): 1, ("order_payments", "late"): 1,
        ("order_reviews", "joined"): 3, ("order_reviews", "outside bound"): 2, ("order_reviews", "late"): 1, ("order_reviews", "partner lost"): 1,
    }
    # every row that arrived has one status
    assert sum(got.values()) == sum(len(p) for parts in batches.values() for p in parts)


def test_drained_streams_keep_progress_by_plain_renames(spark, monkeypatch):
    """Their checkpoint is new, so no other query needs to be kept off it; other streams keep Spark's default."""
    key, seen = next(iter(sinks.LONE_CONF)), []
    monkeypatch.setattr(sinks, "to_files", lambda *a, old=sinks.to_files, **kw: seen.append(kw.get("alone")) or old(*a, **kw))
    path = scratch_path(spark, "lone")
    spark.range(50).repartition(5).write.parquet(path)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    assert rows(sinks.drain(stream, "lone")) == sorted([(n,) for n in range(50)], key=str) and seen == [True]
    before = spark.conf.get(key, None)
    with sinks.stream_settings(spark, alone=True):
        assert spark.conf.get(key) == sinks.LONE_CONF[key]
    assert spark.conf.get(key, None) == before
    with sinks.stream_settings(spark):
        assert spark.conf.get(key, None) == before
