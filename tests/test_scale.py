"""Operators that must stay exact under skew: quantiles, running totals, hot keys."""

import math

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartlens.operators import ordered, quantiles
from cartlens.operators.keyjoin import attach_per_key

PROBABILITIES = (0.0, 0.05, 0.25, 0.5, 0.78, 0.9, 1.0)


def frame(spark, x):
    return spark.createDataFrame([(float(v),) for v in x], "x double")


def shapes():
    rng = np.random.default_rng(7)
    yield "uniform", rng.uniform(0, 1000, 3000)
    yield "heavy tail", np.exp(rng.normal(0, 6, 3000))
    yield "hot value", np.concatenate([np.full(2000, 5.0), rng.normal(5, 1e-6, 1000)])
    yield "two clusters", np.concatenate([rng.normal(0, 1e-9, 1500), 1e12 + rng.normal(0, 1, 1500)])
    yield "negative", -rng.exponential(10, 3000)
    yield "one value", np.full(10, 3.5)
    yield "single", np.array([42.0])


@pytest.mark.parametrize("name,x", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("final", [16, 4096])
def test_quantiles_equal_numpy(spark, name, x, final):
    got = quantiles.exact_quantiles(frame(spark, x), ["x"], PROBABILITIES, final_limit=final)["x"]
    want = np.quantile(x, PROBABILITIES)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=60))
def test_quantiles_property(spark, x):
    got = quantiles.exact_quantiles(frame(spark, x), ["x"], (0.25, 0.5), final_limit=4)["x"]
    assert np.allclose(got, np.quantile(x, (0.25, 0.5)), rtol=1e-9, atol=1e-9)


def test_quantiles_ignore_null_and_nan_and_use_weights(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (None, 9), (float("nan"), 9)], "x double, n int")
    assert quantiles.exact_quantiles(df, ["x"], (0.5, 1.0), "n")["x"] == [1.0, 2.0]
    empty = quantiles.exact_quantiles(df.filter("n > 100"), ["x"], (0.5,))
    assert empty["x"] == [None]


def test_quartile_edges_collapse(spark):
    edges = quantiles.quartile_edges(frame(spark, [1, 1, 1, 1, 2, 2, 75]), ["x"])["x"]
    assert edges == [1, 1, 1, 2, 75]


def test_trim_uses_the_remaining_rows(spark):
    x = np.arange(1, 101)
    kept = x[x < np.quantile(x, 0.78)]
    kept = kept[kept > np.quantile(kept, 0.05)]
    got = quantiles.quantile_trim(frame(spark, x), "x")
    assert sorted(r["x"] for r in got.collect()) == list(kept)


def test_fence_strict_and_inclusive(spark):
    # quartiles 2.5 and 4.5: limits -0.5 and 7.5, both present
    df = frame(spark, [-0.5, 2, 3, 3, 4, 4, 5, 7.5, 100][:8])
    limits = quantiles.iqr_limits(df, ["x"])["x"]
    inside = df.filter(quantiles.inside("x", limits)).count()
    strict = df.filter(quantiles.inside("x", limits, strict=True)).count()
    edge = sum(v in limits for v in (-0.5, 7.5))
    assert inside - strict == edge
    counted = quantiles.iqr_counts(df, ["x"]).first()
    assert counted["inliers"] + counted["outliers"] == 8 and counted["inliers"] == strict


def test_running_totals(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(0, 50, 2000)
    df = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(v)], "k int, v int").repartition(7)
    got = rows(ordered.running_totals(df, ["k"], {"v": "s"}), "k")
    assert [r[2] for r in got] == list(np.cumsum(v))
    back = rows(ordered.running_totals(df, [F.desc("k")], {"v": "s"}), F.desc("k"))
    assert [r[2] for r in back] == list(np.cumsum(v[::-1]))


def test_numbers_are_consecutive_by_first_appearance(spark):
    data = [("c", 5), ("a", 3), ("b", 1), ("a", 0), ("c", 9), ("d", 5)]
    df = spark.createDataFrame(data, "k string, t int")
    assert rows(ordered.first_seen_numbers(df, "k", ["t"], "n"), "n") == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_hot_key_join_equals_plain_join(spark):
    # one person holds a third of all rows
    data = [(i, 0 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(data, "r int, k int")
    per = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("s"))
    got = attach_per_key(df, per, "k", "n", ["r"], hot_share=0.01, part_rows=30)
    assert rows(got.select("r", "k", "n", "s")) == rows(df.join(per, "k").select("r", "k", "n", "s"))


def test_hot_key_is_spread(spark):
    df = spark.range(4000).select(F.col("id").alias("r"), F.lit(1).alias("k"))
    per = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = attach_per_key(df, per, "k", "n", ["r"], part_rows=250)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 4000


def test_copies_get_distinct_message_keys(spark):
    from cartlens.streaming.sources import keyed_messages

    df = spark.createDataFrame([("x", 1)] * 500 + [("y", 2)], "k string, v int").repartition(5)
    got = keyed_messages(df, ["k"])
    assert sorted(int(r["key"]) for r in got.collect()) == list(range(501))


def test_quantile_of_many_values_rounds(spark):
    df = spark.range(200_000).select((F.col("id") * 0.37).alias("x"))
    got = quantiles.exact_quantiles(df, ["x"], (0.33,), final_limit=128)["x"][0]
    assert math.isclose(got, 0.33 * 199_999 * 0.37, rel_tol=1e-12)


def test_hot_orders_are_found_and_joined_whole(spark, tmp_path):
    from cartlens.operators.keyjoin import hot_keys, split_hot_join

    # order 0 holds a third of all rows, half of them copies of one row
    data = [(0, 7) if i % 6 == 0 else (0, i) if i % 3 == 0 else (i, i) for i in range(6000)]
    spark.createDataFrame(data, "k long, v long").repartition(4).write.parquet(f"{tmp_path}/rows")
    items = spark.read.parquet(f"{tmp_path}/rows")
    heads = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = hot_keys(items, "k", 0.01, part_rows=300)
    assert hot == {0: 7}
    got = split_hot_join(items, heads, "k", hot)
    assert rows(got.select("k", "v", "w")) == rows(items.join(heads, "k").select("k", "v", "w"))


def test_infinite_values_have_ranks(spark):
    x = [math.inf, 1.0, 2.0, -math.inf, 3.0, math.inf]
    got = quantiles.exact_quantiles(frame(spark, x), ["x"], (0.0, 0.2, 0.4, 0.5, 0.8, 1.0), final_limit=1)["x"]
    assert got == [-math.inf, 1.0, 2.0, 2.5, math.inf, math.inf]
    only = quantiles.exact_quantiles(frame(spark, [math.inf] * 3), ["x"], (0.0, 0.5, 1.0))["x"]
    assert only == [math.inf] * 3


def test_wide_spans_and_neighbours(spark):
    x = [-1.7e308, 1.7e308, 5e-324, 1e-323, 0.0]
    got = quantiles.exact_quantiles(frame(spark, x), ["x"], (0.25, 0.5, 0.75), final_limit=1)["x"]
    assert got == [0.0, 5e-324, 1e-323]
