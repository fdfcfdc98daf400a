"""Quantiles of plain rows: brackets from sketches, ranks from counts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.operators import profile, quantiles

P = (0.0, 0.001, 0.25, 0.33, 0.5, 0.75, 0.999, 1.0)


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def expected(values):
    return [float(np.quantile(np.array(values, dtype=float), p)) for p in P]


def same(got, values):
    return all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(got, expected(values)))


@pytest.fixture
def scans(monkeypatch):
    """How often each kind of scan ran."""
    seen = {"_sketch": 0, "_count_cells": 0}
    for name in seen:
        def counted(*a, _f=getattr(quantiles, name), _name=name, **b):
            seen[_name] += 1
            return _f(*a, **b)
        monkeypatch.setattr(quantiles, name, counted)
    return seen


def test_two_scans_of_many_values(spark, scans):
    df = spark.range(300_000).select((F.hash("id") / 7.0).alias("x"), (F.col("id") % 11).cast("double").alias("y"), F.lit(2.5).alias("z"))
    rows = df.toPandas()
    got, also = quantiles.sketched_quantiles(df, ["x", "y", "z"], P, also={"n": F.count(F.lit(1)), "top": F.max("y")})
    assert scans == {"_sketch": 1, "_count_cells": 1}
    assert also == {"n": 300_000, "top": 10.0}
    assert all(same(got[c], rows[c]) for c in "xyz")


def test_brackets_are_sketched_again(spark, scans):
    df = spark.range(300_000).select((F.hash("id") / 7.0).alias("x"))
    got = quantiles.exact_quantiles(df, ["x"], P, final_limit=50)["x"]
    assert same(got, df.toPandas()["x"]) and scans["_sketch"] > 1


@pytest.mark.parametrize("limit", [1, 3, 100, None])
@pytest.mark.parametrize("kind", ["hot", "two hot", "few", "ties", "wide", "infinite"])
def test_shapes(spark, kind, limit):
    r = np.random.default_rng(3)
    values = {
        "hot": [5.0] * 3000 + list(r.normal(5, 1, 500)),
        "two hot": [1.0] * 1000 + [1.5, 1.6] + [2.0] * 1000,
        "few": [3.0, 1.0, 2.0],
        "ties": list(r.integers(0, 9, 5000)),
        "wide": list(r.normal(0, 1, 2000) * 10.0 ** r.integers(-200, 200, 2000)),
        "infinite": [-math.inf] * 40 + list(range(500)) + [math.inf] * 30,
    }[kind]
    got = quantiles.exact_quantiles(frame(spark, values), ["x"], P, final_limit=limit)["x"]
    if kind == "infinite":
        ordered, n = sorted(values), len(values) - 1
        for p, v in zip(P, got):
            a, b = ordered[math.floor(p * n)], ordered[math.ceil(p * n)]
            assert v == a if a == b else math.isclose(v, a + (b - a) * (p * n % 1)) or math.isnan(v)
    else:
        assert same(got, values)


@pytest.mark.parametrize("wrong", ["far below", "far above", "around nothing"])
def test_a_sketch_that_misses_costs_rounds_only(spark, monkeypatch, wrong):
    right, lie = quantiles._sketch, {"far below": (-9.0, -8.0), "far above": (9000.0, 9001.0), "around nothing": (10.2, 10.3)}[wrong]
    calls = []

    def lying(df, wanted, extra=(), ends=False):
        row, brackets = right(df, wanted, extra, ends)
        calls.append(1)
        return (row, {k: [lie] * len(v) for k, v in brackets.items()}) if len(calls) == 1 else (row, brackets)

    monkeypatch.setattr(quantiles, "_sketch", lying)
    values = list(range(4000))
    assert same(quantiles.exact_quantiles(frame(spark, values), ["x"], P, final_limit=40)["x"], values)
    assert len(calls) > 1


def test_nothing_known(spark):
    got = quantiles.exact_quantiles(frame(spark, [None, float("nan")]), ["x"], (0.5,))
    assert got == {"x": [None]}
    row = profile.numeric_profile(frame(spark, [None]), ["x"]).first()
    assert (row["count"], row["mean"], row["median"]) == (0, None, None)


def test_values_outside_brackets_are_not_shuffled(spark):
    """The counting scan returns cells and the few values inside, whatever the column's distinct values."""
    df = spark.range(200_000).select((F.hash("id") / 7.0).alias("x"))
    open_ = {("x", 100_000): (None, None, 0, 200_000)}
    low, high = quantiles._sketch(df, {("x", None, None): [0.5]})[1]["x", None, None][0]
    cells = df.filter((F.col("x") >= low) & (F.col("x") <= high)).count()
    assert cells < 200_000 * 4 * quantiles.SPREAD
    found = {}
    quantiles._count_cells(df, open_, {("x", 100_000): (low, high)}, found, quantiles.BRACKET_LIMIT)
    assert not open_ and found["x", 100_000] == sorted(r[0] for r in df.collect())[100_000]
