"""Cleaning, aggregation and shape operators on tiny frames."""

import math

import numpy as np
import pytest
from conftest import rows, values
from pyspark.sql import functions as F

from cartlens.functions.distributions import chi_square_tail, f_tail
from cartlens.operators import aggregates as agg
from cartlens.operators import clean, profile, stattests, weighted


def test_keep_one(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", 5, "z")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(clean.keep_one(df, ["k"], ["t", "v"])) == [("a", 1, "b"), ("b", 5, "z")]
    assert rows(clean.keep_one(df, ["k"], ["t", "v"], last=True)) == [("a", 2, "x"), ("b", 5, "z")]


def test_null_reports(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = [(c, n, round(p, 2)) for c, n, p in rows(clean.null_report(df))]
    assert got == [("a", 1, 33.33), ("b", 2, 66.67)]
    assert rows(clean.null_rows_report(df)) == [(2, 1, 2)]


def test_impute_counts_nulls_as_zero(spark):
    df = spark.createDataFrame([(5,), (5,), (5,), (None,)], "s int")  # mean 3.75
    assert sorted(r[0] for r in clean.impute_truncated_mean(df, "s").collect()) == [3, 5, 5, 5]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, None)] * 2, "k int, v string")
    assert rows(clean.duplicate_report(df)) == [(5, 2, 3)]
    assert clean.drop_duplicates(df).count() == 2


def test_zscore_modes(spark):
    data = [(float(i % 2), float(i % 2), 1.0) for i in range(20)] + [(0.0, 50.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    assert profile.zscore_filter(df, ["a", "b"]).count() == 20
    assert profile.zscore_filter(df, ["b", "a"]).count() == 21  # only the last column counts
    assert profile.zscore_filter(df, ["b", "a"], mode="all").count() == 20
    assert profile.zscore_filter(df, ["c"]).count() == 0  # constant: z undefined


def test_groups_of_unknown_keys_are_left_out(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(agg.counts(df, "k")) == [("a", 2)]
    assert rows(agg.frequencies(df, "k")) == [("a", 2, 100.0)]


def test_shares_sum_to_100(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"))
    total = agg.frequencies(df, "k").agg(F.sum("share")).first()[0]
    assert math.isclose(total, 100.0)


def test_money_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert df.agg(agg.money_sum("x")).first()[0] == 1.0
    assert df.agg(agg.money_avg("x")).first()[0] == 0.1
    empty = df.filter("x > 5").agg(agg.money_sum("x"), agg.money_avg("x")).first()
    assert tuple(empty) == (0.0, None)


def test_align_to_keeps_list_order(spark):
    df = spark.createDataFrame([("b", 1), ("z", 2)], "k string, n int")
    assert rows(agg.align_to(df, "k", ["c", "b"]), "position") == [("c", 0, None), ("b", 1, 1)]


def test_dense_grid_equals_plain_sum(spark):
    data = [("m1", "x", 1.5), ("m1", "x", 2.0), ("m2", "y", 3.0), (None, "y", 9.0)]
    df = spark.createDataFrame(data, "m string, t string, v double")
    got = rows(agg.dense_grid(df, "m", "t", "v"))
    assert got == [("m1", "x", 3.5), ("m1", "y", 0.0), ("m2", "x", 0.0), ("m2", "y", 3.0)]


def test_crosstab(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "r int, c string")
    assert rows(agg.crosstab(df, "r", "c"), "r") == [(1, 2, 0), (2, 0, 1)]


def test_empty_quarters_are_zero(spark):
    df = spark.sql("select explode(array(timestamp'2020-02-03', timestamp'2020-11-30')) as t, 2L as v")
    got = rows(agg.quarterly_sum(df, "t", F.sum("v"), "v"), "quarter_end")
    assert [(str(d), v) for d, v in got] == [("2020-03-31", 2), ("2020-06-30", 0), ("2020-09-30", 0), ("2020-12-31", 2)]


def test_state_city_totals(spark):
    df = spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("t", "a", 4)], "s string, c string, n int")
    got = {(r["s"], r["c"]): (r["n"], r["level"]) for r in agg.state_city_totals(df, "s", "c", "n").collect()}
    assert got[("s", None)] == (3, 1) and got[(None, None)] == (7, 3) and got[("t", "a")] == (4, 0)


def test_semi_and_anti_complete_each_other(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.createDataFrame([(2,), (2,), (None,), (11,)], "k long")
    missing = agg.without(left, right, "k")
    assert missing.count() == 9
    assert agg.set_difference(left, right).count() == 9


def test_top_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), ("c", 5)], "k string, v int")
    assert {r["k"] for r in agg.keep_top_keys(df, "k", 2, F.count(F.lit(1))).collect()} == {"b", "c"}


def test_low_cardinality(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("m"))
    assert agg.low_cardinality_columns(df, 10) == ["m"]
    assert rows(agg.value_listing(df, ["m"])) == [("m", "0", 34), ("m", "1", 33), ("m", "2", 33)]


def test_conditional_means_skip_zero_margin(spark):
    df = spark.createDataFrame([(1, 5.0), (0, 100.0), (-1, 3.0)], "margin int, s double")
    groups = {"on_time": F.col("margin") > 0, "late": F.col("margin") < 0}
    assert rows(agg.conditional_means(df, ["s"], groups)) == [("s", 5.0, 3.0)]


def test_histogram_right_edge_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "x double")
    got = [(b, n) for b, _, _, n in rows(profile.histogram(df, "x", 5), "bin")]
    assert got == [(0, 2), (4, 2)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(same, "x", 5).collect()] == [(0, 2)]


def test_density_curve(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=400).round(2)
    curve = profile.density_curve(spark.createDataFrame([(float(v),) for v in x], "x double"), "x", 11)
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in curve.collect():
        want = np.exp(-0.5 * ((x - r["x"]) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert math.isclose(r["density"], want, rel_tol=1e-9)


def test_text_profile_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "t string")
    assert rows(profile.text_profile(df, ["t"])) == [("t", 4, 2, "a", 2)]


def test_numeric_profile_with_weights_equals_repeated_rows(spark):
    data = [(1.0, 3), (4.0, 1), (10.0, 2)]
    weighted_df = spark.createDataFrame(data, "x double, n int")
    plain = weighted_df.select(F.explode(F.array_repeat("x", F.col("n"))).alias("x"))
    a = rows(profile.numeric_profile(weighted_df, ["x"], "n"))[0]
    b = rows(profile.numeric_profile(plain, ["x"]))[0]
    assert a[0] == b[0] and np.allclose([float(v) for v in a[1:]], [float(v) for v in b[1:]])


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows(profile.standardise(df, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_weighted_statistics_equal_repeated_rows(spark):
    rng = np.random.default_rng(3)
    data = [(float(a), float(b), int(n), int(g)) for a, b, n, g in zip(
        rng.normal(size=60), rng.normal(size=60), rng.integers(1, 6, 60), rng.integers(0, 3, 60))]
    df = spark.createDataFrame(data, "a double, b double, n_rows int, g int")
    plain = df.select("a", "b", "g", F.explode(F.sequence(F.lit(1), "n_rows"))).drop("col")
    got = {(r[0], r[1]): r[2] for r in weighted.correlation_pairs(df, ["a", "b"], "n_rows").collect()}
    assert math.isclose(got["a", "b"], plain.select(F.corr("a", "b")).first()[0], rel_tol=1e-9)
    assert math.isclose(got["a", "a"], 1.0)
    f1 = stattests.anova(df, "g", ["a"], "n_rows").first()
    f2 = stattests.anova(plain, "g", ["a"]).first()
    assert math.isclose(f1["f_statistic"], f2["f_statistic"], rel_tol=1e-9) and f1["df_within"] == f2["df_within"]
    std = {r["g"]: r["a"] for r in weighted.standardised_means(df, "g", ["a"]).collect()}
    scaled = {r["g"]: r["m"] for r in profile.standardise(plain, ["a"]).groupBy("g").agg(F.avg("a").alias("m")).collect()}
    assert all(math.isclose(std[g], scaled[g], rel_tol=1e-9) for g in std)


def test_p_values(spark):
    # textbook values: F(2, 12) = 3.89 and chi2(1) = 3.84 are the five percent points
    tails = f_tail(F.lit(3.885), F.lit(2), F.lit(12)), chi_square_tail(F.lit(3.841), F.lit(1))
    assert all(abs(p - 0.05) < 1e-3 for p in spark.range(1).select(*tails).first())
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 3.0), ("b", 4.0)], "g string, x double")
    t = stattests.with_t_p_value(stattests.two_sample_t(df, "g", ["x"], "a", "b")).first()
    assert math.isclose(t["t_statistic"], -1.224744871391589) and t["degrees"] == 4
    assert abs(t["p_value"] - 0.2878641) < 1e-6
    f = stattests.with_f_p_value(stattests.anova(df, "g", ["x"])).first()
    assert math.isclose(f["f_statistic"], t["t_statistic"] ** 2) and math.isclose(f["p_value"], t["p_value"])


def test_chi_square(spark):
    counted = spark.createDataFrame([("a", 30), ("b", 20), ("c", 15), ("d", 35)], "k string, n int")
    got = stattests.with_chi2_p_value(stattests.chi_square_uniform(counted)).first()
    assert math.isclose(got["statistic"], 10.0) and got["degrees"] == 3 and abs(got["p_value"] - 0.018566) < 1e-5
    table = {("x", "p"): 10, ("x", "q"): 20, ("y", "p"): 30, ("y", "q"): 0}
    df = spark.createDataFrame([k for k, n in table.items() for _ in range(n)], "a string, b string")
    got = stattests.chi_square_independence(df, "a", "b").first()
    assert math.isclose(got["statistic"], 30.0) and got["degrees"] == 1


def test_normality(spark):
    """The omnibus statistic of the published formula; its tail of chi-square with two degrees is exp(-x / 2)."""
    rng = np.random.default_rng(0)
    data = [(float(a), float(b), 3.0) for a, b in zip(rng.normal(size=500), rng.exponential(size=500))]
    df = spark.createDataFrame(data, "n double, e double, c double")
    got = {r["column"]: r for r in stattests.normality(df, ["n", "e", "c"], alpha=0.01).collect()}
    for k, name in enumerate("ne"):
        x = np.array([r[k] for r in data])
        m = x - x.mean()
        skew, kurtosis = (m**3).mean() / (m**2).mean() ** 1.5, (m**4).mean() / (m**2).mean() ** 2 - 3
        statistic = len(x) / 6 * (skew**2 + kurtosis**2 / 4)
        assert math.isclose(got[name]["statistic"], statistic, rel_tol=1e-9)
        assert math.isclose(got[name]["p_value"], math.exp(-statistic / 2), rel_tol=1e-9, abs_tol=1e-300)
    assert got["n"]["is_normal"] == 1 and got["e"]["is_normal"] == 0 and got["c"]["statistic"] is None


def test_money_below_a_cent_counts(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"), F.lit("a").alias("k"))
    assert values(df.agg(agg.money_sum("v"))) == [4.0]
    assert values(df.agg(agg.money_avg("v"))) == [0.004]
    assert values(agg.pivot_sum(df.withColumn("c", F.lit("x")), "k", "c", "v").select("x")) == [4.0]


def test_large_values_with_a_small_spread(spark):
    data = [(k % 3, float(k % 3) + (k % 7) / 10, float(k % 5), 1 + k % 2) for k in range(300)]
    small = spark.createDataFrame(data, "g int, x double, y double, n int")
    large = small.withColumns({"x": F.col("x") + 1e9, "y": F.col("y") + 1e9})
    f = [stattests.anova(d, "g", ["x"], "n").first()["f_statistic"] for d in (small, large)]
    assert abs(f[0] - f[1]) < 1e-4 * f[0]
    c = [{(r[0], r[1]): r[2] for r in weighted.correlation_pairs(d, ["x", "y"], "n").collect()} for d in (small, large)]
    assert all(abs(c[0][k] - c[1][k]) < 1e-6 for k in c[0])


def test_distinct_and_sketched_by_key(spark):
    data = [(k, n % m, n % 7) for k, m in (("hot", 900), ("few", 3), (None, 5)) for n in range(1000)] + [("none", None, None)]
    df = spark.createDataFrame(data, "k string, a int, b int")
    for limit in ({}, {"hot_share": 0.01, "part_rows": 100}):
        got = agg.distinct_and_sketched(df, "k", {"x": "a", "y": "b"}, 0.02, **limit)
        assert {tuple(r)[0::2] for r in got.select("k", "x_sketch", "x", "y_sketch", "y").collect()} == {
            ("hot", 900, 7), ("few", 3, 7), (None, 5, 7), ("none", 0, 0)
        }
        for r in got.collect():
            assert abs(r["x_sketch"] - r["x"]) <= 0.1 * r["x"] and r["y_sketch"] == r["y"]
        # sketches are made of rows that lie with their key, not beside every distinct pair
        assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_value_listing_of_counted_rows(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 5), (None, 2, 7)], f"c string, m int, {agg.JOINED_ROWS} bigint")
    assert rows(agg.value_listing(df, ["c", "m"])) == [("c", "a", 2), ("c", "b", 5), ("m", "1", 7), ("m", "2", 7)]


def test_low_cardinality_values_come_from_reduced_tables(spark, folder, monkeypatch):
    from cartlens.catalog import cleaning
    from cartlens.catalog.registry import Data

    # the rows of the wide join are not made
    monkeypatch.setattr(Data, "raw_wide", property(lambda self: pytest.fail("joins all rows")))
    assert cleaning.b19(Data(spark, folder)).count() == 8
