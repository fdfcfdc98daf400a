"""Tails and quantiles against closed forms and the standard library; the rank test against a plain one."""

import math
import random
from statistics import NormalDist, fmean

from pyspark.sql import functions as F

from cartlens.functions import distributions as dist
from cartlens.operators import stattests


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_log_gamma(spark):
    for x in (0.5, 1.0, 2.5, 30.0, 4e4):
        got = spark.createDataFrame([(x,)], "x double").select(dist.log_gamma(F.col("x"))).first()[0]
        assert math.isclose(got, math.lgamma(x), rel_tol=1e-11, abs_tol=1e-10)


def test_tails_equal_closed_forms(spark):
    cases = [(0.01,), (0.7,), (1.9,), (6.0,), (40.0,)]
    df = spark.createDataFrame(cases, "x double")
    x = F.col("x")
    got = df.select(
        "x", dist.chi_square_tail(x, F.lit(1)), dist.chi_square_tail(x, F.lit(6)), dist.f_tail(x, F.lit(2), F.lit(9)),
        dist.f_tail(x, F.lit(1), F.lit(1)), dist.f_tail(x, F.lit(1), F.lit(10**7)),
    ).collect()
    for v, chi1, chi6, f29, f11, large in got:
        assert math.isclose(chi1, math.erfc(math.sqrt(v / 2)), rel_tol=1e-10)
        h = v / 2
        assert math.isclose(chi6, math.exp(-h) * (1 + h + h * h / 2), rel_tol=1e-10)
        assert math.isclose(f29, (1 + 2 * v / 9) ** -4.5, rel_tol=1e-10)
        assert math.isclose(f11, 1 - 2 / math.pi * math.atan(math.sqrt(v)), rel_tol=1e-9)
        assert math.isclose(large, math.erfc(math.sqrt(v / 2)), rel_tol=1e-4)


def test_edges(spark):
    null = F.lit(None).cast("double")
    row = one(
        spark, dist.f_tail(null, F.lit(1), F.lit(1)), dist.f_tail(F.lit(0.0), F.lit(1), F.lit(5)), dist.f_tail(F.lit(1.0), F.lit(0), F.lit(5)),
        dist.f_tail(F.lit(float("inf")), F.lit(1), F.lit(5)), dist.chi_square_tail(null, F.lit(2)), dist.chi_square_tail(F.lit(3.0), F.lit(0)),
    )
    assert tuple(row) == (None, 1.0, None, 0.0, None, 1.0)


def test_normal(spark):
    ps = [(p,) for p in (1e-12, 0.001, 0.02425, 0.3, 0.5, 0.9, 0.99999)]
    for p, z, back in spark.createDataFrame(ps, "p double").withColumn("z", dist.normal_quantile(F.col("p"))).select("p", "z", dist.normal_tail(-F.col("z"))).collect():
        assert math.isclose(z, NormalDist().inv_cdf(p), rel_tol=2e-9, abs_tol=1e-12)
        assert math.isclose(back, p, rel_tol=1e-6)


def plain(values):
    n, mean = len(values), fmean(values)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    d = [v - mean for v in sorted(values)]
    if n < 5 or not any(d):
        return None
    return sum(a * b for a, b in zip(m, d)) ** 2 / (sum(a * a for a in m) * sum(b * b for b in d))


def test_rank_normality_equals_a_plain_one(spark, monkeypatch):
    monkeypatch.setattr(stattests, "RANKS", 16)  # ties of several blocks
    draw = random.Random(5)
    rows = [
        (draw.gauss(1e6, 2), draw.expovariate(1), float(min(draw.randrange(12), 3)), 7.0, float(k) if k < 6 else None, 1.0 if k < 4 else float("nan"))
        for k in range(300)
    ]
    df = spark.createDataFrame(rows, "normal double, skewed double, tied double, constant double, few double, too_few double")
    got = {r["column"]: r for r in stattests.rank_normality(df, df.columns).collect()}
    for k, name in enumerate(df.columns):
        values = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        want = plain(values)
        assert got[name]["n"] == len(values)
        if want is None:
            assert got[name]["statistic"] is None and got[name]["p_value"] is None
        else:
            assert math.isclose(got[name]["statistic"], want, rel_tol=1e-8)
    assert (got["normal"]["is_normal"], got["skewed"]["is_normal"], got["tied"]["is_normal"], got["few"]["is_normal"]) == (1, 0, 0, 1)


def test_rank_normality_of_nothing(spark):
    assert stattests.rank_normality(spark.createDataFrame([], "x double"), ["x"]).count() == 0
