"""Statistical tests. Spark reduces the data to group moments or sums over ranks; the statistics and their
p-values are columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.distributions import chi_square_tail, f_tail, normal_quantile, normal_tail
from cartlens.operators.ordered import running_totals
from cartlens.operators.profile import shape_profile

RANKS = 1 << 16


def anova(df: DataFrame, group: str, columns: Sequence[str], n: str | None = None) -> DataFrame:
    """feature, f_statistic, df_between, df_within of a one-way ANOVA per column."""
    weight = F.col(n) if n else F.lit(1)
    # measured from a central value, so that the squares of large values with a small spread do not cancel
    centre = df.agg(F.struct(*[F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in columns])).scalar()
    moments = []
    for c in columns:
        x, w = F.col(c).cast("double") - centre[c], F.when(F.col(c).isNotNull(), weight)
        moments += [
            F.sum(w).cast("double").alias(f"{c}__n"),
            F.sum(x * w).alias(f"{c}__s"),
            F.sum(x * x * w).alias(f"{c}__q"),
        ]
    groups = df.filter(F.col(group).isNotNull()).groupBy(group).agg(*moments)
    totals, entries = [], []
    for c in columns:
        size, s, q = F.col(f"{c}__n"), F.col(f"{c}__s"), F.col(f"{c}__q")
        totals += [
            F.sum(size).alias(f"{c}__n"),
            F.sum(s).alias(f"{c}__s"),
            F.sum(q).alias(f"{c}__q"),
            F.sum(s * s / size).alias(f"{c}__b"),
            F.count_if(size > 0).alias(f"{c}__k"),
        ]
        total = F.col(f"{c}__n")
        between = F.col(f"{c}__b") - F.col(f"{c}__s") * F.col(f"{c}__s") / total
        within = F.col(f"{c}__q") - F.col(f"{c}__b")
        df1, df2 = F.col(f"{c}__k") - 1, total - F.col(f"{c}__k")
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.try_divide(between / df1, within / df2).alias("f_statistic"),
                df1.cast("bigint").alias("df_between"),
                df2.cast("bigint").alias("df_within"),
            )
        )
    return groups.agg(*totals).select(F.inline(F.array(*entries)))


def with_f_p_value(tests: DataFrame) -> DataFrame:
    """Add p_value to the rows of anova."""
    return tests.withColumn("p_value", f_tail(F.col("f_statistic"), F.col("df_between"), F.col("df_within")))


def two_sample_t(df: DataFrame, group: str, columns: Sequence[str], first, second) -> DataFrame:
    """feature, t_statistic, degrees of an equal-variance t-test between two group values."""
    aggs, entries = [], []
    for c in columns:
        x = F.col(c).cast("double")
        for side, value in (("a", first), ("b", second)):
            picked = F.when(F.col(group) == value, x)
            aggs += [
                F.count(picked).cast("double").alias(f"{c}__{side}n"),
                F.avg(picked).alias(f"{c}__{side}m"),
                F.var_samp(picked).alias(f"{c}__{side}v"),
            ]
        na, ma, va = (F.col(f"{c}__a{k}") for k in "nmv")
        nb, mb, vb = (F.col(f"{c}__b{k}") for k in "nmv")
        pooled = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.try_divide(ma - mb, F.sqrt(pooled * (1 / na + 1 / nb))).alias("t_statistic"),
                (na + nb - 2).cast("bigint").alias("degrees"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def with_t_p_value(tests: DataFrame) -> DataFrame:
    """Add the two-sided p_value: t squared is F with 1 and n degrees."""
    t = F.col("t_statistic")
    return tests.withColumn("p_value", f_tail(t * t, F.lit(1), F.col("degrees")))


def chi_square_uniform(counted: DataFrame, n: str = "n") -> DataFrame:
    """statistic and degrees of observed counts against equal expected counts:
    sum((o - e)^2 / e) with e = total / k."""
    one = counted.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(n).cast("double").alias("total"),
        F.sum(F.col(n).cast("double") * F.col(n)).alias("squares"),
    )
    return one.select(
        (F.col("squares") * F.col("k") / F.col("total") - F.col("total")).alias("statistic"),
        (F.col("k") - 1).cast("bigint").alias("degrees"),
    )


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """statistic and degrees of the contingency table of two columns.

    sum(o^2 / (row * column)) * total - total, where cells without rows add nothing, so only
    observed cells are needed.
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(
        F.count(F.lit(1)).cast("double").alias("o")
    )
    row_totals = cells.groupBy(a).agg(F.sum("o").alias("r"))
    column_totals = cells.groupBy(b).agg(F.sum("o").alias("c"))
    joined = cells.join(row_totals, a).join(column_totals, b)
    one = joined.agg(
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("ratio"),
        F.sum("o").alias("total"),
        F.count_distinct(a).alias("rows"),
        F.count_distinct(b).alias("columns"),
    )
    return one.select(
        ((F.col("ratio") - 1) * F.col("total")).alias("statistic"),
        ((F.col("rows") - 1) * (F.col("columns") - 1)).cast("bigint").alias("degrees"),
    )


def with_chi2_p_value(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("degrees")))


def normality(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """column, statistic, p_value, is_normal: the omnibus test from skewness and kurtosis (Jarque-Bera), all
    columns in one pass. The statistic is chi-square with two degrees, whose tail is exp(-x / 2).
    A column without two different values has no statistic."""
    shape = shape_profile(df, columns)
    statistic = F.col("count") / 6 * (F.col("skew") * F.col("skew") + F.col("kurtosis") * F.col("kurtosis") / 4)
    tested = shape.select("column", F.when(~F.isnan("skew"), statistic).alias("statistic"))
    tested = tested.withColumn("p_value", F.exp(F.col("statistic") / -2))
    return tested.withColumn("is_normal", (F.col("p_value") > alpha).cast("int"))


def rank_normality(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """column, n, statistic, z, p_value, is_normal: the Shapiro-Francia test of all columns at once.

    The statistic is the squared correlation of the ordered values with the expected order statistics of a normal
    sample (Blom's scores). Its logarithm's distance from 1 is normal by Royston's fit, made for 5 to 5,000 values
    and continued beyond. Nulls and NaN are left out; a column with fewer than five values or no two different
    ones has no statistic.

    Ranks come from totals over ranges of values, so no task orders a column, and a value that many rows
    share is taken in blocks of ranks.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(F.inline(entries)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("copies"))
    ranked = running_totals(counted, ["column", "value"], {"copies": "upto"})
    x, w = F.col("value"), F.col("copies")
    sizes = ranked.groupBy("column").agg(
        F.sum("copies").alias("n"), (F.sum(x * w) / F.sum("copies")).alias("mean"), (F.max("upto") - F.sum("copies")).alias("before")
    )
    # one row per column
    ranked = ranked.join(F.broadcast(sizes), "column").withColumn("last", F.col("upto") - F.col("before"))
    block = F.explode(F.sequence(F.col("last") - w + 1, F.col("last"), F.lit(RANKS))).alias("begin")
    blocks = ranked.select("column", "n", (x - F.col("mean")).alias("d"), "last", block).repartition("column", "begin", "d")
    ranks = blocks.select("column", "n", "d", F.explode(F.sequence("begin", F.least("last", F.col("begin") + RANKS - 1))).alias("rank"))
    score = normal_quantile((F.col("rank") - 0.375) / (F.col("n") + 0.25))
    sums = ranks.withColumn("m", score).groupBy("column", "n").agg(
        F.sum(F.col("m") * F.col("d")).alias("md"), F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(F.col("d") * F.col("d")).alias("dd")
    )
    statistic = F.when((F.col("n") >= 5) & (F.col("dd") > 0), F.col("md") * F.col("md") / (F.col("mm") * F.col("dd")))
    u = F.log("n")
    centre, spread = -1.2725 + 1.0521 * (F.log(u) - u), 1.0308 - 0.26758 * (F.log(u) + 2 / u)
    tested = sums.select("column", "n", statistic.alias("statistic"))
    tested = tested.withColumn("z", (F.log(1 - F.col("statistic")) - centre) / spread)
    tested = tested.withColumn("p_value", normal_tail(F.col("z")))
    return tested.withColumn("is_normal", (F.col("p_value") > alpha).cast("int"))
