"""Statistics over counted rows: every row stands for n equal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _x(c: str) -> Column:
    return F.col(c).cast("double")


def centred(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns minus their plain means. Spread and correlation stay the same, and the squares of
    large values with a small spread do not cancel."""
    columns = list(dict.fromkeys(columns))
    means = df.agg(F.struct(*[F.coalesce(F.avg(_x(c)), F.lit(0.0)).alias(c) for c in columns])).scalar()
    return df.withColumns({c: _x(c) - means[c] for c in columns})


def _known(c: str, n: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.col(n))


def wsum(c: str, n: str) -> Column:
    return F.sum(_x(c) * F.col(n))


def wmean(c: str, n: str) -> Column:
    return F.try_divide(wsum(c, n), F.sum(_known(c, n)).cast("double"))


def weighted_means(df: DataFrame, by: Sequence[str], columns: Sequence[str], n: str = "n_rows") -> DataFrame:
    return df.groupBy(*by).agg(*[wmean(c, n).alias(c) for c in columns])


def standardised_means(df: DataFrame, by: str, columns: Sequence[str], n: str = "n_rows") -> DataFrame:
    """Group means of the columns after (x - mean) / population std over all rows.

    Standardising is linear, so the group mean of the standardised column follows from the
    plain group mean and the overall moments.
    """
    df = centred(df, columns)
    overall = df.agg(
        F.struct(
            *[
                F.struct(wmean(c, n).alias("mean"), _wvar_pop(c, n).alias("var")).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    groups = weighted_means(df, [by], columns, n)
    return groups.select(
        by,
        *[F.try_divide(F.col(c) - overall[c]["mean"], F.sqrt(overall[c]["var"])).alias(c) for c in columns],
    )


def _wvar_pop(c: str, n: str) -> Column:
    total = F.sum(_known(c, n)).cast("double")
    mean = wsum(c, n) / total
    return F.sum(_x(c) * _x(c) * F.col(n)) / total - mean * mean


def correlation_pairs(df: DataFrame, columns: Sequence[str], n: str | None = None) -> DataFrame:
    """feature_a, feature_b, correlation for every ordered pair, computed in one pass.

    Rows with a null in either column do not count for that pair.
    """
    columns = list(columns)
    df = centred(df, columns)
    aggs, entries = [], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if j < i:
                continue
            name = f"__{i}_{j}"
            aggs.append((_wcorr(a, b, n) if n else F.corr(_x(a), _x(b))).alias(name))
            entries.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(name).alias("correlation")))
            if i != j:
                entries.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.col(name).alias("correlation")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def _wcorr(a: str, b: str, n: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    w = F.when(both, F.col(n).cast("double"))
    x, y = _x(a), _x(b)
    total = F.sum(w)
    mx, my = F.sum(x * w) / total, F.sum(y * w) / total
    cov = F.sum(x * y * w) / total - mx * my
    vx = F.sum(x * x * w) / total - mx * mx
    vy = F.sum(y * y * w) / total - my * my
    return F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy))


def correlation_matrix(df: DataFrame, columns: Sequence[str], n: str | None = None) -> DataFrame:
    """One row per feature, one column per feature."""
    pairs = correlation_pairs(df, columns, n)
    return pairs.groupBy("feature_a").agg(
        *[F.max(F.when(F.col("feature_b") == c, F.col("correlation"))).alias(c) for c in columns]
    ).withColumnRenamed("feature_a", "feature")


def correlation_with(df: DataFrame, target: str, columns: Sequence[str], n: str | None = None, above: float | None = None) -> DataFrame:
    """Features by absolute correlation with the target, strongest first."""
    df = centred(df, [*columns, target])
    aggs = [(_wcorr(c, target, n) if n else F.corr(_x(c), _x(target))).alias(c) for c in columns]
    long = df.agg(*aggs).unpivot([], list(columns), "feature", "correlation")
    long = long.select("feature", F.abs("correlation").alias("correlation"))
    if above is not None:
        long = long.filter(F.col("correlation") > above)
    return long.orderBy(F.desc("correlation"), "feature")
