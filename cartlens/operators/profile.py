"""Column profiles: moments, text summaries, histograms and density curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.operators import quantiles
from cartlens.operators.aggregates import counts, row_count

LETTER_PROBABILITIES = (0.0, 1 / 16, 0.125, 0.25, 0.5, 0.75, 0.875, 15 / 16, 1.0)


def _rows(one: DataFrame, entries: list[Column]) -> DataFrame:
    return one.select(F.inline(F.array(*entries)))


def numeric_profile(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """column, count, mean, std (sample), min, quartiles, max; exact. Plain rows are scanned twice: moments
    come with the sketches."""
    five = (0.0, 0.25, 0.5, 0.75, 1.0)
    if weight is None:
        x = {c: F.col(c).cast("double") for c in columns}
        moments = {f"{c}__{k}": f(x[c]) for c in columns for k, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp))}
        q, got = quantiles.sketched_quantiles(df, columns, five, also=moments)
        rows = [(c, got[f"{c}__n"], got[f"{c}__m"], got[f"{c}__s"], *q[c]) for c in columns]
        numbers = ", ".join(f"{name} double" for name in ("mean", "std", "min", "q25", "median", "q75", "max"))
        return df.sparkSession.createDataFrame(rows, f"`column` string, count bigint, {numbers}")
    q = quantiles.exact_quantiles(df, columns, five, weight)
    aggs = []
    for c in columns:
        x, w = F.col(c).cast("double"), F.when(F.col(c).isNotNull(), F.col(weight))
        total = F.sum(w).cast("double")
        # measured from the median, which keeps the squares small
        centre = F.lit(q[c][2]).cast("double")
        shift = F.sum((x - centre) * w) / total
        mean = centre + shift
        squares = F.sum((x - centre) * (x - centre) * w) - total * shift * shift
        std = F.sqrt(F.try_divide(F.greatest(squares, F.lit(0.0)), total - 1))
        aggs += [F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias(f"{c}__n"), mean.alias(f"{c}__m"), std.alias(f"{c}__s")]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__n").alias("count"),
            F.col(f"{c}__m").alias("mean"),
            F.col(f"{c}__s").alias("std"),
            *[
                F.lit(v).cast("double").alias(name)
                for name, v in zip(("min", "q25", "median", "q75", "max"), q[c])
            ],
        )
        for c in columns
    ]
    return _rows(df.agg(*aggs), entries)


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, count, unique, top (smallest of the most frequent values), freq."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    per_value = counts(texts.unpivot([], list(columns), "column", "value"), "column", "value")
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value")))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best["value"].alias("top"),
        (-best["minus_n"]).alias("freq"),
    )


def shape_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, skewness (population and sample-adjusted) and excess kurtosis (population)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.skewness(x).alias(f"{c}__g"), F.kurtosis(x).alias(f"{c}__k")]
    entries = []
    for c in columns:
        n = F.col(f"{c}__n").cast("double")
        adjusted = F.when(n > 2, F.col(f"{c}__g") * F.sqrt(n * (n - 1)) / (n - 2))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__n").alias("count"),
                F.col(f"{c}__g").alias("skew"),
                adjusted.alias("adjusted_skew"),
                F.col(f"{c}__k").alias("kurtosis"),
            )
        )
    return _rows(df.agg(*aggs), entries)


def fenced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns with null for values that are not strictly inside their IQR fence."""
    limits = quantiles.iqr_limits(df, columns)
    return df.select(*[F.when(quantiles.inside(c, limits[c], strict=True), F.col(c)).alias(c) for c in columns])


def shape_inside_fence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """shape_profile of the values strictly inside each column's IQR fence."""
    return shape_profile(fenced(df, columns), columns)


def near_normal(df: DataFrame, columns: Sequence[str], limit: float = 2.0) -> DataFrame:
    """column, skew, kurtosis and whether both lie within (-limit, limit)."""
    shape = shape_profile(df, columns)
    ok = (F.abs("skew") < limit) & (F.abs("kurtosis") < limit)
    return shape.select(
        "column", "skew", "kurtosis", F.when(ok, "normal").otherwise("not normal").alias("distribution")
    )


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """bin, bin_start, bin_end, n of equal-width bins; the last bin includes its right edge.

    Without limits the smallest and largest value are used, as scalar subqueries.
    """
    x = F.col(column).cast("double")
    known = df.filter(F.col(column).isNotNull())
    lo = F.lit(float(low)) if low is not None else known.agg(F.min(x)).scalar()
    hi = F.lit(float(high)) if high is not None else known.agg(F.max(x)).scalar()
    width = (hi - lo) / F.lit(float(bins))
    # one value only: everything is in bin 0
    index = F.least(F.coalesce(F.floor(F.try_divide(x - lo, width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    inside = known.filter((x >= lo) & (x <= hi))
    grouped = inside.groupBy(index.alias("bin")).agg(row_count(df).alias("n"))
    return grouped.select(
        "bin", (lo + F.col("bin") * width).alias("bin_start"), (lo + (F.col("bin") + 1) * width).alias("bin_end"), "n"
    )


def density_curve(df: DataFrame, column: str, points: int = 50, weight: str | None = None) -> DataFrame:
    """Gaussian kernel density on equally spaced points from the smallest to the largest value.

    Bandwidth: sample std * n^(-1/5). Values are counted first; every counted value then adds
    to `points` sums inside the tasks, so nothing but those sums is shuffled.
    """
    counted = quantiles.value_counts(df, [column], weight)
    x, n = F.col("value"), F.col("n").cast("double")
    total = F.sum(n)
    off = x - counted.agg(F.avg("value")).scalar()  # keeps the squares small
    mean = F.sum(off * n) / total
    moments = counted.agg(
        F.sum("n").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sqrt((F.sum(off * off * n) - total * mean * mean) / (total - 1)).alias("std"),
    ).first()
    bandwidth = moments["std"] * moments["n"] ** -0.2
    step = (moments["high"] - moments["low"]) / (points - 1)
    grid = [moments["low"] + step * i for i in range(points)]
    scale = 1.0 / (moments["n"] * bandwidth * (2 * 3.141592653589793) ** 0.5)

    def kernel(at: float) -> Column:
        z = (x - F.lit(float(at))) / F.lit(float(bandwidth))
        return F.sum(n * F.exp(z * z * F.lit(-0.5))) * F.lit(float(scale))

    sums = counted.agg(*[kernel(g).alias(f"__{i}") for i, g in enumerate(grid)])
    entries = [F.struct(F.lit(float(g)).alias("x"), F.col(f"__{i}").alias("density")) for i, g in enumerate(grid)]
    return _rows(sums, entries)


def letter_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = LETTER_PROBABILITIES) -> DataFrame:
    return quantiles.quantile_frame(df, columns, probabilities)


def zscore_filter(df: DataFrame, columns: Sequence[str], limit: float = 3.0, mode: str = "last") -> DataFrame:
    """Rows with |z| < limit by population std; a constant column drops every row.

    mode='last' tests the last column only, as published; mode='all' tests every column.
    """
    tested = list(columns) if mode == "all" else [columns[-1]]
    moments = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c)
                for c in tested
            ]
        )
    ).scalar()
    for c in tested:
        z = F.try_divide(F.col(c) - moments[c]["mean"], moments[c]["std"])
        df = df.filter(F.abs(z) < limit)
    return df


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    moments = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c)
                for c in columns
            ]
        )
    ).scalar()

    def scaled(c: str) -> Column:
        centred = F.col(c) - moments[c]["mean"]
        return F.when(moments[c]["std"] == 0, F.lit(0.0)).otherwise(F.try_divide(centred, moments[c]["std"]))

    return df.withColumns({c: scaled(c) for c in columns})
