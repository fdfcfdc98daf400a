"""Grouped aggregates, shares, top-k and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.operators.keyjoin import HOT_SHARE, PART_ROWS, hot_keys
from cartlens.session import materialize

MONEY = "decimal(28,10)"


def exact(column: str | Column) -> Column:
    """Money as a decimal of ten places, so that sums do not depend on the order of rows and amounts
    below a cent count. A total beyond 1e28 fails instead of wrapping."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast(MONEY)


def money_sum(column: str | Column) -> Column:
    """Exact sum, 0 for no value, as double."""
    return F.coalesce(F.sum(exact(column)).cast("double"), F.lit(0.0))


def money_avg(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(F.sum(exact(c)).cast("double"), F.count(c))


# Counted rows have this column: how many equal rows each one stands for (plans.factored).
JOINED_ROWS = "joined_rows"


def known(column: str) -> str:
    """Of counted rows with a total, the column with the number of rows that had a value."""
    return f"{column}__known"


def row_count(df: DataFrame, column: str | None = None) -> Column:
    """The number of rows, or of rows that know the column, plain or counted."""
    if JOINED_ROWS not in df.columns:
        return F.count(F.lit(1) if column is None else column)
    if column is not None and known(column) in df.columns:
        n = F.sum(known(column))
    else:
        n = F.sum(JOINED_ROWS if column is None else F.when(F.col(column).isNotNull(), F.col(JOINED_ROWS)))
    return F.coalesce(n, F.lit(0)).cast("bigint")


def row_sum(df: DataFrame, value: Column) -> Column:
    """The sum over rows, plain or counted, of a value that all rows a counted row stands for share."""
    return F.sum(value if JOINED_ROWS not in df.columns else value * F.col(JOINED_ROWS))


def row_mean(df: DataFrame, column: str) -> Column:
    """The mean over rows, plain or counted."""
    if JOINED_ROWS not in df.columns:
        return F.avg(column)
    total = F.sum(column) if known(column) in df.columns else F.sum(F.col(column) * F.col(JOINED_ROWS))
    return F.try_divide(total.cast("double"), row_count(df, column))


CELLS = 1 << 15  # bits of Spark's bitmap aggregate


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all known; groups of an unknown key are not reported."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(row_count(df).alias(name))


def share_of_total(grouped: DataFrame, value: str, out: str, digits: int | None = None) -> DataFrame:
    """Add 100 * value / total. The total is a scalar subquery over the same grouped plan,
    whose shuffle is reused, so no window pulls all groups into one task."""
    total = grouped.agg(F.sum(value).cast("double")).scalar()
    share = F.try_divide(F.col(value).cast("double") * 100.0, total)
    return grouped.withColumn(out, F.round(share, digits) if digits is not None else share)


def frequencies(df: DataFrame, *keys: str, name: str = "n", share: str = "share", digits: int | None = None) -> DataFrame:
    """Count and percent share per key."""
    return share_of_total(counts(df, *keys, name=name), name, share, digits)


def align_to(df: DataFrame, key: str, values: Sequence, position: str = "position") -> DataFrame:
    """One row per listed value in list order; values without data get nulls."""
    order = F.explode(
        F.array(*[F.struct(F.lit(i).alias(position), F.lit(v).alias(key)) for i, v in enumerate(values)])
    )
    listed = df.sparkSession.range(1).select(order.alias("o")).select("o.*")
    return listed.join(df, key, "left").orderBy(position)


def top_k(df: DataFrame, value: str, k: int, tiebreak: Sequence[str], ascending: bool = False) -> DataFrame:
    first = F.col(value).asc() if ascending else F.col(value).desc()
    return df.orderBy(first, *tiebreak).limit(k)


def top_per_group(df: DataFrame, key: str, k: int, order_by: Sequence[Column]) -> DataFrame:
    """The first k rows of every key, with their place. Spark keeps only k rows per key in each
    task before the shuffle, so a key with very many rows is not sorted in one place."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return df.withColumn("place", place).filter(F.col("place") <= k)


def keep_top_keys(df: DataFrame, key: str, k: int, weight: Column) -> DataFrame:
    """Rows whose key is among the k heaviest; those k keys are all that is broadcast."""
    totals = keyed(df, [key]).groupBy(key).agg(weight.alias("__w"))
    best = totals.orderBy(F.desc("__w"), key).limit(k).select(key)
    return df.join(F.broadcast(best), key, "left_semi")


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in other."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of left that are not in right."""
    return left.distinct().join(right.distinct(), left.columns, "left_anti")


def pivot_sum(df: DataFrame, row: str, column: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Money total per row and column value, 0 where there is none."""
    grouped = keyed(df, [row, column]).groupBy(row, column).agg(money_sum(value).alias("__v"))
    return _pivoted(grouped, row, column, values)


def _pivoted(grouped: DataFrame, row: str, column: str, values: Sequence | None) -> DataFrame:
    """One column per value from rows of (row, column, __v). Without given values they are read from
    the grouped rows, which are written once, so that df is not computed again to list them."""
    if not values:
        grouped = materialize(grouped, "pivot")
    pivoted = grouped.groupBy(row).pivot(column, list(values) if values else None)
    return pivoted.agg(F.first("__v")).na.fill(0)


def dense_grid(df: DataFrame, row: str, column: str, value: str, out: str = "total") -> DataFrame:
    """pivot_sum in long form: every row value with every column value."""
    wide = pivot_sum(df, row, column, value)
    return wide.unpivot([row], [c for c in wide.columns if c != row], column, out)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Count matrix with zeros."""
    return _pivoted(counts(df, row, column, name="__v"), row, column, values)


def melt(df: DataFrame, ids: Sequence[str], names: str, values: str) -> DataFrame:
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], names, values)


def append_row(df: DataFrame, row: DataFrame) -> DataFrame:
    return df.unionByName(row)


def state_city_totals(grouped: DataFrame, state: str, city: str, value: str) -> DataFrame:
    """Cities with their state totals and the grand total; level 0 city, 1 state, 3 all."""
    return grouped.rollup(state, city).agg(
        F.sum(value).alias(value), F.grouping_id().cast("int").alias("level")
    )


def quarterly_sum(df: DataFrame, ts: str, value: Column, out: str) -> DataFrame:
    """Sum per quarter, labelled with the quarter's last day; quarters without rows are 0."""
    start = F.date_trunc("quarter", F.col(ts)).cast("date")
    sums = df.filter(F.col(ts).isNotNull()).groupBy(start.alias("quarter_start")).agg(value.alias(out))
    span = sums.agg(F.min("quarter_start").alias("a"), F.max("quarter_start").alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 3 months"))).alias("quarter_start"))
    filled = spine.join(sums, "quarter_start", "left")
    return filled.select(
        F.last_day(F.add_months("quarter_start", 2)).alias("quarter_end"),
        F.coalesce(F.col(out), F.lit(0)).alias(out),
    )


def conditional_means(df: DataFrame, columns: Sequence[str], groups: Mapping[str, Column]) -> DataFrame:
    """Metrics as rows, one mean column per condition, in one pass."""
    aggs = [
        F.avg(F.when(condition, F.col(c))).alias(f"{g}__{c}") for g, condition in groups.items() for c in columns
    ]
    one = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("metric"), *[F.col(f"{g}__{c}").alias(g) for g in groups]) for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def measures_as_rows(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row per named aggregate."""
    one = df.agg(*[expr.cast("double").alias(name) for name, expr in measures.items()])
    return one.unpivot([], list(measures), "measure", "value")


def low_cardinality_columns(df: DataFrame, limit: int, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with fewer than limit distinct values, decided exactly.

    The number of hash cells a column's values fall into is never above their number. One pass
    without shuffling values marks those cells, and a column with at least limit of them, such as an
    id, is out for certain; the rest are counted.
    """
    columns = list(columns or df.columns)
    cells = df.agg(
        *[
            F.bitmap_count(F.bitmap_construct_agg(F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(CELLS))))).alias(c)
            for c in columns
        ]
    ).first()
    few = [c for c in columns if cells[c] < limit]
    if not few:
        return []
    exact = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in few]).first()
    return [c for c in few if exact[c] < limit]


def value_listing(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """column, value, count for several columns in one pass. df may be counted rows."""
    weight = [JOINED_ROWS] if JOINED_ROWS in df.columns else []
    texts = df.select(*weight, *[F.col(c).cast("string").alias(c) for c in columns])
    return counts(texts.unpivot(weight, list(columns), "column", "value"), "column", "value", name=name)


def distinct_and_sketched(
    df: DataFrame, key: str, columns: Mapping[str, str], error: float, hot_share: float = HOT_SHARE, part_rows: int = PART_ROWS
) -> DataFrame:
    """key, and for each of columns (name -> column) its exact number of distinct values per key as name and the
    estimate of a sketch as <name>_sketch. A null key is a key, a null value is none.

    A sketch takes kilobytes, so there must not be many of one key: distinct pairs are brought to their key before they
    are sketched, those of hot keys in parts. In one aggregate with several distinct counts Spark keeps the
    sketches of all columns beside every distinct pair.
    """
    hot = hot_keys(df, key, hot_share, part_rows)
    out = None
    for name, column in columns.items():
        pairs = df.select(F.col(key).alias(key), F.col(column).alias("__value")).distinct()
        if hot:
            kind = df.schema[key].dataType.simpleString()
            listed = F.broadcast(df.sparkSession.createDataFrame(list(hot.items()), f"`{key}` {kind}, __parts int"))
            part = F.coalesce(F.pmod(F.xxhash64("__value"), F.col("__parts")), F.lit(0).cast("bigint"))
            pairs = pairs.join(listed, key, "left").withColumn("__part", part).repartition(key, "__part")
        else:
            pairs = pairs.repartition(key)
        one = pairs.groupBy(key).agg(
            F.count("__value").alias(name), F.approx_count_distinct("__value", error).alias(f"{name}_sketch")
        )
        if out is None:
            out = one
        else:
            one = one.withColumnRenamed(key, "__key")
            out = out.join(one, out[key].eqNullSafe(one["__key"])).drop("__key")
    return out


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
