"""Row filters, null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_status(df: DataFrame, status: str = "delivered", column: str = "order_status") -> DataFrame:
    return df.filter(F.col(column) == status)


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    """Take a missing value from another column of the same row."""
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other)))


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop("any", subset=list(columns))


def before_month(df: DataFrame, column: str, month: str) -> DataFrame:
    """Rows of months before 'yyyy-MM', as a plain comparison that scans can prune on."""
    return df.filter(F.col(column) < F.to_timestamp(F.lit(f"{month}-01")))


def in_lists(df: DataFrame, lists: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose value is selected in every given column."""
    for column, values in lists.items():
        df = df.filter(F.col(column).isin(*values))
    return df


def in_year_from_month(df: DataFrame, column: str, year: int, after_month: int) -> DataFrame:
    """Rows of the year after a month (1 to 12), as two plain comparisons that scans can prune on."""
    first = f"{year}-{after_month + 1:02d}-01" if after_month < 12 else f"{year + 1}-01-01"
    low, high = (F.to_timestamp(F.lit(day)) for day in (first, f"{year + 1}-01-01"))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def impute_truncated_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the mean that counts nulls as zero, cut to an integer."""
    mean = df.agg(F.avg(F.coalesce(F.col(column), F.lit(0))).cast("int")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean).cast("int"))


def null_report(df: DataFrame) -> DataFrame:
    """column, null_count, null_percent for every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("null_count"), F.col("__rows").alias("rows"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries))).select(
        "column", "null_count", F.try_divide(F.col("null_count") * 100.0, F.col("rows")).alias("null_percent")
    )


def nulls_in_row(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(f"`{c}`").isNull().cast("int")
    return total


def null_rows_report(df: DataFrame) -> DataFrame:
    """Rows with and without nulls, and the most nulls in one row."""
    n = nulls_in_row(df.columns)
    return df.agg(
        F.count_if(n > 0).alias("rows_with_null"),
        F.count_if(n == 0).alias("rows_without_null"),
        F.max(n).alias("max_nulls_in_row"),
    )


def duplicate_report(df: DataFrame) -> DataFrame:
    """All rows, distinct rows and surplus copies. Copies collapse before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.sum("__copies").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("__copies") - F.count(F.lit(1))).alias("duplicate_rows"),
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) row per key in an explicit order.

    An aggregate over ordered structs: every task reduces its own rows first, so a key with
    very many rows never has to be sorted in one place.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in [*order_by, *rest]])
    picked = (F.max if last else F.min)(packed).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, "__row.*").select(*df.columns)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: numeric, string, timestamp or other."""

    def kind_of(t: T.DataType) -> str:
        if isinstance(t, T.NumericType):
            return "numeric"
        if isinstance(t, (T.StringType, T.VarcharType, T.CharType)):
            return "string"
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "timestamp"
        return "other"

    return [f.name for f in df.schema.fields if kind_of(f.dataType) == kind]


def projection(*column_lists: Sequence[str]) -> list[str]:
    """Union of column lists, each name once, in first-seen order."""
    return list(dict.fromkeys(c for columns in column_lists for c in columns))
