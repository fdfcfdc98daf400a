"""Work along a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlens.session import materialize


def _ranges(df: DataFrame, order_by: Sequence) -> DataFrame:
    """df split into key ranges, each row tagged with its range. Written once, so that the
    tags cannot differ between the two passes that need them."""
    ranged = df.repartitionByRange(*order_by)
    return materialize(ranged.withColumn("__range", F.spark_partition_id()), "ranges")


def running_totals(df: DataFrame, order_by: Sequence, totals: Mapping[str, str]) -> DataFrame:
    """Running sums along order_by; totals maps a value column to its output column.

    Ranges are summed first. Only one row per range is accumulated in one place, and each
    range is then accumulated on its own from where the earlier ranges ended. order_by must
    order rows uniquely.
    """
    ranged = _ranges(df, order_by)
    per_range = ranged.groupBy("__range").agg(*[F.sum(v).alias(f"__sum_{v}") for v in totals])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        "__range",
        *[F.coalesce(F.sum(f"__sum_{v}").over(earlier), F.lit(0)).alias(f"__start_{v}") for v in totals],
    )
    inside = Window.partitionBy("__range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select("*", *[F.sum(v).over(inside).alias(f"__run_{v}") for v in totals])
    # one row per range: its size is the number of shuffle partitions
    joined = summed.join(F.broadcast(starts), "__range")
    return joined.select(
        *df.columns, *[(F.col(f"__start_{v}") + F.col(f"__run_{v}")).alias(out) for v, out in totals.items()]
    )


def number_rows(df: DataFrame, order_by: Sequence, out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers along order_by, which must order rows uniquely."""
    numbered = running_totals(df.withColumn("__one", F.lit(1).cast("bigint")), order_by, {"__one": out})
    numbered = numbered.drop("__one")
    return numbered if start == 1 else numbered.withColumn(out, F.col(out) + F.lit(start - 1))


def first_seen_numbers(df: DataFrame, key: str, order_by: Sequence[str], out: str) -> DataFrame:
    """1-based number per distinct key, by its first appearance in order_by."""
    first = df.groupBy(key).agg(F.min(F.struct(*order_by)).alias("__first"))
    return number_rows(first, ["__first", key], out).drop("__first")


def lasting_numbers(df: DataFrame, key: str, order_by: Sequence[str], out: str, path: str) -> DataFrame:
    """Numbers per key that last: keys of an earlier run keep theirs, new keys get the numbers behind the highest,
    by first appearance in order_by.

    The table at path, key and out, is only ever appended to, in one commit per run, so a run that failed changes
    nothing and can be repeated. One run at a time. A null key is a key.
    """
    spark = df.sparkSession
    rows, highest = df, F.lit(0).cast("bigint")
    if _exists(spark, path):
        known = spark.read.parquet(path)
        rows = df.join(known, df[key].eqNullSafe(known[key]), "left_anti")
        highest = F.lit(known.agg(F.coalesce(F.max(out), F.lit(0))).first()[0]).cast("bigint")
    new = first_seen_numbers(rows, key, order_by, out)
    new.select(key, (F.col(out) + highest).cast("bigint").alias(out)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is there."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
