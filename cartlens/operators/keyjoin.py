"""Joins when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key above this share of all rows is split, and so is what lies in one part; it bounds the list of keys.
HOT_SHARE = 0.0001
# Keys of fewer rows stay whole.
PART_ROWS = 1_000_000


def attach_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    size: str,
    spread_by: Sequence[str],
    hot_share: float = HOT_SHARE,
    part_rows: int = PART_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Put the per-key columns next to every row.

    size is the per_key column with the number of rows of the key. A key with more rows than a part
    may have, part_rows or hot_share of all rows, is split into as many parts as that takes, by a
    hash of spread_by, and its per-key row is repeated for each part. At most 1 / hot_share keys
    can be hot, which bounds the list that is broadcast whatever the data size.
    """
    limit = per_key.agg(F.greatest(F.sum(size) * F.lit(hot_share), F.lit(float(part_rows)))).scalar()
    wanted = F.ceil(F.col(size) / limit).cast("int")
    hot = per_key.filter(F.col(size) > limit).select(key, wanted.alias("__parts"))
    part = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("__parts")).cast("int")).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("__part", part).drop("__parts")
    parts = F.when(F.col(size) > limit, F.sequence(F.lit(0), wanted - 1)).otherwise(F.array(F.lit(0)))
    right = per_key.withColumn("__part", F.explode(parts))
    return left.join(right, [key, "__part"], how).drop("__part")


def hot_keys(df: DataFrame, key: str, hot_share: float = HOT_SHARE, part_rows: int = PART_ROWS) -> dict:
    """Keys that hold more rows than a part may have (part_rows or hot_share of all rows), each with the
    number of parts it takes, by a frequent-items sketch over one column.

    At most 1 / hot_share keys qualify. The sketch only steers how rows are spread; a key it
    misses is still joined correctly.
    """
    k = int(1 / hot_share)
    one = df.agg(F.expr(f"approx_top_k({key}, {k}, {min(10 * k, 1_000_000)})").alias("top"), F.count(key).alias("n"))
    limit = F.greatest(F.col("n") * hot_share, F.lit(float(part_rows)))
    rows = one.select(F.inline("top"), "n").filter(F.col("count") > limit)
    return {r["item"]: r["parts"] for r in rows.select("item", F.ceil(F.col("count") / limit).cast("int").alias("parts")).collect()}


def split_hot_join(rows: DataFrame, other: DataFrame, key: str, hot: Mapping) -> DataFrame:
    """Inner join in which the rows of the given hot keys are spread over their number of parts and the
    other side's rows of these keys are repeated for each part.

    rows must come straight from storage: the part of a row is its place in its file split,
    which spreads even equal copies of one row and is the same when a task is run again.
    """
    if not hot:
        return other.join(rows, key)
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    listed = F.broadcast(spark.createDataFrame(list(hot.items()), f"`{key}` {kind}, __parts int"))
    # the place is taken before the join, which may move rows
    left = rows.withColumn("__place", F.monotonically_increasing_id()).join(listed, key, "left")
    place = F.pmod("__place", F.col("__parts")).cast("int")
    left = left.withColumn("__part", F.coalesce(place, F.lit(0))).drop("__place", "__parts")
    parts = F.when(F.col("__parts").isNotNull(), F.sequence(F.lit(0), F.col("__parts") - 1)).otherwise(F.array(F.lit(0)))
    right = other.join(listed, key, "left").withColumn("__part", F.explode(parts)).drop("__parts")
    return right.join(left, [key, "__part"]).drop("__part")
