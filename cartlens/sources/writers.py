"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_state_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    partition: str = "customer_state",
    fmt: str = "orc",
    files_per_state: int | None = None,
) -> None:
    """Overwrite an ORC table laid out by state.

    With files_per_state the rows are first shuffled on the state and a hash of the order,
    so that each state gets that many files and a state with a third of all rows is still
    spread; without it every task writes into every state it meets.
    """
    if files_per_state:
        df = df.repartition(F.col(partition), F.pmod(F.xxhash64("order_id"), F.lit(files_per_state)))
    writer = df.write.format(fmt).mode("overwrite").partitionBy(partition)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def json_values(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in a value column, as a topic sink expects them."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)
