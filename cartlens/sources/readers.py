"""Batch sources. Every reader takes an explicit schema unless inference is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens import schemas


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """CSV with a header line. Without a schema Spark scans the file once more to infer it.
    Comments with line breaks need multiLine=True, which keeps a file in one task."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_tables(spark: SparkSession, folder: str, files: dict[str, str]) -> dict[str, DataFrame]:
    """The commerce tables from CSV files: table name -> file name below folder."""
    return {name: read_csv(spark, f"{folder}/{file}", schemas.TABLES[name]) for name, file in files.items()}


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_parquet(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition: tuple[str, object, object, int] | None = None,
    **options: str,
) -> DataFrame:
    """Result of a SQL query that an external database runs.

    partition = (column, lower, upper, number) splits the read over tasks; it needs the
    query as a derived table, because Spark does not split the plain 'query' option.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, number = partition
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(number))
        .load()
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first n rows of an explicit order."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the count of non-null values."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"__{i}").alias("non_null"),
            F.col("__rows").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))
