"""Streams of JSON messages as typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens import schemas
from cartlens.operators.ordered import number_rows
from cartlens.session import materialize

STREAMED = ("orders", "customers", "order_items", "order_payments", "order_reviews")


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """The messages between two offsets, for a bounded poll."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", starting).option("endingOffsets", ending).load()


def parse_json(messages: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of the JSON text in the value column; keep passes message columns along, such
    as the arrival timestamp."""
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(data, *keep).select("data.*", *keep)


def topic_tables(spark: SparkSession, servers: str, topics: dict[str, str], **options: str) -> dict[str, DataFrame]:
    """One typed stream per table: table name -> topic. The arrival time of each message is
    kept as <table>_at, for time-bounded joins."""
    return {
        table: parse_json(kafka_stream(spark, servers, topic, **options), schemas.TABLES[table], ("timestamp",))
        .withColumnRenamed("timestamp", f"{table}_at")
        for table, topic in topics.items()
    }


def keyed_messages(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Rows as JSON messages keyed by a running counter from 0 along order_by.

    Equal rows are told apart by an id that is written down before it is used, so that any
    number of copies of one row is still spread over several tasks.
    """
    packed = df.select(*order_by, F.to_json(F.struct("*")).alias("value"))
    packed = materialize(packed.withColumn("__id", F.monotonically_increasing_id()), "messages")
    numbered = number_rows(packed, [*order_by, "value", "__id"], "n", start=0)
    return numbered.select(F.col("n").cast("string").alias("key"), "value")


def write_chunks(messages: DataFrame, path: str, rows_per_chunk: int = 35) -> None:
    """Messages as files of at most rows_per_chunk messages, to be replayed one by one."""
    messages.write.option("maxRecordsPerFile", rows_per_chunk).parquet(path)


def replay(spark: SparkSession, path: str, chunks_per_trigger: int = 1) -> DataFrame:
    """Stream of the chunks; the trigger interval of the query sets the pace."""
    stream = spark.readStream.schema("`key` string, value string")
    return stream.option("maxFilesPerTrigger", chunks_per_trigger).parquet(path)
