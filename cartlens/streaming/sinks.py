"""Starting streaming queries and writing their micro-batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlens.session import scratch_path

# State lies in RocksDB, not on the heap; both sides of a join share one store, and its files are packed densely.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Progress files are renamed into place by the plain file system. Spark's other way guards against a second query on the same
# checkpoint, and on local disks starts several processes per file, about 0.08 s per micro-batch.
LONE_CONF = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
}

_STARTING = Lock()


@contextmanager
def stream_settings(spark: SparkSession, empty_batches: bool = True, alone: bool = False):
    """Settings a query takes over when it starts. One query starts at a time, so that none takes over another's settings."""
    wanted = STATE_CONF | ({} if empty_batches else {EMPTY_BATCHES: "false"}) | (LONE_CONF if alone else {})
    with _STARTING:
        before = {key: spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    writer, spark: SparkSession, checkpoint: str, once: bool = True, interval: str | None = None, empty_batches: bool = True,
    alone: bool = False,
) -> StreamingQuery:
    """empty_batches: whether a micro-batch without rows follows when the watermark has moved. Windows need it to be
    written; inner joins have nothing to add then, and it would only write their state again. alone: no other query can
    know the checkpoint, so nothing guards it against one."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    with stream_settings(spark, empty_batches, alone):
        query = writer.start()
        # sources take their settings when they are made, which is in the query's own thread
        while alone and query.isActive and query.status["message"].startswith("Initializing"):
            time.sleep(0.01)
        return query


def to_console(df: DataFrame, checkpoint: str, rows: int = 20, **kw) -> StreamingQuery:
    """The size and the first rows of every micro-batch. Spark's console sink shows the same rows, but brings the whole
    micro-batch to the driver first."""

    def write(batch: DataFrame, batch_id: int) -> None:
        line = "-" * 43
        print(f"{line}\nBatch: {batch_id}\n{line}")
        batch.show(rows)
        print(f"rows: {batch.count()}")

    return to_batches(df, write, checkpoint, **kw)


def to_files(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer, df.sparkSession, checkpoint, **kw)


def to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, **kw) -> StreamingQuery:
    """Rows as JSON messages."""
    messages = df.select(F.to_json(F.struct("*")).alias("value"))
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return start(writer, df.sparkSession, checkpoint, **kw)


def batch_writer(path: str, table: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that appends each micro-batch as its own partition.

    A micro-batch that is run again after a failure overwrites its own partition, so rows are
    never appended twice. With a table name the folder is registered as that table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        if table is not None:
            spark = batch.sparkSession
            if not spark.catalog.tableExists(table):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
                spark.sql(
                    f"CREATE TABLE {table} ({columns}, batch_id BIGINT) USING parquet "
                    f"PARTITIONED BY (batch_id) LOCATION '{path}'"
                )
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (batch_id={batch_id}) LOCATION '{target}'")

    return write


def to_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", **kw) -> StreamingQuery:
    return start(df.writeStream.outputMode(mode).foreachBatch(write), df.sparkSession, checkpoint, **kw)


def figure_writer(path: str, partials: Mapping[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that writes what each micro-batch adds to some figures. Each partial reads the
    micro-batch for itself, and one that is run again overwrites its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, partial in partials.items():
            partial(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    return write


def drain(df: DataFrame, label: str, **kw) -> DataFrame:
    """Process everything a stream has now into files of the shared folder and read them back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    to_files(df, f"{path}/rows", f"{path}/checkpoint", alone=True, **kw).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")
