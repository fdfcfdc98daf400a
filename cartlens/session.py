"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package assumes. Partition counts and memory
# are left to the cluster: AQE coalesces from whatever shuffle width is configured.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot order or product is split even when that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "cartlens", cores: str = "*", memory: str = "8g", shuffle: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture on every Column call costs more than the small queries themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="cartlens-")
    return _local_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so runs cannot collide."""
    return f"{shared_folder(spark)}/cartlens/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df once to the shared folder and read it back.

    Used where several later passes need the same expensive result. Lineage is cut by
    a file that survives executor loss, and the parquet size lets Catalyst decide on
    broadcasts by measurement.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
