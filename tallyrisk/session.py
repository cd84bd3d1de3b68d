"""Session construction and run-wide settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for NTZ timestamps, ANSI
# arithmetic (overflow raises, like the NUMERIC contract), adaptive
# execution for shuffle coalescing, broadcast conversion and skew splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Joins on (key, bucket, value) keep rows that are hashed on (key, bucket) where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "tallyrisk", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; Spark's 1 GB default
        # is too small for the wider plans.  Effective only before JVM start.
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    return spark


def sizing_conf(input_bytes: int, executor_cores: int, executors: int,
                shuffle_share: float = 0.4, target_partition_bytes: int = 1536 * 1024 * 1024) -> dict[str, str]:
    """Partition settings for a given input volume (e.g. 100 TB on 1000 executors).

    The widest shuffle carries the pruned columns, about ``shuffle_share`` of
    the input; it is cut into partitions of about ``target_partition_bytes``,
    which spill rather than multiply the blocks (their number is map tasks times
    partitions).  AQE coalesces small partitions and splits skewed join
    partitions that exceed 5x the median.  At least a few waves of the cores.
    """
    cores = max(1, executor_cores * executors)
    parts = max(3 * cores, -(-int(input_bytes * shuffle_share) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 4),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, for tables that a job writes and reads again.

    On a cluster the setting is used as it is and must be there.  Only a local
    session (tests, bench) without it gets a folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tallyrisk-shared-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def stored(df, name: str):
    """Write a table to the shared folder and read it back: computed once, its size known to the optimizer."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if not getattr(sc, "_tallyrisk_shipped", False):
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-code-"), "tallyrisk_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._tallyrisk_shipped = True
    return spark


def silver_buckets(input_bytes: int, shuffle_share: float = 0.4, bucket_bytes: int = 1024 * 1024 * 1024) -> int:
    """Buckets of the silver transactions for a volume: about a gigabyte each."""
    return max(8, -(-int(input_bytes * shuffle_share) // bucket_bytes))
