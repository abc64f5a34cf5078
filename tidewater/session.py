"""Session helpers.

Library functions never create a session; they take the caller's.  The
builder here is for tests, ``bench.py`` and command-line use.  Scratch space
(CSV round trips, streaming checkpoints, lineage cuts) always lives under the
cluster's shared ``spark.checkpoint.dir``; a private temporary folder is only
used when that setting is missing *and* the session runs in local mode.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_ROOT: str | None = None


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks: AQE on, UI off, UTC, Arrow on."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or cpus
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # Local data is small: a low coalescing floor keeps several partitions
         # after a tiny shuffle, which matters when the next stage fans rows
         # out (sliding windows).  Irrelevant at cluster scale.
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                 os.environ.get("TIDEWATER_MIN_PARTITION_SIZE", "64k"))
         .config("spark.sql.session.timeZone", (extra or {}).get("spark.sql.session.timeZone", "UTC"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "12g"))
         .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Read from ``spark.checkpoint.dir``.  Only when it is unset and the master
    is local (tests, single-node runs) do we create one and record it in the
    session, so every later call sees the same folder.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        rdd_dir = sc.getCheckpointDir()
        if rdd_dir:
            root = rdd_dir.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: a cluster run needs a shared folder for "
                "checkpoints and scratch tables")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        root = _LOCAL_ROOT
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver remove a scratch table when it ends (results may read it until then)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later reads cost
    no recomputation, also when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Remove the shuffle files that no plan refers to any more.

    Spark removes them when the driver's garbage is collected, which a driver
    with little to do puts off while the files fill the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def scale_settings(input_bytes: int, total_cores: int, shuffle_ratio: float = 0.5,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the data, not from defaults.

    Shuffle partitions are chosen so one partition of the largest expected
    shuffle (``shuffle_ratio`` of the input after map-side combine) is about
    ``target_partition_bytes`` and there are at least 3 waves of tasks;
    AQE then coalesces small partitions and splits skewed ones.  Input splits
    stay at 256 MB.
    """
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    partitions = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
