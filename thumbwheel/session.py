"""Session construction and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    app: str = "thumbwheel",
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE_KEY, ROCKSDB)
    )
    for key, setting in (settings or {}).items():
        builder = builder.config(key, setting)
    spark = builder.getOrCreate()
    ensure_work_folder(spark)
    return spark


def ensure_work_folder(spark: SparkSession) -> None:
    """Give a single-machine session that names no work folder a temporary one.

    For tests, the bench and ad-hoc local sessions. A cluster must name the
    folder itself: its machines could not see one made here.
    """
    if spark.sparkContext.master.startswith("local") and not _named_folder(spark):
        if not spark.sparkContext.master.startswith("local-cluster"):
            spark.conf.set(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="thumbwheel-"))


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; required."""
    root = _named_folder(spark)
    if not root:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the work folder; never reused, so writers cannot collide."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table in the work folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of what has ended: it does when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
