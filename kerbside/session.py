"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on.

    Times are exchanged as text without a zone, so the session zone decides
    what instant they mean; it is UTC everywhere. Shuffle sizing is left to
    adaptive execution and to the cluster's own settings. Streaming state is
    kept in RocksDB, off the heap.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, under the folder named by ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is used only where
    the setting is absent and the whole session lives on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/kerbside/{name}-{uuid.uuid4().hex}"
