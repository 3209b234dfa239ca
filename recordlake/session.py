"""Session helpers: durable cut points and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache, wraps

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are meant to run with; the caller's session decides.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on disk with incremental snapshots instead of executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Rows and bytes that travel to a Python worker at once. The defaults (10,000 rows) are meant
# for narrow rows; of whole texts they hold hundreds of MB several times over.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session; results do not depend on it."""
    for key, value in ARROW_BATCHES.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one JVM (``local``, ``local[n]``) may fall back to a temporary folder
    of this machine, removed when the process ends. Anywhere else the setting is required,
    because executors can be lost and their disks with them, and it must name storage that
    all of them reach; a ``file:`` address is taken to be a mounted shared file system.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        # One JVM: a folder of this machine is shared. It goes when the process ends.
        configured = tempfile.mkdtemp(prefix="recordlake-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and cut its lineage: same rows, partitions and order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def built_once(build):
    """Build large expressions once per application: columns are immutable and unbound."""
    cached = lru_cache(maxsize=64)(lambda app, *args: build(*args))

    @wraps(build)
    def call(*args):
        return cached(SparkContext.getOrCreate().applicationId, *args)

    return call
