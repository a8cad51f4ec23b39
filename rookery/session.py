"""Session settings and scratch space shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the models rely on. None of them sizes the cluster:
# partition counts stay with the session and with adaptive execution.
RUNTIME_CONF = {
    # Dates are cut from epoch seconds, so the session clock must be UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge session windows inside each map task before the shuffle, so that a
    # hot key sends one row per session and task instead of one per event.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Ids and texts take half the room of the default codec, on disk and on the way there.
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Ids of random digits take half the room there.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}

_own_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a fresh temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _own_scratch:
        root = tempfile.mkdtemp(prefix="rookery-")
        context.setCheckpointDir(root)
        _own_scratch[context.applicationId] = root
    return _own_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the scratch folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
