"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes. Sizes (executors, memory, shuffle partitions) stay with the cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A split of a hot join key may cost one more exchange; at scale the straggler costs more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state off the heap, written as changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Checkpointed tables go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "gridpulse", **settings: str) -> SparkSession:
    """Session with the settings above; keyword arguments use ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SESSION_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gridpulse-")
    context.setCheckpointDir(folder)
    return (context.getCheckpointDir() or folder).rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path in the shared folder, for a table or a stream checkpoint."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
