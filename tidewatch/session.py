"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# What the operators rely on: adaptive re-planning (partition coalescing, skewed joins), a fixed zone
# for timestamps that carry one, and a sort instead of a collected top-k for pages far down a feed.
# Sizes (shuffle partitions, split bytes) belong to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}

# State of streams on disk instead of in executor memory, as distinct keys grow with the data. It costs
# time on small data, so local sessions do without.
CLUSTER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tidewatch", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` takes further settings with ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = master is not None and master.startswith("local")
    for key, value in (SETTINGS if local else SETTINGS | CLUSTER_SETTINGS).items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    In local mode without that setting, a temporary folder is made once and the setting points to it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tidewatch-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
