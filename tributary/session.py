"""Session helpers: one place for the runtime settings every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Event time is rendered as text (day, hour, window bounds).  The reference used the
# machine zone; we pin one zone so results do not depend on where a task runs.
DEFAULT_TIME_ZONE = "UTC"


def configure(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime SQL settings the operators assume.

    * session time zone (``yyyy-MM-dd`` days, window text, epoch-ms conversions);
    * adaptive execution with skew-join splitting and partition coalescing, so a hot
      visitor / order / sku key is split at run time instead of landing in one task.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", time_zone or DEFAULT_TIME_ZONE)
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Of a field that a JSON record repeats the last one counts, as in the original's parser.
    conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # State that outgrows memory (per-visitor flags, join buffers, window sets) lives in
    # RocksDB on local disk, checkpointed with each micro-batch.
    conf.set("spark.sql.streaming.stateStore.providerClass",
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def get_session(master: str | None = None, app_name: str = "tributary",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``master`` defaults to the cluster's own setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", DEFAULT_TIME_ZONE)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    The session names it in ``spark.checkpoint.dir``; a missing setting is an error, since a
    machine-local folder would not survive losing that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(layers, stream checkpoints and sinks are written there)")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint root (never a machine-local temp dir on a cluster)."""
    return os.path.join(checkpoint_root(spark), *parts)
