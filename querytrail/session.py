"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  The master is never fixed here: it comes
# from spark-submit / the cluster manager, or from the caller's builder.
DEFAULT_CONF: dict[str, str] = {
    # Zone-less time text and window display are read in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Applied only when a new SparkContext starts (ignored on a running one).
STARTUP_CONF: dict[str, str] = {
    # Remove reliable checkpoint files once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set the run-time settings of ``conf``; static ones, which a running
    session cannot change, are left as they are."""
    for key, value in conf.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def build_session(app: str = "querytrail", conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied.

    ``conf`` entries win over the defaults.  Settings that can only be
    given at JVM start are ignored by Spark if a session already exists.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**STARTUP_CONF, **DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark, {**DEFAULT_CONF, **(conf or {})})
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory, registered with the SparkContext so
    ``DataFrame.checkpoint()`` writes there.

    Where the setting is missing, a fresh temporary folder is taken in local
    mode only: on a cluster the executors would each write to a disk of
    their own, so that is an error.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="querytrail-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh directory under the cluster's shared ``spark.checkpoint.dir``.

    On a cluster that setting names storage every executor can reach, so
    stream checkpoints and stand-in topics written there survive the loss
    of an executor.  Only when it is unset (local tests) a temporary
    directory is created and registered as the checkpoint dir.
    """
    base = ensure_checkpoint_dir(spark)
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],)) if parts else uuid.uuid4().hex
    return os.path.join(base.rstrip("/"), "querytrail", leaf)
