"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Time columns are
# TIMESTAMP_NTZ, so results do not depend on the zone, but UTC keeps any
# zoned value the caller adds unambiguous.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs an extra shuffle (the second
    # of two chained joins reuses the first one's partitioning otherwise)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the package defaults; ``conf`` wins over them.

    Object-store access (``s3a://`` and friends) is configuration only: pass
    the endpoint and credential-provider settings in ``conf``. Nothing here
    hard-codes a location or a credential.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (tests) a
    private folder is created and registered, so ``DataFrame.checkpoint()``
    works too. On a cluster a machine-local folder would be lost with its
    machine, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage "
                "(HDFS, object store) that every executor and the driver can reach")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/ledgerline/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`scratch_path` named; any other path is refused."""
    root = f"{checkpoint_root(spark).rstrip('/')}/ledgerline/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"not a scratch folder: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
