"""Working folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DIR_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session on a local master may leave it unset and gets a fresh temporary
    folder; on a cluster that would be lost with its executor, so it raises.
    """
    root = spark.conf.get(_DIR_SETTING, None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_SETTING} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lustra-")
    context.setCheckpointDir(root)
    spark.conf.set(_DIR_SETTING, root)
    return root


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared root that no other run uses; not created yet."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
