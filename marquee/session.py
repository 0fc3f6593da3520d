"""Session-level helpers: shared scratch space and scale-oriented defaults.

Library code never hard-codes a machine-local folder. Anything that must be
materialised (written tables, checkpoints) lives under the folder the cluster
names in ``spark.checkpoint.dir``. Only a ``local[...]`` session without that
setting (tests, laptops) gets a private folder, created here once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (session conf or SparkContext). When it
    is unset, a local-mode session gets its own folder; a cluster session is
    refused, since a machine-local folder is invisible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the client has no SparkContext
        current = spark.conf.get(_CHECKPOINT_KEY, None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set on this session") from None
        return current
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None) \
        or sc.getConf().get(_CHECKPOINT_KEY, None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder shared by all "
            "executors (HDFS, object store) before running jobs that materialise data")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-before-used path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/marquee-scratch/{label}-{uuid.uuid4().hex}"

