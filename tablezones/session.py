"""Session-level helpers: where scratch output goes.

No master, memory or executor settings are chosen here: that is the job of
``spark-submit`` (or of the test fixture). Scratch data lives under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``). Only a local
session, whose driver and executors are one process, may do without it and
gets a private folder; any other session must name one.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from tablezones.errors import SharedFolderError

_LOCAL_MASTER = re.compile(r"local(\[[^\]]*\])?$")


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; a private one only in local mode."""
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise SharedFolderError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not _LOCAL_MASTER.match(sc.master):
        raise SharedFolderError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tablezones-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused directory name under the shared checkpoint folder.
    Nothing here deletes it: the folder's retention policy does."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tablezones/{label}-{uuid.uuid4().hex[:12]}"
