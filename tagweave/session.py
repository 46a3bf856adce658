"""Session construction and the shared storage folder.

Every table this package writes (tag tables, wide tables, bitmap tables,
exports, models) lives under one root folder.  On a cluster that root is the
shared folder named by ``spark.checkpoint.dir``; it is read from the session.
Only a local-mode session without that setting (tests, laptops) gets a fresh
temporary folder, and it is then registered as the checkpoint dir too.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults of a session that this package starts itself.  A running session,
# and anything the submitter configured, stays as it is.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "tagweave",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName(app_name)
    if active is None:
        submitted = SparkConf()  # what spark-submit and spark-defaults.conf say stays
        if master:
            builder = builder.master(master)
        for key, value in LOCAL_CONF.items():
            if not submitted.contains(key):
                builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def storage_root(spark: SparkSession) -> str:
    """Shared folder for written tables: ``spark.checkpoint.dir`` of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster job needs a shared folder "
                "for its tables and checkpoints")
        root = tempfile.mkdtemp(prefix="tagweave-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder name of the storage root; the writer creates the folder."""
    return f"{storage_root(spark)}/tagweave/{name}-{uuid.uuid4().hex[:12]}"
