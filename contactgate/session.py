"""Session helpers.

The library never creates a session inside an operator; callers pass one in.
``build_session`` is for scripts, tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def _local_cores(master: str) -> int | None:
    m = re.fullmatch(r"local\[(\d+)\]", master or "")
    return int(m.group(1)) if m else (os.cpu_count() if (master or "").startswith("local") else None)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "contactgate", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE, skew-join handling and measured-size broadcasts only.

    Shuffle partitions: on a local master they default to the core count; on
    a cluster they are left to the cluster configuration (size them so a
    post-shuffle partition is ~100-200 MB at the target scale; AQE coalesces
    and splits from there)."""
    if shuffle_partitions is None and master:
        shuffle_partitions = _local_cores(master)
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only behind a measured size: no static broadcast from file-
        # size estimates; AQE may switch a join to broadcast after the shuffle
        # stage of the small side has run and its real size is known.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local") and driver_memory:
        # local mode runs every task inside the driver JVM; size it for the
        # data when needed.  Only applies when the JVM is not yet up.
        builder = builder.config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names it).  Only
    when it is unset *and* the master is local (tests) is a private scratch
    folder created; on a cluster a machine-local folder would be invisible to
    other executors, so an unset directory is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="contactgate-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), *parts])


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared checkpoint folder for one intermediate table.
    The folder belongs to the job: clear it as a whole when the job is done."""
    return scratch_path(spark, "contactgate", f"{kind}-{uuid.uuid4().hex}")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "checkpoint_dir", "scratch_path", "fresh_path", "local_path"]
