"""Session helpers: a configured session for tests and bench, and a shared work folder.

The library never creates a session inside a transformation; callers pass one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "matchlake", **conf: str) -> SparkSession:
    """Session used by tests and bench.  On a cluster the deployment sets these."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment names a folder every executor can reach; it is
    read from the session and used as it is.  Where it is unset, a session on
    a local master gets a fresh folder under the system temp dir; on any other
    master that folder would exist on one machine only, so this raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return configured or current
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    base = configured or tempfile.mkdtemp(prefix="matchlake-ckpt-")
    sc.setCheckpointDir(base)
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for one written dataset of one run.

    It lives under the shared checkpoint folder so that every executor sees it
    and a lost executor's work can be recomputed or re-read.
    """
    base = ensure_checkpoint_dir(spark)
    if "://" not in base and not base.startswith("/"):
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/matchlake/{name}-{uuid.uuid4().hex[:12]}"
