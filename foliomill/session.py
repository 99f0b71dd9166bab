"""Session construction and the shared scratch folder every writing job uses."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cores: int | str = 8, app_name: str = "foliomill", driver_memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.files.maxPartitionBytes", "8m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a folder of its own for the session.
    """
    root = spark.conf.get(CHECKPOINT_DIR_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR_KEY, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_DIR_KEY} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="foliomill-")
    return _LOCAL_ROOTS[app]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """New path under the shared folder; no two calls return the same one."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
