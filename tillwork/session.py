"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for this workload.  On a cluster, put the same keys in
# spark-defaults; executor sizes belong there, not here.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # columnar files are smaller than their rows: without this a large fact
    # side can look small enough to broadcast
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # split a skewed join even where that costs a later shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tillwork", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and work tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    do without: it gets a temporary folder that goes away with the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tillwork-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[app] = folder
        spark.sparkContext.setCheckpointDir(folder)
    return _local_folders[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/work/{label}-{uuid.uuid4().hex}"
