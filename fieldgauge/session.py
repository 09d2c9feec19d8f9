"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for. All can be changed on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Keyed state is kept on local disk with changelog files in the checkpoint, so that
    # the number of keys is not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session, leaving its other settings alone."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "fieldgauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        # Delete the files of a checkpoint once nothing refers to it.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir.

    The library never chooses one: a session without the setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the application ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/fieldgauge/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"
