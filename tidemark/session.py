"""Session settings the engine relies on, and where it may put intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", partitions: int = 8, folder: str | None = None, **extra: str) -> SparkSession:
    """A session for tests and benches, with ``folder`` for its intermediate tables; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    options = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "12g",
        **({"spark.checkpoint.dir": folder} if folder else {}),
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver, as in tests, gets a folder of its
    own where the setting is missing; a cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_table(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """Path of a fresh intermediate table in ``folder``, by default the shared one."""
    return f"{(folder or shared_folder(spark)).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
