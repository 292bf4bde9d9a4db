"""Session settings the jobs rely on."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarks; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("firmament")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FIRMAMENT_DRIVER_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session of one machine that sets none (tests, local runs) gets a local folder, once per session; elsewhere
    the setting is required, since an executor's own disk is not seen by the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    current = spark.conf.get("firmament.local.folder", None)
    if not current:
        current = tempfile.mkdtemp(prefix="firmament-")
        spark.conf.set("firmament.local.folder", current)
    return current


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, for what a job writes and reads again."""
    return f"{shared_folder(spark)}/firmament-{name}-{uuid.uuid4().hex}"
