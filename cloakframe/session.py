"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime settings only: sizing (executors, memory, shuffle partitions) belongs to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes. Stages that would exceed it (many masked columns)
    # run as projections split into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app_name: str = "cloakframe", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording a Python call site for every column costs more than building the column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache
def _local_dir() -> str:
    made = tempfile.mkdtemp(prefix="cloakframe-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master, one per process, and removed when that ends; on a cluster
    the setting is required, because executors and a restarted driver must see the same files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
