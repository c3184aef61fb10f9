"""Session settings the engine relies on, and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Only what the semantics or the plans need; memory, cores and shuffle width
#: belong to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("staylens")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cores == "*" else int(cores)
    return (
        builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table.

    On a cluster this lies in the shared folder the cluster names in
    ``spark.checkpoint.dir``.  Where that is unset (tests, one machine) a local
    temporary folder is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/staylens/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{tempfile.mkdtemp(prefix='staylens-')}/{name}"
