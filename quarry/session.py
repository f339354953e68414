"""SparkSession construction with settings that hold from local[8] to a
large cluster.

Cluster deployments pass their own settings (shuffle partitions, checkpoint
directory, memory); ``get_session`` only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied only when the caller/cluster has not set them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts only sides it has measured below this size; every
    # explicit broadcast() in the library is on a side with a proven bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "quarry",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    # Under spark-submit (the JVM started this Python driver) the cluster's
    # master and settings apply; a local master is only a fallback.
    if master or "PYSPARK_GATEWAY_PORT" not in os.environ:
        builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    local = master is not None or "PYSPARK_GATEWAY_PORT" not in os.environ
    if local:
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        # Cluster jobs size shuffle partitions and memory for the data
        # (e.g. a few thousand partitions of ~128-256 MB at 100 TB); these
        # values are for a single-machine run.
        parts = shuffle_partitions or int(os.environ.get("QUARRY_SHUFFLE_PARTITIONS", "8"))
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
        builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in _DEFAULTS.items():
        # Fill in only what the deployment did not set itself.
        if key.startswith("spark.sql.") and not given.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system visible to every executor).  Only in local mode, where driver
    and executors are one process, a fresh scratch folder is registered when
    the setting is absent; a cluster without it is an error.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        registered = sc._jsc.sc().getCheckpointDir()
        current = registered.get() if registered.isDefined() else None
        if current:
            return current
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers (Arrow UDF closures
    reference it).  The package is zipped once per driver process and added
    with ``addPyFile``; Spark copies it to every executor."""
    global _SHIPPED
    sc = spark.sparkContext
    key = id(sc)
    if _SHIPPED == key:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-pkg-"), "quarry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED = key


_SHIPPED = None
