"""Session construction and shared-storage helpers.

The library never builds its own session inside an operator: every function takes the
caller's DataFrames.  ``build_session`` is for tests, the bench and command-line runs; on a
cluster the session comes from the platform and its settings win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Only for sessions this library builds itself (tests, bench, command line); a caller's session
# keeps its own settings.  Results do not depend on the zone (timestamps are zone-free).
BUILDER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "quayside",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    ``master`` defaults to ``local[N]`` with ``N`` from ``BENCH_CPUS`` or the CPU count.
    """
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or f"local[{cpus}]")
    conf = dict(BUILDER_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("QUAYSIDE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to shared storage and it is only read here; a cluster
    session without it is refused, since a folder of the driver's own would be another one on
    every executor.  A session on a local master (tests, bench) gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quayside-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder for derived files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
