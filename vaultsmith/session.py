"""Spark session settings the loaders are designed around.

On a cluster the session comes from the platform; ``tune`` only sets what a
vault load relies on (AQE, skew-join splitting, UTC). ``local_session`` is
for tests and the benchmark.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime re-planning: AQE coalesces small shuffle partitions, converts a
# join to broadcast only when the *measured* side is under the threshold,
# and splits skewed join partitions (a hot hash key such as the zero key).
# Broadcasts planned from static estimates are off: a stage's size is
# estimated from compressed Parquet bytes, but hashing turns every row into
# several 32-character strings (a 10 MB file became a 192 MB broadcast).
VAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Hash join without sorting when every build-side partition measures small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.bucketing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in VAULT_CONF.items():
        spark.conf.set(k, v)
    return spark


#: A job's shuffle files go when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs started within leave no shuffle files behind: for results that are written and not computed on."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vaultsmith",
                  warehouse: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VAULTSMITH_DRIVER_MEMORY", "8g"))
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for k, v in {**VAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets its own: ``fallback`` if given, else
    ``_checkpoints`` under the warehouse folder. On a cluster a missing setting
    is an error, since Spark's default warehouse may be a machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        fallback = f"{warehouse}/_checkpoints"
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
