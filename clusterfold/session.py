"""Spark session and shared-folder helpers.

Every job in this package is a DataFrame program; this module only holds
the session defaults the jobs are tuned for (AQE with skew-join splitting,
UTC timestamps, Arrow for the few pandas steps, no UI server).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int | None = None,
    app_name: str = "clusterfold",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.  The number of
    shuffle partitions and all memory sizes are the caller's (or Spark's)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring it if needed.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system every executor can reach). Only a local-mode session with no
    such setting (tests, laptops) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "checkpoint folder"
            )
        configured = tempfile.mkdtemp(prefix="clusterfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
