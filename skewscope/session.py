"""Session helpers: sane defaults for local runs and a checkpoint directory.

On a cluster the checkpoint folder must be the shared one named by
``spark.checkpoint.dir``; a temporary folder is only used in local mode
(tests, the driver's smoke checks) and only when the setting is absent.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "skewscope", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    Order: the context's directory, then ``spark.checkpoint.dir`` from the
    session, then (local master only) a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="skewscope-ckpt-"))
    return sc.getCheckpointDir()
