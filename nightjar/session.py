"""SparkSession helpers shared by tests, bench and the daily job."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine wants; the cluster may override the
# sizing ones (shuffle partitions, max partition bytes) through spark-submit.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Day partitions such as '01' must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "nightjar", extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    # Local mode runs every task inside the driver JVM; only honoured when
    # this call starts the JVM.
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; if it is unset there, this raises rather than fall back to a folder
    that only one machine sees. Only in local mode (tests, local runs) an
    unset directory is replaced by a fresh scratch folder.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this job")
    path = tempfile.mkdtemp(prefix="nightjar-ckpt-", dir=os.environ.get("NIGHTJAR_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path
