"""Cutting lineage of iterative plans.

Iterative operators (refinement rounds, connected components) write each
round as parquet under the session's ``spark.checkpoint.dir`` and read it
back: one compute pass per round, a short plan for the next round, and files
in the shared folder survive the loss of any executor. ``release_written``
deletes these scratch tables once a job's outputs are stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nightjar.session import ensure_checkpoint_dir

_WRITTEN: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder, deleted by ``release_written``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/nightjar-{tag}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialize(df: DataFrame, tag: str, after: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. With ``after`` (a
    ``written_mark()``) the scratch tables since then, from which ``df`` was
    made, are deleted once it is written."""
    spark: SparkSession = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/nightjar-{tag}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    if after is not None:
        release_written(after)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def written_mark() -> int:
    return len(_WRITTEN)


def release_written(since: int = 0) -> None:
    """Delete the scratch tables written after ``since`` (a
    ``written_mark()``), through the cluster's Hadoop file system so shared
    folders work the same as local ones."""
    while len(_WRITTEN) > since:
        spark, path = _WRITTEN.pop()
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
