"""State as a log of runs in a bucketed table.

A run appends the rows that are new on its day to its own ``run_date``
partition; older partitions are never rewritten. All partitions are bucketed
by vehicle, so whatever groups or joins the state by vehicle reads its buckets
as they lie on disk: the old state has no exchange, in the merge or after it.

A run's partition counts once ``finish`` has marked it. A run reads the
partitions of finished runs before its own date, so a failed run leaves no
trace that anyone reads, and a rerun replaces its own partition; later runs,
which were made from what it replaces, then no longer count, and the next run
scans back to the rerun's date. Rows are never dated after their run, so
retention prunes partitions as well as rows.

The table is external: its files are under ``path``, and the session's catalog
only holds its description, made anew where it is missing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VEHICLE = ("vendor", "vin")


def _folder(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _date(status) -> dt.date:
    return dt.date.fromisoformat(status.getPath().getName())


@dataclass(frozen=True)
class BucketedLog:
    """Rows of ``columns`` (DDL, without the run date), ``buckets`` files a
    run. The bucket count is part of the path, as files of different counts
    cannot be mixed."""

    spark: SparkSession
    root: str
    columns: str
    buckets: int

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/buckets={self.buckets}"

    @property
    def name(self) -> str:
        return "nightjar_state_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def _open(self) -> str:
        fs, folder = _folder(self.spark, f"{self.path}/rows")
        fs.mkdirs(folder)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}, run_date DATE) USING parquet "
                       f"OPTIONS (path '{self.path}/rows', compression 'zstd') PARTITIONED BY (run_date) "
                       f"CLUSTERED BY ({', '.join(VEHICLE)}) SORTED BY ({', '.join(VEHICLE)}) INTO {self.buckets} BUCKETS")
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        self.spark.catalog.refreshTable(self.name)
        return self.name

    def finished(self, before: dt.date) -> list[dt.date]:
        """Dates of the finished runs before a date, in order."""
        fs, folder = _folder(self.spark, f"{self.path}/finished")
        if not fs.exists(folder):
            return []
        return sorted(d for d in map(_date, fs.listStatus(folder)) if d < before)

    def read(self, days: list[dt.date]) -> DataFrame:
        """Rows of the runs of ``days``, with their ``run_date``."""
        rows = self.spark.table(self._open())
        return rows.where(F.col("run_date").isin(days) if days else F.lit(False))

    def forget(self, since: dt.date) -> None:
        """Delete the runs of ``since`` and after."""
        fs, marks = _folder(self.spark, f"{self.path}/finished")
        for mark in fs.listStatus(marks) if fs.exists(marks) else ():
            if _date(mark) >= since:
                fs.delete(mark.getPath(), False)
        fs, rows = _folder(self.spark, f"{self.path}/rows")
        for folder in fs.listStatus(rows) if fs.exists(rows) else ():
            if folder.getPath().getName() >= f"run_date={since}":
                self.spark.sql(f"ALTER TABLE {self._open()} DROP IF EXISTS PARTITION "
                               f"(run_date = DATE'{folder.getPath().getName().removeprefix('run_date=')}')")
                fs.delete(folder.getPath(), True)

    def write(self, as_of: dt.date, *parts: DataFrame) -> None:
        """The run's rows, in place of those of an earlier run of the date.
        Parts that lie in this table's buckets already are written as they
        lie; the caller deals out others with ``dealt``."""
        self.forget(as_of)
        table = self.spark.table(self._open())
        out = None
        for p in parts:
            p = p.withColumn("run_date", F.lit(as_of)).select(*table.columns)
            out = p if out is None else out.unionByName(p)
        out.write.insertInto(self.name)

    def finish(self, as_of: dt.date) -> None:
        fs, mark = _folder(self.spark, f"{self.path}/finished/{as_of}")
        fs.create(mark, True).close()

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.buckets, *VEHICLE)
