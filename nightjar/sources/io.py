"""Sources and sinks of the daily job: versioned state, master, reports.

Every output of a run goes to its own ``run_date=YYYY-MM-DD`` folder. A run
reads the newest version strictly before its own date and never writes a
path it reads, so a failed run leaves the previous versions intact and a
rerun of the same date simply replaces its own folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NIGHT_STATE_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()), T.StructField("eventat", T.LongType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("vendor", T.StringType())])
CHARGING_STATE_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()), T.StructField("session_start_time", T.LongType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("vendor", T.StringType())])
MASTER_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()), T.StructField("loan_no", T.StringType()),
    T.StructField("current_lat", T.DoubleType()), T.StructField("current_lng", T.DoubleType()),
    T.StructField("permanent_lat", T.DoubleType()), T.StructField("permanent_lng", T.DoubleType()),
    T.StructField("ingest_seq", T.LongType())])
REQUIRED_MASTER_COLUMNS = ("vin", "loan_no", "current_lat", "current_lng")


def version_path(root: str, as_of: dt.date) -> str:
    return f"{root.rstrip('/')}/run_date={as_of.isoformat()}"


def latest_version(spark: SparkSession, root: str, as_of: dt.date) -> dt.date | None:
    """Newest complete ``run_date`` strictly before ``as_of`` under ``root``,
    or None on a first run (no such folder, or no version in it). Lists the
    folders only; a version without ``_SUCCESS`` was not finished and does
    not count. Any other failure to list is raised."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("run_date="):
            day = dt.date.fromisoformat(name.removeprefix("run_date="))
            if day < as_of:
                found.append((day, status.getPath()))
    for day, path in sorted(found, key=lambda x: x[0], reverse=True):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            return day
    return None


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end under ``path``."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def drop_versions(spark: SparkSession, root: str, since: dt.date) -> None:
    """Delete the versions of ``since`` and after."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        if status.getPath().getName() >= f"run_date={since.isoformat()}":
            fs.delete(status.getPath(), True)


def read_version(spark: SparkSession, root: str, as_of: dt.date, schema: T.StructType) -> DataFrame | None:
    v = latest_version(spark, root, as_of)
    if v is None:
        return None
    return spark.read.schema(schema).parquet(version_path(root, v)).select(*schema.names)


def write_version(df: DataFrame, root: str, as_of: dt.date, partition_by: tuple[str, ...] = (),
                  counts: dict[str, int] | None = None, name: str = "") -> DataFrame:
    """Write ``df`` as the version of ``as_of`` and return it read back, so
    later steps start from the written files (short lineage). It is read
    with its own schema, so a version without rows reads as empty. With
    ``counts`` the number of rows is noted there under ``name``, observed
    while they are written."""
    path = version_path(root, as_of)
    seen = Observation()
    rows = df if counts is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))
    w = rows.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if counts is not None:
        counts[name] = seen.get["rows"]
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_positions(judged: DataFrame, root: str, as_of: dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, rejected, counts) of ``positions.judged_positions``: both
    channels are written by one pass over the input, and what it read is
    counted by vendor-independent reason while it is written. ``counts`` has
    (reason, rows), reason ``kept`` for the rows without one."""
    from nightjar.operators.positions import KEPT, REASONS

    path = version_path(root, as_of)
    seen = Observation()
    counted = judged.observe(seen, F.count(F.lit(1)).alias("read"),
                             *[F.count_if(F.col("reason") == r).alias(r) for r in (KEPT, *REASONS)])
    (counted.withColumn("channel", F.when(F.col("reason") == KEPT, "kept").otherwise("rejected"))
            .write.mode("overwrite").partitionBy("channel").parquet(path))
    got = seen.get
    if got["read"] != sum(got[r] for r in (KEPT, *REASONS)):
        raise RuntimeError(f"positions at {path}: {got} do not add up")
    spark = judged.sparkSession
    counts = spark.createDataFrame([(r, got[r]) for r in (KEPT, *REASONS)], "reason string, rows long")
    both = spark.read.schema(T.StructType([*judged.schema.fields, T.StructField("channel", T.StringType())])).parquet(path)
    kept = both.where("channel = 'kept'").select("vendor", "vin", "eventat", "latitude", "longitude")
    return kept, both.where("channel = 'rejected'").drop("channel"), counts


def read_master(spark: SparkSession, path: str) -> DataFrame:
    return checked_master(spark.read.parquet(path), path)


def checked_master(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a master: the required columns must be there, others may be absent."""
    missing = [c for c in REQUIRED_MASTER_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"address master at {path} lacks columns {missing}")
    for f in MASTER_SCHEMA.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select([F.col(f.name).cast(f.dataType) for f in MASTER_SCHEMA.fields])


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """A report CSV (this engine's or an earlier tool's) with the report
    schema: text columns as strings (an empty cell reads as NULL), visit
    counts as integers (unparsable -> NULL)."""
    from nightjar.operators.report import REPORT_COLUMNS, VISIT_SLOTS

    raw = spark.read.option("header", True).schema(
        T.StructType([T.StructField(c, T.StringType()) for c in REPORT_COLUMNS])).csv(path)
    return raw.select(*[(F.col(c).try_cast("int") if c in VISIT_SLOTS else F.col(c)).alias(c)
                        for c in REPORT_COLUMNS])


def write_report_csv(report: DataFrame, path: str) -> None:
    """CSV with header, rows in report order (last night, loan, vin
    descending). The sort is the sink's, range-partitioned, not one task."""
    from nightjar.operators.report import report_order

    report_order(report).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(report: DataFrame, path: str) -> None:
    """One JSON record per vehicle (JSON Lines) with map links."""
    from nightjar.operators.report import report_json, report_order

    report_order(report_json(report)).write.mode("overwrite").json(path)
