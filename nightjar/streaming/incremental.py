"""Run the daily job from a file stream of landing telemetry.

The job has no event-time windows to keep open: its state is the day-to-day
night and charging state, merged per run. Structured Streaming is used as
the exactly-once trigger: a file source over the vendor table's folder
tracks which files were processed (in the query checkpoint), and each
micro-batch runs the daily job for the day after the newest data day it
delivered (or the newest version's day, if that is later). The run rescans
every delivered day and the day before the oldest (LAG needs context older
than the batch), so late files and several days in one delivery all reach the
versioned state.
``trigger(availableNow=True)`` processes what has landed and stops, which
fits a scheduled daily run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nightjar.plans.daily import JobConfig, run
from nightjar.sources import io
from nightjar.sources.vendors import TELEMETRY_SCHEMA


def batch_days(batch: DataFrame) -> list[dt.date]:
    """Distinct data days of a micro-batch (a handful of rows)."""
    rows = batch.select("year", "month", "day").distinct().collect()
    return sorted(dt.date(int(r.year), int(r.month), int(r.day)) for r in rows)


def start(spark: SparkSession, source_path: str, checkpoint: str, cfg: JobConfig,
          available_now: bool = True) -> StreamingQuery:
    stream = (spark.readStream.schema(TELEMETRY_SCHEMA)
              .option("basePath", source_path)
              .parquet(source_path))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        days = batch_days(batch)
        if not days:
            return
        as_of = days[-1] + dt.timedelta(days=1)
        newest = io.latest_version(spark, f"{cfg.state_root}/night", dt.date.max)
        run(spark, max(as_of, newest) if newest else as_of, cfg, since=days[0])

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def land_partitioned(telemetry: DataFrame, path: str) -> None:
    """Write canonical telemetry as the vendor table layout
    ``vendor=/year=/month=/day=`` (used by tests and the bench setup)."""
    (telemetry.hint("rebalance", "vendor", "year", "month", "day")
              .write.mode("append").partitionBy("vendor", "year", "month", "day").parquet(path))


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TELEMETRY_SCHEMA).option("basePath", path).parquet(path) \
        .select(*[F.col(f.name) for f in TELEMETRY_SCHEMA.fields])
