"""Long ranked places -> one wide row per vehicle with three slots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.functions.exprs import coord_text_exact

SLOTS = (1, 2, 3)


def pivot_top3(ranked: DataFrame, prefix: str, include_visits: bool = False,
               keys=("vendor", "vin")) -> DataFrame:
    """``ranked`` has keys, ``rank`` (1..3), ``latitude``, ``longitude`` and,
    with ``include_visits``, ``visits``. Output: keys, ``{prefix}_1..3``
    location texts ('' when the slot is empty) and ``{prefix}_visits_1..3``
    (0 when empty). Conditional aggregation over the fixed slot list is the
    pivot without a pass to discover the pivot values. Centroids arrive as
    exact decimals and are rounded half-even on the decimal value."""
    r = ranked.withColumn("_text", coord_text_exact("latitude", "longitude"))
    aggs = []
    for i in SLOTS:
        hit = F.col("rank") == i
        aggs.append(F.coalesce(F.max(F.when(hit, F.col("_text"))), F.lit("")).alias(f"{prefix}_{i}"))
        if include_visits:
            aggs.append(F.coalesce(F.max(F.when(hit, F.col("visits"))), F.lit(0))
                        .cast("int").alias(f"{prefix}_visits_{i}"))
    return r.groupBy(*keys).agg(*aggs)
