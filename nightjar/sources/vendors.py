"""Vendor specifications and the canonical telemetry schema.

Each telemetry vendor names its columns differently and signals charging
differently. A ``VendorSpec`` holds what differs; a source adapter maps the
vendor's raw table onto ``TELEMETRY_SCHEMA`` once, so every operator after
that runs as ONE plan over all vendors, with ``vendor`` as the leading key of
every window and group.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("vendor", T.StringType()),
    T.StructField("vin", T.StringType()),
    T.StructField("eventat", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("odometer", T.DoubleType()),
    T.StructField("soc", T.DoubleType()),
    T.StructField("dte", T.DoubleType()),
    T.StructField("charge_flag", T.BooleanType()),
    T.StructField("motion_ok", T.BooleanType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
])

TELEMETRY_COLUMNS = [f.name for f in TELEMETRY_SCHEMA.fields]


@dataclass(frozen=True)
class VendorSpec:
    """What differs between telemetry vendors.

    ``charge_flag`` in the canonical table carries the vendor's own charging
    clue (state, current or flag); ``use_flag``/``use_soc``/``use_dte`` say
    which clauses of ``flag OR soc rise OR range rise`` apply.
    ``charging_days`` restricts the charging scan to that many days before
    ``as_of`` (excluding ``as_of``), whatever the run mode.
    """

    name: str
    has_odometer: bool = True
    packed_position: bool = False
    motion_filter: bool = False
    charging: bool = True
    use_flag: bool = True
    use_soc: bool = True
    use_dte: bool = False
    min_duration: int = 1
    min_points: int = 1
    charging_days: int | None = None
    adapter: Callable[[DataFrame], DataFrame] | None = None


# Fixed values of the vendor table being reproduced: session thresholds
# (minutes, points) and which charging clauses exist per vendor kind.
# v0: state + soc + range, gear filter, (10, 5)
# v1: current + soc, packed 'lat,lon' text, (10, 5), may read only
#     yesterday for charging
# v2: flag + soc + range, (1, 1)
# v3: soc only, (1, 2)
# v4: position only: no odometer, no charging
PROXY_VENDORS: tuple[VendorSpec, ...] = (
    VendorSpec("v0", motion_filter=True, use_flag=True, use_dte=True, min_duration=10, min_points=5),
    VendorSpec("v1", packed_position=True, use_flag=True, use_dte=False, min_duration=10, min_points=5),
    VendorSpec("v2", use_flag=True, use_dte=True, min_duration=1, min_points=1),
    VendorSpec("v3", use_flag=False, use_dte=False, min_duration=1, min_points=2),
    VendorSpec("v4", has_odometer=False, charging=False, use_flag=False, use_soc=False),
)


def spec_column(specs: Sequence[VendorSpec], attr: str, default=None) -> Column:
    """CASE over ``vendor`` yielding ``getattr(spec, attr)`` per vendor.

    The vendor list is configuration (a handful of entries), so this stays a
    literal expression that Catalyst folds into codegen, not a join. Boolean
    attributes become one ``vendor IN (...)`` test.
    """
    values = [getattr(s, attr) for s in specs]
    if all(isinstance(v, bool) for v in values):
        hits = [s.name for s in specs if getattr(s, attr)]
        member = F.coalesce(F.col("vendor").isin(hits), F.lit(False)) if hits else F.lit(False)
        if default is True:   # vendors outside the list take the default
            return member | ~F.coalesce(F.col("vendor").isin([s.name for s in specs]), F.lit(False))
        return member
    expr = None
    for s in specs:
        value = getattr(s, attr)
        cond = F.col("vendor") == F.lit(s.name)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def vendor_priority(specs: Sequence[VendorSpec]) -> Column:
    """Configuration order of the vendor; lower wins when a vin repeats."""
    expr = None
    for i, s in enumerate(specs):
        cond = F.col("vendor") == F.lit(s.name)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(specs)))


# --- partition predicates -------------------------------------------------

def partition_days(as_of: dt.date, lookback: int) -> list[dt.date]:
    """``as_of`` and the ``lookback`` days before it, inclusive."""
    return [as_of - dt.timedelta(days=i) for i in range(lookback + 1)]


def partition_filter(days: Sequence[dt.date]) -> Column:
    """``(year = .. AND month = .. AND day IN (..)) OR ...`` on the string
    partition columns, grouped by month, so the scan prunes directories."""
    by_month: dict[tuple[str, str], list[str]] = {}
    for d in days:
        by_month.setdefault((f"{d.year:04d}", f"{d.month:02d}"), []).append(f"{d.day:02d}")
    clauses = [
        (F.col("year") == y) & (F.col("month") == m) & F.col("day").isin(sorted(ds))
        for (y, m), ds in sorted(by_month.items())
    ]
    if not clauses:
        return F.lit(False)
    return reduce(lambda a, b: a | b, clauses)


def read_telemetry(sources: Sequence[tuple[VendorSpec, DataFrame]]) -> DataFrame:
    """Union the adapted vendor tables into the canonical schema."""
    frames = []
    for spec, raw in sources:
        adapted = spec.adapter(raw) if spec.adapter else raw
        frames.append(adapted.select([F.col(f.name).cast(f.dataType) for f in TELEMETRY_SCHEMA.fields]))
    return reduce(lambda a, b: a.unionByName(b), frames)
