"""Raw vendor tables to the canonical telemetry schema.

A ``RawLayout`` names a vendor's columns, its charging clue and its motion
clause; ``adapt`` turns the raw table into ``TELEMETRY_SCHEMA``. Numbers and
positions may arrive as text. Rows whose position does not parse or lies
outside the bounding box are dropped, as ``positions.valid_positions`` does;
other values that do not parse are NULL. The partition columns are passed on
untouched, so day predicates still prune the raw table's folders.

    sources = [(spec, raw) for spec, raw in ...]
    JobConfig(telemetry=lambda s: read_telemetry(with_layouts(sources)), ...)
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightjar.functions.exprs import in_bbox, number
from nightjar.sources.vendors import VendorSpec

PARTITION_COLUMNS = ("year", "month", "day")


@dataclass(frozen=True)
class Clause:
    """A test of one raw column: ``is`` a text, ``equals`` or ``above`` a number."""

    column: str
    test: str
    value: str | float

    def holds(self, raw: DataFrame) -> Column:
        if self.test == "is":
            cond = F.col(self.column).cast("string") == F.lit(self.value)
        elif self.test == "equals":
            cond = _number(raw, self.column) == F.lit(float(self.value))
        elif self.test == "above":
            cond = _number(raw, self.column) > F.lit(float(self.value))
        else:
            raise ValueError(f"unknown test {self.test!r}")
        return F.coalesce(cond, F.lit(False))


@dataclass(frozen=True)
class RawLayout:
    """Column names of a raw table; None where the vendor has no such column.
    A vendor has ``latitude`` and ``longitude``, or ``location`` ('lat,lon')."""

    vin: str = "vin"
    eventat: str = "eventat"
    latitude: str | None = "latitude"
    longitude: str | None = "longitude"
    location: str | None = None
    odometer: str | None = "odometer"
    soc: str | None = None
    dte: str | None = None
    charging: Clause | None = None
    motion: Clause | None = None

    def columns(self) -> list[str]:
        position = [self.location] if self.location else [self.latitude, self.longitude]
        clauses = [c.column for c in (self.charging, self.motion) if c]
        named = [self.vin, self.eventat, *position, self.odometer, self.soc, self.dte, *clauses, *PARTITION_COLUMNS]
        return [c for c in named if c]


#: The column names, charging clues and motion clause of the
#: five vendor kinds of ``vendors.PROXY_VENDORS``.
RAW_LAYOUTS: dict[str, RawLayout] = {
    "v0": RawLayout(soc="soc", dte="distancetoempty", charging=Clause("state", "is", "CHARGING"),
                    motion=Clause("gearposition", "is", "Neutral")),
    "v1": RawLayout(latitude=None, longitude=None, location="location", soc="batterysoc",
                    charging=Clause("batterycurrent", "above", 0.1)),
    "v2": RawLayout(soc="soc", dte="distancetillempty", charging=Clause("batterycharging", "equals", 1)),
    "v3": RawLayout(soc="soc"),
    "v4": RawLayout(latitude="lat", longitude="lng", odometer=None),
}


def _number(raw: DataFrame, name: str) -> Column:
    if isinstance(raw.select(name).schema[0].dataType, T.NumericType):
        return F.col(name).cast("double")
    return number(F.col(name).cast("string"))


def adapt(raw: DataFrame, vendor: str, layout: RawLayout) -> DataFrame:
    """Canonical telemetry of one vendor's raw table; ValueError if the table
    lacks a column of the layout."""
    have = {c.lower() for c in raw.columns}
    missing = [c for c in layout.columns() if c.lower() not in have]
    if missing:
        raise ValueError(f"telemetry of {vendor} has no column {', '.join(missing)}")
    if layout.location:
        parts = F.split(F.col(layout.location), ",")
        two = F.size(parts) == 2
        lat, lon = (number(F.when(two, F.try_element_at(parts, F.lit(i)))) for i in (1, 2))
    else:
        lat, lon = _number(raw, layout.latitude), _number(raw, layout.longitude)
    value = lambda c: _number(raw, c) if c else F.lit(None).cast("double")
    # As in valid_positions, the generator parses each position once.
    typed = raw.select(
        F.lit(vendor).alias("vendor"), F.col(layout.vin).cast("string").alias("vin"),
        F.col(layout.eventat).try_cast("long").alias("eventat"),
        value(layout.odometer).alias("odometer"), value(layout.soc).alias("soc"), value(layout.dte).alias("dte"),
        (layout.charging.holds(raw) if layout.charging else F.lit(False)).alias("charge_flag"),
        (layout.motion.holds(raw) if layout.motion else F.lit(True)).alias("motion_ok"),
        *PARTITION_COLUMNS, F.inline(F.array(F.struct(lat.alias("latitude"), lon.alias("longitude")))))
    return typed.where(in_bbox("latitude", "longitude"))


def with_layouts(sources: Sequence[tuple[VendorSpec, DataFrame]],
                 layouts: dict[str, RawLayout] = RAW_LAYOUTS) -> list[tuple[VendorSpec, DataFrame]]:
    """The sources with the adapter of each vendor's layout, for
    ``vendors.read_telemetry``."""
    return [(replace(s, adapter=lambda raw, s=s: adapt(raw, s.name, layouts[s.name])), raw) for s, raw in sources]
