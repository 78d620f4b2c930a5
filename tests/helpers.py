import datetime as dt

from nightjar.sources.vendors import TELEMETRY_SCHEMA

DAY = dt.date(2024, 1, 10)


def ms(d: dt.date, h: int, m: int = 0, s: int = 0) -> int:
    return int(dt.datetime(d.year, d.month, d.day, h, m, s, tzinfo=dt.timezone.utc).timestamp() * 1000)


def row(vendor, vin, eventat, lat=12.0, lon=77.0, odo=100.0, soc=50.0, dte=80.0, flag=False, motion=True):
    d = dt.datetime.fromtimestamp(eventat / 1000, dt.timezone.utc)
    return (vendor, vin, eventat, lat, lon, odo, soc, dte, flag, motion,
            f"{d.year:04d}", f"{d.month:02d}", f"{d.day:02d}")


def telemetry(spark, rows):
    return spark.createDataFrame(rows, TELEMETRY_SCHEMA)
