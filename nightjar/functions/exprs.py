"""Column expressions: time, rounding, distance, text and links.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000

# Fixed values that must equal the job being reproduced.
EARTH_RADIUS_REPORT_M = 6_371_000.0       # report delta distance
EARTH_RADIUS_CLUSTER_KM = 6371.0088       # clustering metric
CLUSTER_EPS_KM = 0.1                      # 100 m neighbourhood
MOVE_THRESHOLD_M = 100.0                  # "moved" means strictly more than this
LAT_MIN, LAT_MAX = 8.0, 37.0              # accepted bounding box, inclusive
LON_MIN, LON_MAX = 68.0, 98.0
MAPS_LINK_PREFIX = "https://www.google.com/maps?q="
IST_ZONE = "Asia/Kolkata"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -----------------------------------------------------------------

def epoch_ms_from_ntz(ts: str) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ column read as UTC,
    truncating micros. Built from the date and the time of day, which do not
    depend on ``spark.sql.session.timeZone`` (a cast to TIMESTAMP would, by
    an hour across daylight-saving changes)."""
    t = F.col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    millis_of_day = (F.hour(t).cast("long") * MS_PER_HOUR + F.minute(t).cast("long") * 60_000
                     + F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long"))
    return days * MS_PER_DAY + millis_of_day


def utc_hour(eventat) -> Column:
    """UTC hour of day of an epoch-ms long, by integer arithmetic."""
    return F.pmod(F.floor(col_(eventat) / MS_PER_HOUR), F.lit(24))


def utc_date(eventat) -> Column:
    """UTC calendar date of an epoch-ms long, by integer arithmetic."""
    return F.date_add(F.lit("1970-01-01").cast("date"),
                      F.floor(col_(eventat) / MS_PER_DAY).cast("int"))


def ist_date(ts) -> Column:
    """Calendar date in India of a naive UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(IST_ZONE), col_(ts)))


def month_boundaries(start, end) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    2024-01-31 -> 2024-02-01 counts 1 (a boundary count, not whole months).
    """
    s, e = col_(start), col_(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


# --- rounding / text ------------------------------------------------------

def round_half_even(x, decimals: int) -> Column:
    """Scale, round half to even, unscale: the float arithmetic of numpy's
    ``round``; differs from decimal rounding on values such as 12.000025."""
    scale = float(10 ** decimals)
    return F.rint(col_(x) * F.lit(scale)) / F.lit(scale)


CENTROID_TYPE = "decimal(22,10)"


def exact_mean(c) -> Column:
    """Mean over DECIMAL(22,10) values (a coordinate keeps 10 decimals, about
    10 micrometres; finer digits are rounded off): exact sums, so the result does not
    depend on the order rows are summed in (float AVG does, and then so does
    a half-even rounding of an exact tie such as 12.000025)."""
    return F.avg(col_(c).cast(CENTROID_TYPE))


def weighted_mean(c, weight) -> Column:
    """Mean over DECIMAL(22,10) values that stand for ``weight`` rows each,
    from exact sums, rounded half-even to ten decimals, as a double."""
    return units_mean(F.sum(coordinate_units(c) * weight.cast("decimal(12,0)")), F.sum(weight))


def coordinate_units(c) -> Column:
    """A coordinate as a whole number of its tenth decimals."""
    return (col_(c).cast(CENTROID_TYPE) * F.lit(10_000_000_000)).cast("decimal(23,0)")


def units_mean(units, n) -> Column:
    """Mean of ``n`` rows with the sum ``units`` of ``coordinate_units``,
    rounded half-even to ten decimals, as a double."""
    units, n = col_(units), col_(n).cast("decimal(20,0)")
    rest = F.pmod(units, n)
    quotient, twice = ((units - rest) / n).cast("long"), rest * 2
    up = F.when(twice > n, 1).when((twice == n) & (F.pmod(quotient, F.lit(2)) == 1), 1).otherwise(0)
    return (quotient + up).cast("double") / F.lit(1e10)


def decimal_text(x, decimals: int = 5) -> Column:
    """Half-even rounding of a DECIMAL, printed as the double it denotes."""
    return F.bround(col_(x), decimals).cast("double").cast("string")


def coord_text_exact(lat, lon, decimals: int = 5, sep: str = ", ") -> Column:
    return F.concat(decimal_text(lat, decimals), F.lit(sep), decimal_text(lon, decimals))


def coord_text(lat, lon, decimals: int = 5, sep: str = ", ") -> Column:
    """``'lat, lon'`` text with both parts rounded half-even."""
    return F.concat(round_half_even(lat, decimals).cast("string"), F.lit(sep),
                    round_half_even(lon, decimals).cast("string"))


def strip_chars(x, chars: str) -> Column:
    """Remove any of ``chars`` from both ends (Python ``str.strip(chars)``)."""
    return F.btrim(col_(x), F.lit(chars))


def normalize_address(x) -> Column:
    """``str.strip(', ').strip()``: drop commas/blanks, then whitespace, at
    both ends. Used for both the geocode key and the lookup."""
    return F.regexp_replace(strip_chars(x, ", "), r"^\s+|\s+$", "")


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text) -> Column:
    """Decimal text as DOUBLE, else NULL. A bare ``try_cast`` would also take
    a type suffix, as in ``'12.5d'``."""
    return F.when(F.regexp_like(col_(text), F.lit(NUMBER)), F.trim(col_(text)).try_cast("double"))


def _part(text, part: int) -> Column:
    return number(F.try_element_at(F.split(F.trim(col_(text)), ","), F.lit(part)))


def parse_pair(text, part: int) -> Column:
    """Numeric part ``part`` (1-based) of ``'a,b'`` text; NULL if unparsable."""
    return _part(text, part)


def maps_link(text) -> Column:
    """Map link for ``'lat,lng'`` text: '' unless there are exactly two
    numeric parts."""
    t = F.trim(col_(text))
    lat, lng = _part(text, 1), _part(text, 2)
    ok = t.isNotNull() & (t != "") & (F.size(F.split(t, ",")) == 2) & lat.isNotNull() & lng.isNotNull()
    return F.when(ok, F.concat(F.lit(MAPS_LINK_PREFIX), lat.cast("string"), F.lit(","),
                               lng.cast("string"))).otherwise(F.lit(""))


# --- distance -------------------------------------------------------------

def haversine_central_angle(lat1, lon1, lat2, lon2) -> Column:
    """Central angle in radians, ``2 * asin(sqrt(a))``."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dlat = p2 - p1
    dlon = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.asin(F.sqrt(a)) * 2


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_REPORT_M) -> Column:
    """Great-circle metres, ``R * 2 * atan2(sqrt(a), sqrt(1 - a))``."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dlat = p2 - p1
    dlon = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius_m) * (F.atan2(F.sqrt(a), F.sqrt(1 - a)) * 2)


CLUSTER_EPS_RAD = CLUSTER_EPS_KM / EARTH_RADIUS_CLUSTER_KM


def in_bbox(lat, lon) -> Column:
    return col_(lat).between(LAT_MIN, LAT_MAX) & col_(lon).between(LON_MIN, LON_MAX)
