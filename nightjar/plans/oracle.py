"""DuckDB SQL for every checked query, over the driver's views.

Written independently of the Spark operators: plain whole-vehicle windows
(LAG, ROW_NUMBER, running SUM), brute-force pair search and a recursive CTE
for connected components. Proxy expressions mirror ``nightjar.sources.proxy``.
"""

from __future__ import annotations

import datetime as dt

from nightjar.plans import fixture as fx
from nightjar.sources.vendors import partition_days

EPS_RAD = "(0.1::DOUBLE / 6371.0088::DOUBLE)"


def r8(c: str) -> str:
    return f"round_even({c} * 100000000.0, 0) / 100000000.0 AS {c}"


def txt(c: str, d: int) -> str:
    s = float(10 ** d)
    return f"CAST(round_even({c} * {s!r}, 0) / {s!r} AS VARCHAR)"


def coord(lat: str, lon: str) -> str:
    return f"{txt(lat, 5)} || ', ' || {txt(lon, 5)}"


def isum(c: str) -> str:
    """Sum of values in units of 1e-10 (the DECIMAL(22,10) of the engine)."""
    return f"sum(CAST(round({c} * 10000000000.0) AS HUGEINT))"


def dround(s: str, n: str, d: int) -> str:
    """Exact half-even rounding of mean s*1e-10/n at d decimals, as DOUBLE."""
    unit = f"(CAST({n} AS HUGEINT) * {10 ** (10 - d)})"
    q, r = f"({s} // {unit})", f"({s} % {unit})"
    return (f"(CAST({q} + CASE WHEN 2 * {r} > {unit} THEN 1 WHEN 2 * {r} = {unit} AND {q} % 2 = 1 THEN 1 ELSE 0 END"
            f" AS DOUBLE) / {float(10 ** d)!r})")


def dcoord(si: str, so: str, n: str) -> str:
    return f"CAST({dround(si, n, 5)} AS VARCHAR) || ', ' || CAST({dround(so, n, 5)} AS VARCHAR)"


DAY = "make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER))"


def pfilter(days) -> str:
    """Consecutive days as a date range."""
    return f"{DAY} BETWEEN DATE '{min(days)}' AND DATE '{max(days)}'"


def window(as_of: dt.date, lookback: int) -> str:
    return pfilter(partition_days(as_of, lookback))


EVENTS = "(SELECT *, epoch_us(ts) // 1000 AS eventat FROM events)"
LAT = ("(8.5::DOUBLE + (((user_id // 10) * 37) % 2800)::DOUBLE / 100.0::DOUBLE"
       " + ((eventat // 86400000) % 3)::DOUBLE * 0.02::DOUBLE + (event_id % 4)::DOUBLE * 0.0002::DOUBLE)")
LON = ("(68.5::DOUBLE + (((user_id // 10) * 53) % 2900)::DOUBLE / 100.0::DOUBLE"
       " + (event_id % 4)::DOUBLE * 0.0001::DOUBLE)")

TEL = f"""tel AS (
  SELECT 'v' || CAST(user_id % 5 AS VARCHAR) AS vendor, CAST(user_id AS VARCHAR) AS vin, eventat,
         {LAT} AS latitude, {LON} AS longitude,
         floor(value / 10) * 0.04::DOUBLE AS odometer, value AS soc,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS dte,
         (event_type = 'purchase' AND user_id % 5 <> 3) AS charge_flag,
         (event_type <> 'error') AS motion_ok,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM {EVENTS} e)"""

ODO_VENDORS = "('v0', 'v1', 'v2', 'v3')"
BBOX = "latitude BETWEEN 8.0 AND 37.0 AND longitude BETWEEN 68.0 AND 98.0"
EDATE = "(DATE '1970-01-01' + CAST(eventat // 86400000 AS INTEGER))"


def night_sql(name: str, as_of: dt.date, lookback: int, stationary: bool = True) -> str:
    """CTEs ``{name}_cand``, ``{name}_stat``, ``{name}`` (night points)."""
    keep = f"vendor NOT IN {ODO_VENDORS} OR abs(odometer - prev_odometer) <= 0.1" if stationary else "TRUE"
    return f"""{name}_cand AS (
  SELECT vendor, vin, eventat, latitude, longitude, odometer FROM tel
  WHERE {window(as_of, lookback)} AND (eventat // 3600000) % 24 <= 6
    AND latitude IS NOT NULL AND longitude IS NOT NULL AND {BBOX}
    AND (vendor NOT IN {ODO_VENDORS} OR odometer IS NOT NULL)
    AND (vendor <> 'v0' OR motion_ok)),
{name}_stat AS (
  SELECT * FROM (
    SELECT *, COALESCE(LAG(odometer) OVER (PARTITION BY vendor, vin ORDER BY eventat), odometer) AS prev_odometer
    FROM {name}_cand) WHERE {keep}),
{name} AS (
  SELECT vendor, vin, eventat, latitude, longitude FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin, {EDATE}
                                 ORDER BY eventat DESC, latitude DESC, longitude DESC) AS rn
    FROM {name}_stat) WHERE rn = 1)"""


def night_state_sql() -> str:
    return night_sql("np", fx.AS_OF, fx.LOOKBACK) + f""",
nstate AS (SELECT * FROM np WHERE {EDATE} >= DATE '{fx.AS_OF - dt.timedelta(days=60)}')"""


CELLS = f"""ncell AS (
  SELECT vendor, vin, {txt('latitude', 3)} || ',' || {txt('longitude', 3)} AS grid_cell,
         count(DISTINCT {EDATE}) AS night_count, {isum('latitude')} AS lat_i, {isum('longitude')} AS lon_i,
         count(*) AS n_pts
  FROM nstate GROUP BY ALL HAVING count(DISTINCT {EDATE}) >= 2),
ncell_top AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin ORDER BY night_count DESC, grid_cell) AS rank
    FROM ncell) WHERE rank <= 3)"""


def sessions_sql(name: str, as_of: dt.date, lookback: int) -> str:
    """Charging rows of a vehicle that follow each other directly have the
    same difference of two row numbers (among all rows, among charging rows)."""
    return f"""{name}_sig AS (
  SELECT t.*,
         coalesce(first_value(soc) OVER before, CASE WHEN place = 1 THEN 0 END) AS prev_soc,
         coalesce(first_value(dte) OVER before, CASE WHEN place = 1 THEN 0 END) AS prev_dte,
         CASE WHEN place = 1 THEN odometer ELSE first_value(odometer) OVER before END AS prev_odometer,
         CAST(coalesce((charge_flag AND vendor <> 'v3') OR soc > prev_soc OR (dte > prev_dte AND vendor NOT IN ('v1', 'v3')),
                       false)
              AND abs(odometer - prev_odometer) <= 0.1 AS INTEGER) AS is_charging_signal
  FROM (SELECT *, row_number() OVER (PARTITION BY vendor, vin ORDER BY eventat) AS place
        FROM tel
        WHERE vendor IN {ODO_VENDORS} AND {window(as_of, lookback)} AND {BBOX}
          AND odometer IS NOT NULL AND (motion_ok OR vendor <> 'v0')) t
  WINDOW before AS (PARTITION BY vendor, vin ORDER BY place ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)),
{name} AS (
  SELECT vendor, vin, min(eventat) AS session_start_time,
         {dround(isum('latitude'), 'count(*)', 10)} AS latitude, {dround(isum('longitude'), 'count(*)', 10)} AS longitude,
         count(*) AS point_count,
         (max(eventat) // 1000 - min(eventat) // 1000) // 60 AS duration_minutes
  FROM (SELECT *, place - row_number() OVER (PARTITION BY vendor, vin ORDER BY place) AS island
        FROM {name}_sig WHERE is_charging_signal = 1)
  GROUP BY vendor, vin, island
  HAVING count(*) >= (CASE vendor WHEN 'v0' THEN 5 WHEN 'v1' THEN 5 WHEN 'v3' THEN 2 ELSE 1 END)
     AND (max(eventat) // 1000 - min(eventat) // 1000) // 60 >= (CASE WHEN vendor IN ('v0', 'v1') THEN 10 ELSE 1 END))"""


def cstate_sql() -> str:
    cutoff = ((fx.AS_OF - dt.date(1970, 1, 1)).days - 60) * 86400000
    return sessions_sql("cs", fx.AS_OF, fx.LOOKBACK) + f""",
cstate AS (SELECT vendor, vin, session_start_time, latitude, longitude FROM cs
           WHERE session_start_time >= {cutoff})"""


def angle(a: str, b: str) -> str:
    return (f"2 * asin(sqrt(pow(sin((radians({b}.latitude) - radians({a}.latitude)) / 2), 2)"
            f" + cos(radians({a}.latitude)) * cos(radians({b}.latitude))"
            f" * pow(sin((radians({b}.longitude) - radians({a}.longitude)) / 2), 2)))")


CELL_ID = ("(CAST(floor(latitude / 6.35e-4) AS BIGINT) + 262144) * 1048576"
           " + (CAST(floor(longitude / 6.35e-4) AS BIGINT) + 524288)")

CLUSTER = f"""pts AS (
  SELECT DISTINCT vendor, latitude, longitude, {CELL_ID} AS cell FROM cstate),
ppairs AS (
  SELECT a.vendor, a.latitude AS alat, a.longitude AS alon, b.latitude AS blat, b.longitude AS blon,
         a.cell AS acell, b.cell AS bcell
  FROM pts a JOIN pts b ON a.vendor = b.vendor
   AND (a.latitude <> b.latitude OR a.longitude <> b.longitude)
  WHERE {angle('a', 'b')} <= {EPS_RAD}),
reach(vendor, slat, slon, dlat, dlon) AS (
  SELECT vendor, latitude, longitude, latitude, longitude FROM pts
  UNION
  SELECT r.vendor, r.slat, r.slon, p.blat, p.blon
  FROM reach r JOIN ppairs p ON r.vendor = p.vendor AND r.dlat = p.alat AND r.dlon = p.alon),
plabel AS (
  SELECT r.vendor, r.slat AS latitude, r.slon AS longitude, min(q.cell) AS cluster
  FROM reach r JOIN pts q ON r.vendor = q.vendor AND r.dlat = q.latitude AND r.dlon = q.longitude
  GROUP BY ALL),
clustered AS (
  SELECT s.*, l.cluster FROM cstate s JOIN plabel l USING (vendor, latitude, longitude)),
anchors AS (
  SELECT vendor, cluster, min({{'s': session_start_time, 'v': vin}}) AS anc, count(*) AS cluster_sessions
  FROM clustered GROUP BY ALL)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def typed_positions_sql() -> str:
    lat_txt = (f"CASE WHEN event_id % 23 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN CAST(50.0::DOUBLE AS VARCHAR)"
               f" ELSE CAST({LAT} AS VARCHAR) END")
    lon_txt = f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST({LON} AS VARCHAR) END"
    return f"""WITH raw AS (
  SELECT 'v' || CAST(user_id % 5 AS VARCHAR) AS vendor, CAST(user_id AS VARCHAR) AS vin, eventat,
         user_id % 5 = 1 AS packed, {lat_txt} AS lat_text, {lon_txt} AS lon_text
  FROM {EVENTS} e),
parsed AS (
  SELECT vendor, vin, eventat,
         CASE WHEN packed THEN (CASE WHEN lon_text IS NULL THEN lat_text ELSE lat_text || ',' || lon_text END) END AS location,
         lat_text, lon_text, packed FROM raw),
typed AS (
  SELECT vendor, vin, eventat, packed, location, lat_text, lon_text,
         CASE WHEN packed THEN TRY_CAST(split_part(location, ',', 1) AS DOUBLE) ELSE TRY_CAST(lat_text AS DOUBLE) END AS latitude,
         CASE WHEN packed THEN TRY_CAST(split_part(location, ',', 2) AS DOUBLE) ELSE TRY_CAST(lon_text AS DOUBLE) END AS longitude
  FROM parsed)
"""


def q_valid_positions() -> str:
    return typed_positions_sql() + f"""SELECT vendor, vin, eventat, latitude, longitude FROM typed
WHERE (NOT packed OR (location IS NOT NULL AND len(string_split(location, ',')) = 2))
  AND latitude IS NOT NULL AND longitude IS NOT NULL AND {BBOX}"""


#: Reasons by elimination, from the rows and not from the valid ones.
REASON = f"""CASE WHEN packed AND location IS NULL OR NOT packed AND (lat_text IS NULL OR lon_text IS NULL) THEN 'no_position'
     WHEN packed AND len(string_split(location, ',')) <> 2 THEN 'not_two_parts'
     WHEN latitude IS NULL OR longitude IS NULL THEN 'not_numeric'
     WHEN {BBOX} THEN 'kept' ELSE 'outside_box' END"""


def q_rejected_positions() -> str:
    return typed_positions_sql() + f"""SELECT vendor, vin, eventat, location, CASE WHEN NOT packed THEN lat_text END AS lat_text,
       CASE WHEN NOT packed THEN lon_text END AS lon_text, {REASON} AS reason
FROM typed WHERE {REASON} <> 'kept'"""


def q_position_counts() -> str:
    return typed_positions_sql() + f"""SELECT reason, count(r) AS rows, count(r) AS held
FROM (VALUES ('kept'), ('no_position'), ('not_two_parts'), ('not_numeric'), ('outside_box')) k(reason)
LEFT JOIN (SELECT {REASON} AS r FROM typed) t ON r = reason GROUP BY reason"""


def q_partition_window() -> str:
    days = partition_days(fx.WINDOW_TRIAL_AS_OF, fx.WINDOW_TRIAL_LOOKBACK)
    return with_(TEL) + f"SELECT vendor, vin, eventat, year, month, day FROM tel WHERE {pfilter(days)}"


def q_stationary_points() -> str:
    return with_(TEL, night_sql("np", fx.AS_OF, fx.LOOKBACK)) + \
        f"SELECT vendor, vin, eventat, latitude, longitude, odometer, prev_odometer FROM np_stat"


def q_night_points() -> str:
    return with_(TEL, night_sql("np", fx.AS_OF, fx.LOOKBACK)) + "SELECT * FROM np"


def q_night_points_simple() -> str:
    return with_(TEL, night_sql("np", fx.AS_OF, fx.LOOKBACK, stationary=False)) + "SELECT * FROM np"


def q_last_night() -> str:
    y = fx.AS_OF - dt.timedelta(days=1)
    return with_(TEL, night_state_sql()) + f"""SELECT vendor, vin, {coord('latitude', 'longitude')} AS last_night_location
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin ORDER BY eventat DESC) AS rn
      FROM nstate WHERE {EDATE} = DATE '{y}') WHERE rn = 1"""


TOP_CELLS = (f"SELECT vendor, vin, grid_cell, night_count, {dround('lat_i', 'n_pts', 8)} AS latitude, "
             f"{dround('lon_i', 'n_pts', 8)} AS longitude, CAST(rank AS INTEGER) AS rank FROM ncell_top")


def q_night_cells() -> str:
    return with_(TEL, night_state_sql(), CELLS) + TOP_CELLS


def merged_nights_sql(name: str, days: int) -> str:
    """Night points of a first run at PREV_AS_OF and the next run, the previous rows winning."""
    return f"""{night_sql("prev", fx.PREV_AS_OF, fx.LOOKBACK)},
{night_sql("new", fx.AS_OF, fx.INCREMENTAL_LOOKBACK)},
{name} AS (SELECT vendor, vin, eventat, latitude, longitude FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin, eventat ORDER BY prio, latitude, longitude) AS rn
  FROM (SELECT *, 0 AS prio FROM prev UNION ALL SELECT *, 1 AS prio FROM new))
WHERE rn = 1 AND {EDATE} >= DATE '{fx.AS_OF - dt.timedelta(days=days)}')"""


def q_night_state_merge() -> str:
    return with_(TEL, merged_nights_sql("merged", fx.RETENTION_TRIAL_DAYS)) + "SELECT * FROM merged"


def q_night_state_log() -> str:
    return with_(TEL, merged_nights_sql("nstate", fx.LOOKBACK)) + "SELECT * FROM nstate"


def q_night_cells_incremental() -> str:
    return with_(TEL, merged_nights_sql("nstate", fx.LOOKBACK), CELLS) + TOP_CELLS


def pivot(src: str, prefix: str, visits: bool) -> str:
    cols = []
    for i in (1, 2, 3):
        cols.append(f"COALESCE(max(CASE WHEN rank = {i} THEN {dcoord('lat_i', 'lon_i', 'n_pts')} END), '') AS {prefix}_{i}")
        if visits:
            cols.append(f"CAST(COALESCE(max(CASE WHEN rank = {i} THEN visits END), 0) AS INTEGER) AS {prefix}_visits_{i}")
    return f"SELECT vendor, vin, {', '.join(cols)} FROM {src} GROUP BY vendor, vin"


def q_pivot_top3() -> str:
    return with_(TEL, night_state_sql(), CELLS) + pivot("ncell_top", "night_location", False)


def q_charging_signal() -> str:
    return with_(TEL, sessions_sql("cs", fx.AS_OF, fx.LOOKBACK)) + \
        "SELECT vendor, vin, eventat, soc, prev_soc, dte, prev_dte, odometer, prev_odometer, is_charging_signal FROM cs_sig"


def q_charging_sessions() -> str:
    return with_(TEL, sessions_sql("cs", fx.AS_OF, fx.LOOKBACK)) + \
        f"SELECT vendor, vin, session_start_time, {r8('latitude')}, {r8('longitude')}, point_count, duration_minutes FROM cs"


def q_charging_state_merge() -> str:
    cutoff = ((fx.AS_OF - dt.date(1970, 1, 1)).days - fx.RETENTION_TRIAL_DAYS) * 86400000
    return with_(TEL, sessions_sql("prev", fx.PREV_AS_OF, fx.LOOKBACK),
                 sessions_sql("new", fx.AS_OF, fx.INCREMENTAL_LOOKBACK)) + f"""SELECT vendor, vin, session_start_time, {r8('latitude')}, {r8('longitude')} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin, session_start_time ORDER BY prio, latitude, longitude) AS rn
  FROM (SELECT vendor, vin, session_start_time, latitude, longitude, 0 AS prio FROM prev
        UNION ALL SELECT vendor, vin, session_start_time, latitude, longitude, 1 AS prio FROM new))
WHERE rn = 1 AND session_start_time >= {cutoff}"""


def q_charging_sessions_carried() -> str:
    return with_(TEL, cstate_sql()) + \
        f"SELECT vendor, vin, session_start_time, {r8('latitude')}, {r8('longitude')} FROM cstate"


def q_proximity_pairs() -> str:
    return with_(TEL, cstate_sql(), CLUSTER) + """SELECT DISTINCT vendor, least(acell, bcell) AS a_cell, greatest(acell, bcell) AS b_cell
FROM ppairs WHERE acell <> bcell"""


CLUSTERED = f"""SELECT c.vendor, c.vin, c.session_start_time, {r8('c.latitude').replace(' AS c.latitude', ' AS latitude')},
       {r8('c.longitude').replace(' AS c.longitude', ' AS longitude')}, c.cluster,
       a.anc.s AS cluster_anchor_start, a.anc.v AS cluster_anchor_vin, a.cluster_sessions
FROM clustered c JOIN anchors a USING (vendor, cluster)"""


def q_charging_clusters() -> str:
    return with_(TEL, cstate_sql(), CLUSTER) + CLUSTERED


def q_charging_clusters_incremental() -> str:
    """All clusters at once, of the sessions that the runs saw, the first run's row winning."""
    days = fx.RETENTION_TRIAL_DAYS
    back = [days] + [(b - a).days for a, b in zip(fx.CLUSTER_RUNS, fx.CLUSTER_RUNS[1:])]
    runs = [sessions_sql(f"run{i}", day, n) for i, (day, n) in enumerate(zip(fx.CLUSTER_RUNS, back))]
    seen = " UNION ALL ".join(f"SELECT vendor, vin, session_start_time, latitude, longitude, {i} AS prio FROM run{i}"
                              for i in range(len(runs)))
    cutoff = ((fx.AS_OF - dt.date(1970, 1, 1)).days - days) * 86400000
    state = f"""cstate AS (SELECT vendor, vin, session_start_time, latitude, longitude FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin, session_start_time ORDER BY prio, latitude, longitude) AS rn
  FROM ({seen})) WHERE rn = 1 AND session_start_time >= {cutoff})"""
    return with_(TEL, *runs, state, CLUSTER) + CLUSTERED


PLACES = f"""places AS (
  SELECT vendor, vin, cluster, {isum('latitude')} AS lat_i, {isum('longitude')} AS lon_i, count(*) AS n_pts,
         count(*) AS visits, min(session_start_time) AS first_visit
  FROM clustered GROUP BY ALL),
places_top AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin ORDER BY visits DESC, first_visit, cluster) AS rank
                 FROM places) WHERE rank <= 3)"""


def q_charging_places() -> str:
    return with_(TEL, cstate_sql(), CLUSTER, PLACES) + \
        f"SELECT vendor, vin, cluster, {dround('lat_i', 'n_pts', 8)} AS latitude, " \
        f"{dround('lon_i', 'n_pts', 8)} AS longitude, visits, first_visit, CAST(rank AS INTEGER) AS rank FROM places_top"


ORACLE: dict[str, str] = {
    "valid_positions": q_valid_positions(),
    "rejected_positions": q_rejected_positions(),
    "position_counts": q_position_counts(),
    "partition_window": q_partition_window(),
    "stationary_points": q_stationary_points(),
    "night_points": q_night_points(),
    "night_points_simple": q_night_points_simple(),
    "last_night": q_last_night(),
    "night_cells": q_night_cells(),
    "night_state_merge": q_night_state_merge(),
    "night_state_log": q_night_state_log(),
    "night_cells_incremental": q_night_cells_incremental(),
    "pivot_top3": q_pivot_top3(),
    "charging_signal": q_charging_signal(),
    "charging_sessions": q_charging_sessions(),
    "charging_state_merge": q_charging_state_merge(),
    "charging_sessions_carried": q_charging_sessions_carried(),
    "proximity_pairs": q_proximity_pairs(),
    "charging_clusters": q_charging_clusters(),
    "charging_clusters_incremental": q_charging_clusters_incremental(),
    "charging_places": q_charging_places(),
}


# --- address side ------------------------------------------------------------

LOAN = """ld AS (
  SELECT 'LD' || o_orderkey AS uuid, o_orderkey AS lms_id, 'VB' || o_orderkey AS vehicle_booking_id,
         'LP' || (o_orderkey % 5) AS loan_provider, 'L' || o_custkey AS loan_reference_id,
         CASE o_orderstatus WHEN 'F' THEN 'DISBURSED' WHEN 'O' THEN 'APPROVED' ELSE 'PENDING' END AS loan_status,
         CASE WHEN o_custkey % 2 = 0 THEN 'INDIVIDUAL' ELSE 'PROPRIETOR' END AS loan_applicant_type,
         o_orderpriority AS assigned_to, CAST(o_orderkey % 3 AS INTEGER) AS co_applicant_added,
         o_totalprice AS on_road_price, o_totalprice * 0.8::DOUBLE AS loan_amount,
         9.0::DOUBLE + CAST(o_orderkey % 7 AS DOUBLE) AS interest_rate,
         CAST(12 * (1 + o_orderkey % 4) AS INTEGER) AS duration_in_months,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS decision_date,
         o_orderdate + to_hours(48) AS loan_start_date, o_orderdate AS dp_date
  FROM orders),
lo AS (SELECT 'R' || o_orderkey AS ref_id FROM orders),
vb AS (
  SELECT 'VB' || l_orderkey AS uuid, 'R' || l_orderkey AS ref_id, 'VD' || l_orderkey AS vehicle_details_uuid,
         'P' || min(l_partkey) AS vehicle_uuid, 'S' || min(l_suppkey) AS dealership_uuid,
         CASE WHEN l_orderkey % 2 = 0 THEN 'DEALER' ELSE 'DIRECT' END AS source, 'KA' || l_orderkey AS vehicle_number
  FROM lineitem GROUP BY l_orderkey),
vd AS (SELECT 'VD' || o_orderkey AS uuid, CAST(o_custkey AS VARCHAR) AS vin FROM orders),
oc AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
cp AS (
  SELECT 'CP' || o_orderkey AS uuid, 'LD' || o_orderkey AS loan_details_id, 'U' || c_custkey AS user_profile_uuid,
         CASE c_custkey % 4 WHEN 1 THEN 'GURANTOR' WHEN 2 THEN 'CO_APPLICANT' ELSE 'APPLICANT' END AS profile_type,
         CASE WHEN c_custkey % 5 <> 0 THEN 1 ELSE 0 END AS is_active,
         CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS is_ntc,
         CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE
           '{"segment": "' || c_mktsegment || '", "displayName": "' || c_name || '", "scheme": "S' || (c_custkey % 4)
           || '", "abbValue": ' || (c_custkey % 90) || '}' END AS details,
         c_acctbal AS monthly_income, CAST(c_custkey % 13 AS INTEGER) AS business_stability,
         CAST(c_custkey % 17 AS INTEGER) AS residence_stability
  FROM oc),
cr AS (
  SELECT 'CP' || o_orderkey AS credit_profile_id,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE '{"score": ' || (600 + o_custkey % 300) || '}' END AS extra,
         o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) AS created_at
  FROM orders),
eu AS (
  SELECT 'U' || c_custkey AS uuid, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         '{"occupation": "' || c_mktsegment || '"}' AS profile_info, 'COMMERCIAL' AS use_case,
         DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS dob
  FROM customer),
lp AS (SELECT 'LP' || r_regionkey AS uuid, 'NBFC ' || r_name AS name FROM region),
veh AS (
  SELECT 'P' || p_partkey AS uuid, p_name AS name, p_brand AS model, 'O' || p_brand AS oem_uuid,
         CASE p_size % 3 WHEN 0 THEN '2W' WHEN 1 THEN '3W' ELSE '4W' END AS vehicle_category_by_wheels,
         p_type AS vehicle_type, p_brand || '-' || p_size AS variant, CAST(p_size % 2 AS INTEGER) AS is_active
  FROM part),
oem AS (SELECT DISTINCT 'O' || p_brand AS uuid, 'OEM ' || p_brand AS name FROM part),
ds AS (SELECT 'S' || s_suppkey AS uuid, s_name AS full_name, 'C' || s_nationkey AS city_uuid FROM supplier),
ct AS (SELECT 'C' || n_nationkey AS uuid, n_name AS name, 'ST' || n_regionkey AS state_uuid FROM nation),
st AS (SELECT 'ST' || r_regionkey AS uuid, r_name AS name FROM region),
dd AS (
  SELECT 'LD' || o_orderkey AS loan_details_uuid, o_orderdate + INTERVAL 10 DAY AS pre_emi_date,
         o_orderdate + INTERVAL 40 DAY AS emi_start_date, o_totalprice * 0.2::DOUBLE AS down_payment,
         o_totalprice * 0.01::DOUBLE AS pre_emi_amount, o_totalprice * 0.05::DOUBLE AS emi_amount,
         'UTR' || o_orderkey AS utr_reference
  FROM orders WHERE o_orderstatus = 'F'),
mp AS (
  SELECT 'LD' || o_orderkey AS loan_details_uuid, 'U' || c_custkey AS user_profile_uuid,
         'CURRENT_RESIDENCE' AS address_type, 'AC' || c_custkey AS address_uuid FROM oc
  UNION ALL
  SELECT 'LD' || o_orderkey, 'U' || c_custkey,
         CASE WHEN c_custkey % 3 = 1 THEN 'OFFICE' ELSE 'PERMANENT_RESIDENCE' END, 'AP' || c_custkey FROM oc
  UNION ALL
  SELECT 'LD' || o_orderkey, 'U' || c_custkey, 'CURRENT_RESIDENCE', 'AX' || c_custkey FROM oc WHERE c_custkey % 10 = 9),
cn AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
addr AS (
  SELECT t.tag || c_custkey AS uuid, t.pre || c_name AS address_line_1, 'Block ' || (c_custkey % 50) AS address_line_2,
         n_name AS city, r_name AS state,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(560000 + c_custkey % 1000 AS VARCHAR) END AS pincode,
         CASE WHEN c_custkey % 2 = 0 THEN 'OWNED' ELSE 'RENTED' END AS house_ownership,
         DATE '2019-01-31' + CAST(c_custkey % 400 AS INTEGER) AS residing_since,
         DATE '2024-01-31' + CAST(c_custkey % 30 AS INTEGER) AS marked_at
  FROM cn, (VALUES ('AC', ''), ('AP', 'Perm '), ('AX', 'Alt ')) t(tag, pre))"""


def role_sql(name: str, ptype: str, atype: str, cols: dict[str, str], stability: str | None = None) -> str:
    sel = ", ".join(f"A.{k} AS {v}" for k, v in cols.items())
    if stability:
        sel += (f", CAST(COALESCE(date_diff('month', A.residing_since, A.marked_at), CP.business_stability)"
                f" AS DOUBLE) AS {stability}")
    return f"""{name} AS (
  SELECT l.lms_id AS lms_id, {sel}
  FROM ld l
  LEFT JOIN cp CP ON l.uuid = CP.loan_details_id AND CP.is_active = 1 AND CP.profile_type = '{ptype}'
  LEFT JOIN mp M ON M.loan_details_uuid = l.uuid AND M.address_type = '{atype}' AND M.user_profile_uuid = CP.user_profile_uuid
  LEFT JOIN addr A ON A.uuid = M.address_uuid)"""


ROLES = ",\n".join([
    role_sql("r_b", "APPLICANT", "OFFICE", {"address_line_1": "bussiness_address_1", "address_line_2": "bussiness_address_2",
                                             "city": "bussiness_address_city", "state": "business_address_state",
                                             "pincode": "business_pincode"}, "business_stability"),
    role_sql("r_p", "APPLICANT", "PERMANENT_RESIDENCE", {"address_line_1": "permanent_address_1",
                                                         "address_line_2": "permanent_address_2",
                                                         "city": "peramanent_address_city",
                                                         "state": "peramanent_address_state", "pincode": "permanant_pincode"}),
    role_sql("r_g", "GURANTOR", "CURRENT_RESIDENCE", {"address_line_1": "gurantor_address_1",
                                                      "address_line_2": "gurantor_address_2", "pincode": "gurantor_pincode"}),
    role_sql("r_c", "CO_APPLICANT", "CURRENT_RESIDENCE", {"address_line_1": "co_app_address_1",
                                                          "address_line_2": "co_app_address_2", "pincode": "co_app_pincode"}),
])


def ist(c: str) -> str:
    return f"CAST(CAST({c} + INTERVAL 330 MINUTE AS DATE) AS VARCHAR)"


PROFILE = f"""profile AS (
  SELECT l.lms_id, o.ref_id AS order_id,
         COALESCE(EU.name, json_extract_string(COALESCE(CP.details, '{{}}'), '$.displayName')) AS customer_name,
         EU.gender, l.assigned_to,
         CASE WHEN CP.is_ntc = 1 THEN 'NTC' ELSE json_extract_string(COALESCE(CR.extra, '{{}}'), '$.score') END AS bureau,
         json_extract_string(COALESCE(CP.details, '{{}}'), '$.abbValue') AS abb_value,
         json_extract_string(COALESCE(CP.details, '{{}}'), '$.abcValue') AS abc_value,
         l.loan_applicant_type AS constitution,
         json_extract_string(COALESCE(CP.details, '{{}}'), '$.scheme') AS scheme,
         json_extract_string(COALESCE(CP.details, '{{}}'), '$.segment') AS customer_segment,
         json_extract_string(COALESCE(EU.profile_info, '{{}}'), '$.occupation') AS occupation,
         EU.use_case AS use_case_1, CP.monthly_income,
         CASE WHEN l.co_applicant_added = 1 THEN 'Available' WHEN l.co_applicant_added <> 0 THEN 'NA'
              ELSE 'Unknown' END AS co_applicant_availability,
         CAST(EU.dob AS VARCHAR) AS dob,
         CAST(COALESCE(date_diff('month', A.residing_since, A.marked_at), CP.residence_stability) AS DOUBLE)
           AS residence_stability,
         r_b.business_stability, b.source, l.loan_reference_id AS loan_no, l.loan_status, LP.name AS nbfc,
         A.house_ownership, A.address_line_1 AS current_address1, A.address_line_2 AS current_address2,
         A.city AS current_city, A.state AS current_state, A.pincode AS curr_pincode,
         r_p.permanent_address_1, r_p.permanent_address_2, r_p.peramanent_address_city,
         r_p.peramanent_address_state, r_p.permanant_pincode,
         r_b.bussiness_address_1, r_b.bussiness_address_2, r_b.bussiness_address_city, r_b.business_address_state,
         r_c.co_app_address_1, r_c.co_app_address_2, r_c.co_app_pincode,
         r_g.gurantor_address_1, r_g.gurantor_address_2, r_g.gurantor_pincode,
         OE.name AS oem_name, V.name AS vehicle_name, V.model AS vehicle_model, V.vehicle_category_by_wheels,
         V.vehicle_type, V.variant AS vehicle_variant, CAST(V.is_active AS DOUBLE) AS vehicle_active_status,
         b.vehicle_number,
         VD.vin, DS.full_name AS dealership_name, l.on_road_price,
         {ist('CR.created_at')} AS soft_check_date, {ist('l.decision_date')} AS loan_approval_date,
         {ist('l.loan_start_date')} AS disbursal_date, {ist('l.dp_date')} AS downpayment_date,
         {ist('DD.pre_emi_date')} AS pre_emi_date, {ist('DD.emi_start_date')} AS emi_start_date,
         DD.down_payment AS downpayment, DD.pre_emi_amount, DD.emi_amount, DD.utr_reference,
         l.loan_amount, l.duration_in_months AS tenure, l.interest_rate AS rate_of_interest,
         CT.name AS dealership_city_name, ST.name AS dealers_state_name
  FROM lo o
  INNER JOIN vb b ON o.ref_id = b.ref_id
  RIGHT JOIN ld l ON l.vehicle_booking_id = b.uuid
  LEFT JOIN vd VD ON VD.uuid = b.vehicle_details_uuid
  LEFT JOIN cp CP ON l.uuid = CP.loan_details_id AND CP.is_active = 1 AND CP.profile_type = 'APPLICANT'
  LEFT JOIN cr CR ON CP.uuid = CR.credit_profile_id
  LEFT JOIN eu EU ON EU.uuid = CP.user_profile_uuid
  LEFT JOIN lp LP ON LP.uuid = l.loan_provider
  LEFT JOIN veh V ON V.uuid = b.vehicle_uuid
  LEFT JOIN oem OE ON OE.uuid = V.oem_uuid
  LEFT JOIN ds DS ON DS.uuid = b.dealership_uuid
  LEFT JOIN dd DD ON l.uuid = DD.loan_details_uuid
  LEFT JOIN ct CT ON CT.uuid = DS.city_uuid
  LEFT JOIN st ST ON CT.state_uuid = ST.uuid
  LEFT JOIN mp M ON M.loan_details_uuid = l.uuid AND M.address_type = 'CURRENT_RESIDENCE'
                AND M.user_profile_uuid = CP.user_profile_uuid
  LEFT JOIN addr A ON A.uuid = M.address_uuid
  LEFT JOIN r_b ON r_b.lms_id = l.lms_id
  LEFT JOIN r_p ON r_p.lms_id = l.lms_id
  LEFT JOIN r_g ON r_g.lms_id = l.lms_id
  LEFT JOIN r_c ON r_c.lms_id = l.lms_id
  WHERE l.loan_status IN ('DISBURSED', 'APPROVED'))"""

PAIRS = """sheet AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'L' || o_custkey END AS loan_no,
         CAST(o_custkey AS VARCHAR) AS chasisno FROM orders),
pairs AS (SELECT loan_no, chasisno AS vin FROM sheet WHERE loan_no IS NOT NULL AND chasisno IS NOT NULL)"""

MASTER = """master AS (
  SELECT CAST(c_custkey AS VARCHAR) AS vin, 'L' || c_custkey AS loan_no,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 8.5::DOUBLE + CAST(c_nationkey % 25 AS DOUBLE) * 1.1::DOUBLE END AS current_lat,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 68.5::DOUBLE + CAST(c_nationkey % 25 AS DOUBLE) * 1.2::DOUBLE END AS current_lng,
         8.51::DOUBLE + CAST(c_nationkey % 25 AS DOUBLE) * 1.1::DOUBLE AS permanent_lat,
         68.51::DOUBLE + CAST(c_nationkey % 25 AS DOUBLE) * 1.2::DOUBLE AS permanent_lng,
         c_custkey AS ingest_seq
  FROM customer WHERE c_custkey % 10 <> 3)"""

INCOMPLETE = "(current_lat IS NULL OR current_lng IS NULL OR permanent_lat IS NULL OR permanent_lng IS NULL)"

WORK = f"""work AS (
  SELECT loan_no, vin FROM master WHERE {INCOMPLETE}
  UNION
  SELECT loan_no, vin FROM pairs p WHERE NOT EXISTS (
    SELECT 1 FROM master m WHERE m.loan_no = p.loan_no AND m.vin = p.vin))"""

COMPOSE = """composed AS (
  SELECT w.loan_no, w.vin,
         COALESCE(p.current_address1, '') || ', ' || COALESCE(p.current_city, '') || ', '
           || COALESCE(p.current_state, '') || ' ' || COALESCE(p.curr_pincode, '') AS current_full_address,
         COALESCE(p.permanent_address_1, '') || ', ' || COALESCE(p.peramanent_address_city, '') || ', '
           || COALESCE(p.peramanent_address_state, '') || ' ' || COALESCE(p.permanant_pincode, '') AS permanent_full_address
  FROM work w LEFT JOIN profile p ON w.loan_no = p.loan_no AND w.vin = p.vin)"""


def norm_addr(x: str) -> str:
    return f"regexp_replace(trim({x}, ', '), '^\\s+|\\s+$', '', 'g')"


GEO = f"""georef AS (
  SELECT DISTINCT {norm_addr("t.pre || c_name || ', ' || n_name || ', ' || r_name || ' ' || CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(560000 + c_custkey % 1000 AS VARCHAR) END")} AS address,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 12.0::DOUBLE + CAST(n_nationkey AS DOUBLE) * 0.5::DOUBLE END AS lat,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 75.0::DOUBLE + CAST(n_nationkey AS DOUBLE) * 0.5::DOUBLE END AS lng
  FROM cn, (VALUES ('AC', ''), ('AP', 'Perm '), ('AX', 'Alt ')) t(tag, pre)),
keys AS (
  SELECT DISTINCT a AS address FROM (
    SELECT {norm_addr('current_full_address')} AS a FROM composed
    UNION ALL SELECT {norm_addr('permanent_full_address')} FROM composed) WHERE a <> ''),
known AS (SELECT address, min({{'lat': lat, 'lng': lng}}) AS c FROM georef
          WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY address),
geo AS (SELECT k.address, n.c.lat AS lat, n.c.lng AS lng FROM keys k LEFT JOIN known n USING (address)),
geocoded AS (
  SELECT c.loan_no, c.vin, g1.lat AS current_lat, g1.lng AS current_lng, g2.lat AS permanent_lat, g2.lng AS permanent_lng
  FROM composed c
  LEFT JOIN geo g1 ON g1.address = {norm_addr('c.current_full_address')}
  LEFT JOIN geo g2 ON g2.address = {norm_addr('c.permanent_full_address')})"""

MERGED = f"""merged AS (
  SELECT vin, loan_no, current_lat, current_lng, permanent_lat, permanent_lng, ingest_seq
  FROM master WHERE NOT {INCOMPLETE}
  UNION ALL
  SELECT vin, loan_no, current_lat, current_lng, permanent_lat, permanent_lng, CAST({fx.BATCH_SEQ} AS BIGINT)
  FROM geocoded)"""

ADDRESS_CTES = (LOAN, ROLES, PROFILE, PAIRS, MASTER, WORK, COMPOSE, GEO, MERGED)

ROLE_TYPES = (("APPLICANT", "OFFICE"), ("APPLICANT", "PERMANENT_RESIDENCE"), ("GURANTOR", "CURRENT_RESIDENCE"),
              ("CO_APPLICANT", "CURRENT_RESIDENCE"))

DEDUP = f"""dedup AS (
  SELECT vin, loan_no, current_lat, current_lng, permanent_lat, permanent_lng, ingest_seq FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY vin ORDER BY ingest_seq, loan_no, current_lat, current_lng,
                                 permanent_lat, permanent_lng) AS rn
    FROM (SELECT * FROM merged UNION ALL
          SELECT vin, loan_no || '-B', current_lat, current_lng, permanent_lat, permanent_lng,
                 ingest_seq + {fx.DUPLICATE_SEQ_OFFSET} FROM merged)) WHERE rn = 1)"""

ORACLE.update({
    "loan_vehicle_pairs": with_(PAIRS) + "SELECT * FROM pairs",
    "loan_role_address": "WITH " + LOAN + ",\n" + ",\n".join(
        role_sql(f"r{i}", p, a, {"address_line_1": "line_1", "address_line_2": "line_2", "city": "city",
                                 "state": "state", "pincode": "pincode"}, "business_stability")
        for i, (p, a) in enumerate(ROLE_TYPES)) + "\n" + " UNION ALL ".join(
        f"SELECT '{p} {a}' AS role, * FROM r{i}" for i, (p, a) in enumerate(ROLE_TYPES)),
    "loan_profile": "WITH " + LOAN + ",\n" + ROLES + ",\n" + PROFILE + "\nSELECT * FROM profile",
    "address_worklist": "WITH " + ",\n".join((PAIRS, MASTER, WORK)) + "\nSELECT * FROM work",
    "address_compose": "WITH " + ",\n".join(ADDRESS_CTES[:7]) + "\nSELECT * FROM composed",
    "geocode_lookup": "WITH " + ",\n".join(ADDRESS_CTES[:8]) + "\nSELECT * FROM geocoded",
    "address_master_merge": "WITH " + ",\n".join(ADDRESS_CTES) + "\nSELECT * FROM merged",
    "master_dedup": "WITH " + ",\n".join(ADDRESS_CTES + (DEDUP,)) + "\nSELECT * FROM dedup",
})


# --- report side ---------------------------------------------------------------

def vehicles_sql(sfx: str, as_of: dt.date) -> list[str]:
    """CTEs ending in ``veh_{sfx}``: per-vin results of a first run."""
    y = as_of - dt.timedelta(days=1)
    ncut = as_of - dt.timedelta(days=60)
    ccut = ((as_of - dt.date(1970, 1, 1)).days - 60) * 86400000
    return [
        night_sql(f"np_{sfx}", as_of, fx.LOOKBACK),
        f"ns_{sfx} AS (SELECT * FROM np_{sfx} WHERE {EDATE} >= DATE '{ncut}')",
        f"""last_{sfx} AS (
  SELECT vendor, vin, {coord('latitude', 'longitude')} AS last_night_location
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vendor, vin ORDER BY eventat DESC) AS rn
        FROM ns_{sfx} WHERE {EDATE} = DATE '{y}') WHERE rn = 1)""",
        CELLS.replace("ncell_top", f"nct_{sfx}").replace("ncell", f"nc_{sfx}").replace("nstate", f"ns_{sfx}"),
        f"nw_{sfx} AS ({pivot(f'nct_{sfx}', 'night_location', False)})",
        sessions_sql(f"cs_{sfx}", as_of, fx.LOOKBACK),
        f"""cst_{sfx} AS (SELECT vendor, vin, session_start_time, latitude, longitude FROM cs_{sfx}
           WHERE session_start_time >= {ccut})""",
        CLUSTER.replace("cstate", f"cst_{sfx}").replace("ppairs", f"pp_{sfx}").replace("reach", f"reach_{sfx}")
               .replace("plabel", f"pl_{sfx}").replace("clustered", f"cl_{sfx}").replace("anchors", f"an_{sfx}")
               .replace("pts", f"pts_{sfx}"),
        PLACES.replace("clustered", f"cl_{sfx}").replace("places_top", f"pt_{sfx}").replace("places", f"pl2_{sfx}"),
        f"cw_{sfx} AS ({pivot(f'pt_{sfx}', 'charging_location', True)})",
        f"""veh_{sfx} AS (
  SELECT vin, vendor, last_night_location, night_location_1, night_location_2, night_location_3,
         charging_location_1, charging_location_visits_1, charging_location_2, charging_location_visits_2,
         charging_location_3, charging_location_visits_3
  FROM (
    SELECT s.vendor, s.vin, l.last_night_location, n.night_location_1, n.night_location_2, n.night_location_3,
           c.charging_location_1, c.charging_location_visits_1, c.charging_location_2, c.charging_location_visits_2,
           c.charging_location_3, c.charging_location_visits_3,
           ROW_NUMBER() OVER (PARTITION BY s.vin ORDER BY s.vendor) AS rn
    FROM (SELECT vendor, vin FROM last_{sfx} UNION SELECT vendor, vin FROM nw_{sfx}
          UNION SELECT vendor, vin FROM cw_{sfx}) s
    LEFT JOIN last_{sfx} l USING (vendor, vin)
    LEFT JOIN nw_{sfx} n USING (vendor, vin)
    LEFT JOIN cw_{sfx} c USING (vendor, vin)) WHERE rn = 1)""",
    ]


MASTER_ONE = """mdedup AS (
  SELECT vin, loan_no, current_lat, current_lng FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY vin ORDER BY ingest_seq, loan_no, current_lat, current_lng,
                                 permanent_lat, permanent_lng) AS rn FROM merged) WHERE rn = 1)"""


def report_sql(sfx: str) -> str:
    return f"""rep_{sfx} AS (
  SELECT m.loan_no, m.vin, COALESCE(v.last_night_location, '') AS last_night_location,
         COALESCE(v.night_location_1, '') AS night_location_1, COALESCE(v.night_location_2, '') AS night_location_2,
         COALESCE(v.night_location_3, '') AS night_location_3,
         COALESCE(CASE WHEN m.current_lat IS NOT NULL AND m.current_lng IS NOT NULL THEN
           '(' || CAST(m.current_lat AS VARCHAR) || ', ' || CAST(m.current_lng AS VARCHAR) || ')' END, '') AS current_address,
         COALESCE(v.charging_location_1, '') AS charging_location_1,
         CAST(COALESCE(v.charging_location_visits_1, 0) AS INTEGER) AS charging_location_visits_1,
         COALESCE(v.charging_location_2, '') AS charging_location_2,
         CAST(COALESCE(v.charging_location_visits_2, 0) AS INTEGER) AS charging_location_visits_2,
         COALESCE(v.charging_location_3, '') AS charging_location_3,
         CAST(COALESCE(v.charging_location_visits_3, 0) AS INTEGER) AS charging_location_visits_3
  FROM mdedup m LEFT JOIN veh_{sfx} v USING (vin))"""


def report_with(*sfx_dates) -> str:
    ctes = [TEL, *ADDRESS_CTES, MASTER_ONE]
    for sfx, d in sfx_dates:
        ctes += vehicles_sql(sfx, d) + [report_sql(sfx)]
    return with_(*ctes)


def part(t: str, i: int) -> str:
    return f"TRY_CAST(trim(split_part(trim({t}), ',', {i})) AS DOUBLE)"


def link(t: str) -> str:
    return (f"CASE WHEN trim({t}) IS NOT NULL AND trim({t}) <> '' AND len(string_split(trim({t}), ',')) = 2"
            f" AND {part(t, 1)} IS NOT NULL AND {part(t, 2)} IS NOT NULL"
            f" THEN 'https://www.google.com/maps?q=' || CAST({part(t, 1)} AS VARCHAR) || ',' || CAST({part(t, 2)} AS VARCHAR)"
            f" ELSE '' END")


def moved(a: str, b: str) -> str:
    la, oa, lb, ob = part(a, 1), part(a, 2), part(b, 1), part(b, 2)
    h = (f"pow(sin((radians({lb}) - radians({la})) / 2), 2) + cos(radians({la})) * cos(radians({lb}))"
         f" * pow(sin((radians({ob}) - radians({oa})) / 2), 2)")
    return (f"COALESCE(COALESCE({a}, '') <> '' AND COALESCE({b}, '') <> '' AND {la} IS NOT NULL AND {oa} IS NOT NULL"
            f" AND {lb} IS NOT NULL AND {ob} IS NOT NULL"
            f" AND 6371000.0 * (2 * atan2(sqrt({h}), sqrt(1 - ({h})))) > 100, FALSE)")


def q_report_delta() -> str:
    slots = lambda p: " OR ".join(moved(f"t.{p}_{i}", f"p.{p}_{i}") for i in (1, 2, 3))
    older = f"(SELECT * FROM rep_b WHERE CAST(vin AS BIGINT) % {fx.DELTA_MASTER_STEP} <> 0)"
    return report_with(("a", fx.AS_OF), ("b", fx.DELTA_AS_OF)) + f"""SELECT
  count(DISTINCT CASE WHEN t.vin IS NOT NULL AND p.vin IS NULL THEN t.vin END) AS new_vehicles,
  count(*) FILTER (WHERE {moved('t.last_night_location', 'p.last_night_location')}) AS updated_last_night,
  count(*) FILTER (WHERE {slots('night_location')}) AS updated_night_locations,
  count(*) FILTER (WHERE COALESCE(t.charging_location_1, '') <> '' AND COALESCE(p.charging_location_1, '') = ''
                   AND t.vin IS NOT NULL) AS newly_charged,
  count(*) FILTER (WHERE {slots('charging_location')}) AS updated_charging_locations
FROM rep_a t FULL OUTER JOIN {older} p ON t.vin = p.vin"""


def q_report_changes() -> str:
    from nightjar.operators.report import REPORT_COLUMNS, VISIT_SLOTS

    older = f"(SELECT * FROM rep_b WHERE CAST(vin AS BIGINT) % {fx.DELTA_MASTER_STEP} <> 0)"
    differ = [f"CASE WHEN t.{c} IS DISTINCT FROM p.{c} THEN '{c}' END" for c in REPORT_COLUMNS]
    sides = [f"CAST({a}.{c} AS {'DOUBLE' if c in VISIT_SLOTS else 'VARCHAR'}) AS {n}_{c}"
             for a, n in (("p", "old"), ("t", "new")) for c in REPORT_COLUMNS if c != "vin"]
    return report_with(("a", fx.AS_OF), ("b", fx.DELTA_AS_OF)) + f"""SELECT coalesce(t.vin, p.vin) AS vin,
  CASE WHEN p.vin IS NULL THEN 'insert' WHEN t.vin IS NULL THEN 'delete' ELSE 'update' END AS change,
  CASE WHEN p.vin IS NULL OR t.vin IS NULL THEN '{",".join(REPORT_COLUMNS)}' ELSE concat_ws(',', {", ".join(differ)}) END AS columns,
  {", ".join(sides)}
FROM rep_a t FULL OUTER JOIN {older} p ON t.vin = p.vin
WHERE concat_ws(',', {", ".join(differ)}) <> ''"""


def q_report_json() -> str:
    cols = ["loan_no", "vin", f"{link('last_night_location')} AS last_night_location"]
    cols += [f"{link(f'night_location_{i}')} AS night_location_{i}" for i in (1, 2, 3)]
    cols += [f"{link(chr(39) * 0 + 'replace(trim(current_address, ' + chr(39) + '()' + chr(39) + '), ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + chr(39) + ')')} AS current_address"]
    for i in (1, 2, 3):
        cols += [f"{link(f'charging_location_{i}')} AS charging_location_{i}", f"charging_location_visits_{i}"]
    return report_with(("a", fx.AS_OF)) + "SELECT " + ", ".join(cols) + " FROM rep_a"


ORACLE.update({
    "vendor_vehicle": with_(TEL, *vehicles_sql("a", fx.AS_OF)) + """SELECT * REPLACE (
  CAST(charging_location_visits_1 AS DOUBLE) AS charging_location_visits_1,
  CAST(charging_location_visits_2 AS DOUBLE) AS charging_location_visits_2,
  CAST(charging_location_visits_3 AS DOUBLE) AS charging_location_visits_3) FROM veh_a""",
    "vehicle_report": report_with(("a", fx.AS_OF)) + "SELECT * FROM rep_a",
    "report_delta": q_report_delta(),
    "report_changes": q_report_changes(),
    "report_json": q_report_json(),
})
