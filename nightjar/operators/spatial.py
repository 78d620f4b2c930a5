"""100 m proximity graph, connected components and charging places.

Clustering with radius 100 m and one point per core (every point is a core
point) yields the connected components of the graph "haversine distance
<= 100 m" over the charging places of one vendor, across all its vehicles.

Exact and distributed, without a pair explosion at dense places:

1. Distinct points are snapped to micro-cells of ``CELL_DEG`` degrees. A
   cell's diagonal is under 100 m at any latitude, so all points of a cell
   are connected: cells are the graph nodes (a depot is one or a few nodes).
2. Each cell proposes the cells of its half-neighbourhood within reach of
   100 m (an equi-join on the cell key, at most a few dozen per cell).
3. A candidate pair is decided from the bounding boxes of its points: a
   lower bound of the distance above 100 m rejects it, an upper bound below
   accepts it. Open pairs with few points are decided point by point; open
   pairs of dense cells are split into quadtree children (at most 4 x 4 per
   pair) and decided again, until every pair is decided.
4. Components of the cell graph by alternating large-star / small-star
   rounds (Kiveris et al., "Connected Components in MapReduce and Beyond",
   SoCC 2014), each round written out to cut lineage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightjar.functions.exprs import CLUSTER_EPS_RAD, exact_mean, haversine_central_angle
from nightjar.operators.lineage import materialize

CELL_DEG = 0.000635          # 70.6 m edge: diagonal 99.86 m < 100 m
X_OFF = 1 << 18              # cell index offsets so that ids are non-negative
Y_OFF = 1 << 19
Y_SPAN = 1 << 20
PAIR_BUDGET = 4096           # point comparisons allowed for one open pair
MAX_DEPTH = 40
BOUND_MARGIN = 1e-9          # relative slack of the box bounds
EPS_DEG_LAT = math.degrees(CLUSTER_EPS_RAD)
REACH_LAT = int(math.floor(EPS_DEG_LAT / CELL_DEG)) + 1


def cell_id(cx: Column, cy: Column) -> Column:
    return (cx + F.lit(X_OFF)) * F.lit(Y_SPAN) + (cy + F.lit(Y_OFF))


def snap_points(points: DataFrame) -> DataFrame:
    """Distinct (vendor, latitude, longitude) with cell coordinates."""
    p = points.select("vendor", "latitude", "longitude").distinct()
    p = (p.withColumn("_u", F.col("latitude") / F.lit(CELL_DEG))
          .withColumn("_v", F.col("longitude") / F.lit(CELL_DEG))
          .withColumn("cx", F.floor("_u"))
          .withColumn("cy", F.floor("_v")))
    return p.withColumn("cell", cell_id(F.col("cx"), F.col("cy")))


def _level_keys(p: DataFrame, level: int) -> DataFrame:
    scale = float(2 ** level)   # exact scaling keeps children nested in parents
    return (p.withColumn("sx", F.floor(F.col("_u") * F.lit(scale)))
             .withColumn("sy", F.floor(F.col("_v") * F.lit(scale))))


def _level_stats(p: DataFrame, level: int) -> DataFrame:
    return (_level_keys(p, level)
            .groupBy("vendor", "cell", "sx", "sy")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min("latitude").alias("lat0"), F.max("latitude").alias("lat1"),
                 F.min("longitude").alias("lon0"), F.max("longitude").alias("lon1")))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _lon_reach(lat0: Column, lat1: Column) -> Column:
    """Cells of longitude that 100 m can span at the cell's latitude."""
    phi = F.least(F.greatest(F.abs(lat0), F.abs(lat1)) + F.lit(EPS_DEG_LAT), F.lit(89.0))
    ratio = F.least(F.lit(math.sin(CLUSTER_EPS_RAD / 2)) / F.cos(F.radians(phi)), F.lit(1.0))
    dlon = F.degrees(F.asin(ratio) * 2)
    return (F.floor(dlon / F.lit(CELL_DEG)) + 1).cast("int")


def _status(df: DataFrame) -> DataFrame:
    """'edge', 'none' or 'open' for pairs of boxes a_* and b_*."""
    a0, a1, b0, b1 = F.col("a_lat0"), F.col("a_lat1"), F.col("b_lat0"), F.col("b_lat1")
    c0, c1, d0, d1 = F.col("a_lon0"), F.col("a_lon1"), F.col("b_lon0"), F.col("b_lon1")
    glat = F.greatest(F.lit(0.0), b0 - a1, a0 - b1)
    glon = F.greatest(F.lit(0.0), d0 - c1, c0 - d1)
    slat = F.greatest(a1, b1) - F.least(a0, b0)
    slon = F.greatest(c1, d1) - F.least(c0, d0)
    hi = F.greatest(F.abs(a0), F.abs(a1), F.abs(b0), F.abs(b1))
    straddle = F.least(a0, b0) < F.lit(0.0)
    lo = F.when(straddle & (F.greatest(a1, b1) > 0), F.lit(0.0)).otherwise(
        F.least(F.abs(a0), F.abs(a1), F.abs(b0), F.abs(b1)))

    def angle(dlat, dlon, phi):
        h = (F.pow(F.sin(F.radians(dlat) / 2), 2)
             + F.pow(F.cos(F.radians(phi)), 2) * F.pow(F.sin(F.radians(dlon) / 2), 2))
        return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * 2

    lb = angle(glat, glon, hi)
    ub = angle(slat, slon, lo)
    single = (F.col("a_n") == 1) & (F.col("b_n") == 1)
    exact = haversine_central_angle(a0, c0, b0, d0) <= F.lit(CLUSTER_EPS_RAD)
    status = (F.when(single, F.when(exact, "edge").otherwise("none"))
               .when(ub <= F.lit(CLUSTER_EPS_RAD * (1 - BOUND_MARGIN)), "edge")
               .when(lb > F.lit(CLUSTER_EPS_RAD * (1 + BOUND_MARGIN)), "none")
               .otherwise("open"))
    return df.withColumn("status", status)


PAIR_KEYS = ["vendor", "a_cell", "b_cell"]


def proximity_edges(points: DataFrame | None, pair_budget: int = PAIR_BUDGET,
                    snapped: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Distinct cell pairs (vendor, a_cell, b_cell), a_cell < b_cell in
    (cx, cy) order, that hold two points within 100 m of each other.
    The distinct snapped points are written once; every round reads them.
    With ``only`` (distinct vendor, cell) just the pairs with such a cell."""
    p = snapped if snapped is not None else materialize(snap_points(points), "points")
    cells = _level_stats(p, 0)

    offs = cells.withColumn("reach", _lon_reach(F.col("lat0"), F.col("lat1")))
    offs = (offs.withColumn("dx", F.explode(F.sequence(F.lit(0), F.lit(REACH_LAT))))
                .withColumn("dy", F.explode(F.sequence(-F.col("reach"), F.col("reach"))))
                .where((F.col("dx") > 0) | (F.col("dy") > 0))
                .withColumn("tx", F.col("sx") + F.col("dx"))
                .withColumn("ty", F.col("sy") + F.col("dy")))
    a = _side(offs.drop("reach", "dx", "dy"), "a_")
    b = _side(cells, "b_")
    pairs = (a.join(b, (F.col("a_vendor") == F.col("b_vendor")) & (F.col("a_tx") == F.col("b_sx"))
                    & (F.col("a_ty") == F.col("b_sy")))
              .withColumnRenamed("a_vendor", "vendor").drop("b_vendor", "a_tx", "a_ty"))
    if only is not None:
        for end in ("a_cell", "b_cell"):
            pairs = pairs.join(only.select("vendor", F.col("cell").alias(end), F.lit(True).alias(f"{end}_meant")),
                               ["vendor", end], "left")
        pairs = (pairs.where("a_cell_meant IS NOT NULL OR b_cell_meant IS NOT NULL")
                 .drop("a_cell_meant", "b_cell_meant"))

    found: list[DataFrame] = []
    level = 0
    while True:
        pairs = materialize(_status(pairs), f"pairs{level}")
        sure = pairs.where(F.col("status") == "edge").select(*PAIR_KEYS)
        open_ = pairs.where(F.col("status") == "open")
        if found:
            open_ = open_.join(_union(found).distinct(), PAIR_KEYS, "left_anti")
        small = open_.where(F.col("a_n") * F.col("b_n") <= F.lit(pair_budget))
        big = open_.where(F.col("a_n") * F.col("b_n") > F.lit(pair_budget))
        checked = [sure, _point_check(small, p, level)]
        last = level >= MAX_DEPTH
        if last:
            # Unreachable with distinct double coordinates; decide exactly.
            checked.append(_point_check(big, p, level))
        found.append(materialize(_union(checked).distinct(), f"edges{level}"))
        if last or big.isEmpty():
            break
        big = materialize(big.join(found[-1], PAIR_KEYS, "left_anti")
                             .select(*PAIR_KEYS, "a_sx", "a_sy", "b_sx", "b_sy"), f"open{level}")
        level += 1
        pairs = _refine(big, p, level)
    return _union(found).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _point_check(pairs: DataFrame, p: DataFrame, level: int) -> DataFrame:
    """Exact test of every point pair of bounded open pairs."""
    pk = _level_keys(p, level).select("vendor", "cell", "sx", "sy", "latitude", "longitude")
    pa = _side(pk, "pa_")
    pb = _side(pk, "pb_")
    x = pairs.select(*PAIR_KEYS, "a_sx", "a_sy", "b_sx", "b_sy")
    x = x.join(pa, (F.col("vendor") == F.col("pa_vendor")) & (F.col("a_cell") == F.col("pa_cell"))
               & (F.col("a_sx") == F.col("pa_sx")) & (F.col("a_sy") == F.col("pa_sy")))
    x = x.join(pb, (F.col("vendor") == F.col("pb_vendor")) & (F.col("b_cell") == F.col("pb_cell"))
               & (F.col("b_sx") == F.col("pb_sx")) & (F.col("b_sy") == F.col("pb_sy")))
    hit = haversine_central_angle("pa_latitude", "pa_longitude", "pb_latitude", "pb_longitude") \
        <= F.lit(CLUSTER_EPS_RAD)
    return x.where(hit).select(*PAIR_KEYS).distinct()


def _refine(open_pairs: DataFrame, p: DataFrame, level: int) -> DataFrame:
    """Children of open pairs at ``level``: at most 4 x 4 per pair."""
    st = _level_stats(p.join(open_pairs.select("vendor", F.col("a_cell").alias("cell"))
                             .unionByName(open_pairs.select("vendor", F.col("b_cell").alias("cell")))
                             .distinct(), ["vendor", "cell"], "left_semi"), level)
    st = st.withColumn("px", F.shiftright("sx", 1)).withColumn("py", F.shiftright("sy", 1))
    ca = _side(st, "a_")
    cb = _side(st, "b_")
    o = open_pairs.select("vendor", F.col("a_cell").alias("oa_cell"), F.col("b_cell").alias("ob_cell"),
                          F.col("a_sx").alias("oa_x"), F.col("a_sy").alias("oa_y"),
                          F.col("b_sx").alias("ob_x"), F.col("b_sy").alias("ob_y"))
    o = o.join(ca, (F.col("vendor") == F.col("a_vendor")) & (F.col("oa_cell") == F.col("a_cell"))
               & (F.col("oa_x") == F.col("a_px")) & (F.col("oa_y") == F.col("a_py")))
    o = o.join(cb, (F.col("vendor") == F.col("b_vendor")) & (F.col("ob_cell") == F.col("b_cell"))
               & (F.col("ob_x") == F.col("b_px")) & (F.col("ob_y") == F.col("b_py")))
    return o.drop("oa_cell", "ob_cell", "oa_x", "oa_y", "ob_x", "ob_y", "a_px", "a_py", "b_px", "b_py",
                  "a_vendor", "b_vendor")


def connected_components(edges: DataFrame, keys=("vendor",), src: str = "a_cell",
                         dst: str = "b_cell", max_rounds: int = 200) -> DataFrame:
    """(keys..., node, label) with label = smallest node id of the component,
    for every node that has an edge. Alternates large-star and small-star
    until the edge set is a forest of stars centred on component minima."""
    keys = list(keys)
    e = (edges.where(F.col(src) != F.col(dst))
              .select(*keys, F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
              .distinct())
    e = materialize(e, "cc0")
    # Many graphs (isolated pairs, single depots) already are star forests.
    if not _is_star_forest(e, keys):
        for rnd in range(max_rounds):
            e = materialize(_star_round(e, keys), f"cc{rnd + 1}")
            if _is_star_forest(e, keys):
                break
        else:
            raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    return (e.select(*keys, F.col("b").alias("node"), F.col("a").alias("label"))
             .unionByName(e.select(*keys, F.col("a").alias("node"), F.col("a").alias("label")))
             .distinct())


def _star_round(e: DataFrame, keys: list[str]) -> DataFrame:
    """One large-star step followed by one small-star step on edges a < b."""
    both = e.select(*keys, F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(*keys, F.col("b").alias("u"), F.col("a").alias("v")))
    m = (both.groupBy(*keys, "u").agg(F.min("v").alias("mv"))
             .select(*keys, "u", F.least("u", "mv").alias("m")))
    large = (both.join(m, keys + ["u"]).where(F.col("v") > F.col("u"))
                 .select(*keys, F.col("m").alias("a"), F.col("v").alias("b")).distinct())
    ms = large.groupBy(*keys, "b").agg(F.min("a").alias("m"))
    linked = (large.join(ms, keys + ["b"]).where(F.col("a") != F.col("m"))
                   .select(*keys, F.col("m").alias("a"), F.col("a").alias("b")))
    return linked.unionByName(ms.select(*keys, F.col("m").alias("a"), "b")).distinct()


def _is_star_forest(e: DataFrame, keys: list[str]) -> bool:
    """Converged when every edge (a, b), a < b, hangs a leaf b under a root
    a: no node is both a centre and a leaf, and no leaf has two centres.
    Then every component is one star centred on its smallest node."""
    leaves = e.groupBy(*keys, "b").agg(F.count(F.lit(1)).alias("k"))
    two_centres = leaves.where(F.col("k") > 1).select(*keys, F.col("b").alias("node"))
    chained = (e.select(*keys, F.col("a").alias("node")).distinct()
                .join(leaves.select(*keys, F.col("b").alias("node")), keys + ["node"], "left_semi"))
    return two_centres.unionByName(chained).isEmpty()


def cluster_labels(points: DataFrame, pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """(vendor, latitude, longitude, cluster) for distinct points; cluster is
    the smallest cell id of the point's component."""
    p = materialize(snap_points(points), "points")
    edges = proximity_edges(None, pair_budget, snapped=p)
    comp = connected_components(edges)
    lab = p.select("vendor", "latitude", "longitude", "cell") \
           .join(comp.withColumnRenamed("node", "cell"), ["vendor", "cell"], "left")
    return lab.select("vendor", "latitude", "longitude",
                      F.coalesce(F.col("label"), F.col("cell")).alias("cluster"))


def charging_clusters(sessions: DataFrame, pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Sessions with their cluster id and the cluster's anchor: the member
    with the earliest (session_start_time, vin) over all vehicles."""
    sessions = materialize(sessions.select("vendor", "vin", "session_start_time", "latitude", "longitude"),
                           "sessions")
    labels = cluster_labels(sessions, pair_budget)
    return with_anchors(sessions.join(labels, ["vendor", "latitude", "longitude"], "left"))


def with_anchors(s: DataFrame) -> DataFrame:
    """Labelled sessions with the anchor and size of their cluster."""
    anchor = (s.groupBy("vendor", "cluster")
               .agg(F.min(F.struct("session_start_time", "vin")).alias("_anc"),
                    F.count(F.lit(1)).alias("cluster_sessions")))
    return (s.join(anchor, ["vendor", "cluster"], "left")
             .select("vendor", "vin", "session_start_time", "latitude", "longitude", "cluster",
                     F.col("_anc.session_start_time").alias("cluster_anchor_start"),
                     F.col("_anc.vin").alias("cluster_anchor_vin"),
                     "cluster_sessions"))


def charging_places(clustered: DataFrame, k: int = 3) -> DataFrame:
    """Per vehicle and cluster: centroid and visit count; top ``k`` per
    vehicle by visits, ties by the earliest visit."""
    places = (clustered.groupBy("vendor", "vin", "cluster")
                       .agg(exact_mean("latitude").alias("latitude"),
                            exact_mean("longitude").alias("longitude"),
                            F.count(F.lit(1)).alias("visits"),
                            F.min("session_start_time").alias("first_visit")))
    w = Window.partitionBy("vendor", "vin").orderBy(F.col("visits").desc(), F.col("first_visit"),
                                                    F.col("cluster"))
    return places.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
