import math
import random

import pytest

from nightjar.functions.exprs import CLUSTER_EPS_RAD
from nightjar.operators import spatial as sp

SCHEMA = "vendor string, vin string, session_start_time long, latitude double, longitude double"


def hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    dl = math.radians(b[1]) - math.radians(a[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * math.asin(math.sqrt(h))


def brute_components(points):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    pts = list(points)
    for i in range(len(pts)):
        for j in range(i + 1, len(pts)):
            if pts[i][0] == pts[j][0] and hav(pts[i][1:], pts[j][1:]) <= CLUSTER_EPS_RAD:
                parent[find(pts[i])] = find(pts[j])
    groups = {}
    for p in pts:
        groups.setdefault(find(p), set()).add(p)
    return {frozenset(g) for g in groups.values()}


def spark_components(spark, points, budget):
    df = spark.createDataFrame([(v, "x", i, la, lo) for i, (v, la, lo) in enumerate(points)], SCHEMA)
    lab = sp.cluster_labels(df, pair_budget=budget).collect()
    groups = {}
    for r in lab:
        groups.setdefault((r.vendor, r.cluster), set()).add((r.vendor, r.latitude, r.longitude))
    return {frozenset(g) for g in groups.values()}


def test_chain_of_90m_steps_is_one_cluster(spark):
    step = 0.09 / 111.195  # ~90 m of latitude
    pts = [("v", 12.0 + i * step, 77.0) for i in range(3)]
    assert len(spark_components(spark, pts, 4096)) == 1


def test_points_more_than_100m_apart_stay_apart(spark):
    pts = [("v", 12.0, 77.0), ("v", 12.0 + 0.11 / 111.195, 77.0)]
    assert len(spark_components(spark, pts, 4096)) == 2


def test_vendors_never_merge(spark):
    pts = [("v", 12.0, 77.0), ("w", 12.0, 77.0)]
    assert len(spark_components(spark, pts, 4096)) == 2


@pytest.mark.parametrize("budget", [1, 4096])
def test_components_equal_brute_force(spark, budget):
    rnd = random.Random(3)
    pts = set()
    for _ in range(140):
        c = rnd.choice([(12.0, 77.0), (12.002, 77.001), (30.0, 90.0)])
        pts.add((rnd.choice("vw"), round(c[0] + rnd.uniform(-0.002, 0.002), 6),
                 round(c[1] + rnd.uniform(-0.002, 0.002), 6)))
    assert spark_components(spark, pts, budget) == brute_components(pts)


def test_two_vehicles_bridge_one_place_and_places_rank_by_visits(spark):
    step = 0.08 / 111.195
    rows = [("v", "a", 1, 12.0, 77.0), ("v", "a", 2, 12.0, 77.0), ("v", "b", 3, 12.0 + step, 77.0),
            ("v", "a", 4, 12.0 + 2 * step, 77.0), ("v", "a", 5, 13.0, 77.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    cl = sp.charging_clusters(df).collect()
    a_clusters = {r.cluster for r in cl if r.vin == "a"}
    assert len(a_clusters) == 2
    places = sp.charging_places(sp.charging_clusters(df)).where("vin = 'a'").orderBy("rank").collect()
    assert [(p.visits, p.rank) for p in places] == [(3, 1), (1, 2)]


def test_connected_components_on_path_star_and_cycle(spark):
    edges = [("v", 5, 4), ("v", 4, 3), ("v", 3, 2), ("v", 2, 1),          # path
             ("v", 10, 11), ("v", 10, 12), ("v", 10, 13),                # star
             ("v", 20, 21), ("v", 21, 22), ("v", 22, 20), ("w", 1, 2)]   # cycle, other vendor
    df = spark.createDataFrame(edges, "vendor string, a_cell long, b_cell long")
    got = {(r.vendor, r.node): r.label for r in sp.connected_components(df).collect()}
    want = {("v", n): 1 for n in (1, 2, 3, 4, 5)}
    want.update({("v", n): 10 for n in (10, 11, 12, 13)})
    want.update({("v", n): 20 for n in (20, 21, 22)})
    want.update({("w", 1): 1, ("w", 2): 1})
    assert got == want
