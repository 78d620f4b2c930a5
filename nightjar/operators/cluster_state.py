"""Charging clusters kept from run to run.

The state has three tables: the distinct charging points with the start of
the latest session at each (a point lives as long as that session is in the
history), the edges of the cell graph (``spatial.proximity_edges``) and the
label of every cell, so a forest of stars. From one run to the next

* points that get a session are new or live longer, points whose latest
  session leaves the history go. Cells that gain or lose a point are touched;
* pairs of cells are decided anew only if one of the two is touched, from the
  points around touched cells;
* a component that lost an edge is taken apart: its cells stand for
  themselves again. Every other component is one node, its label. Components
  of the edges between these nodes, those that are new and those inside what
  was taken apart, give the new labels.

So distance tests and component rounds follow the day's changes. The old
tables are copied in one pass: what they are joined with are the day's changes,
written before and so of known size, which Spark broadcasts where they are
small enough.

Defined cases: a run without new sessions only lets points expire; an empty
state is that of no points; sessions that start before the history count for
nothing; repeated sessions change nothing; a session without a position is in
no cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.operators import spatial as sp
from nightjar.operators.lineage import materialize

PLACE = ["vendor", "latitude", "longitude"]
CELL = ["vendor", "cell"]
SCHEMAS = {"points": "vendor STRING, latitude DOUBLE, longitude DOUBLE, last BIGINT, cell BIGINT",
           "edges": "vendor STRING, a_cell BIGINT, b_cell BIGINT",
           "labels": "vendor STRING, cell BIGINT, label BIGINT"}
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Clusters:
    points: DataFrame
    edges: DataFrame
    labels: DataFrame


def _cells(points: DataFrame) -> DataFrame:
    cx, cy = (F.floor(F.col(c) / F.lit(sp.CELL_DEG)) for c in ("latitude", "longitude"))
    return points.withColumn("cell", sp.cell_id(cx, cy))


def _points(sessions: DataFrame, since: int) -> DataFrame:
    placed = sessions.where((F.col("session_start_time") >= since) & F.col("latitude").isNotNull()
                            & F.col("longitude").isNotNull())
    return _cells(placed.groupBy(*PLACE).agg(F.max("session_start_time").alias("last")))


def first_clusters(sessions: DataFrame, since: int, keep: Keep = materialize) -> Clusters:
    """State of all ``sessions`` that start at ``since`` (epoch ms) or later."""
    points = keep(_points(sessions, since), "points")
    edges = keep(sp.proximity_edges(points), "edges")
    comp = sp.connected_components(edges).withColumnRenamed("node", "cell")
    labels = points.select(*CELL).distinct().join(comp, CELL, "left")
    return Clusters(points, edges, keep(labels.select(*CELL, F.coalesce("label", "cell").alias("label")), "labels"))


def next_clusters(old: Clusters, added: DataFrame, since: int, keep: Keep = materialize) -> Clusters:
    """State after the run's ``added`` sessions, with a history from ``since``
    on. ``keep(df, name)`` stores a table of the new state and returns it as
    read back."""
    points, touched = _next_points(old.points, added, since, keep)
    around = _around(points, touched)
    decided = materialize(sp.proximity_edges(around, only=touched), "cluster-decided")
    flagged = old.edges
    for end in ("a_cell", "b_cell"):
        flagged = flagged.join(touched.select("vendor", F.col("cell").alias(end), F.lit(True).alias(f"hot_{end}")),
                               ["vendor", end], "left")
    hot = F.col("hot_a_cell").isNotNull() | F.col("hot_b_cell").isNotNull()
    before = materialize(flagged.where(hot).select(*sp.PAIR_KEYS), "cluster-before")
    edges = keep(flagged.where(~hot).select(*sp.PAIR_KEYS).unionByName(decided), "edges")
    lost = before.join(decided, sp.PAIR_KEYS, "left_anti")
    gained = decided.join(before, sp.PAIR_KEYS, "left_anti")
    return Clusters(points, edges, keep(_next_labels(old.labels, points, edges, touched, lost, gained), "labels"))


def _next_points(old: DataFrame, added: DataFrame, since: int, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """(new points, distinct cells that gained or lost one)."""
    fresh = materialize(_points(added, since), "cluster-fresh")
    met = materialize(old.join(fresh.select(*PLACE), PLACE, "left_semi").select(*PLACE), "cluster-met")
    new = fresh.join(met, PLACE, "left_anti")
    longer = old.join(fresh.select(*PLACE, F.col("last").alias("again")), PLACE, "left")
    longer = longer.select(*PLACE, F.greatest("last", "again").alias("last"), "cell")
    gone = longer.where(F.col("last") < since)
    touched = materialize(new.select(*CELL).unionByName(gone.select(*CELL)).distinct(), "cluster-touched")
    return keep(longer.where(F.col("last") >= since).unionByName(new.select(*longer.columns)), "points"), touched


def _around(points: DataFrame, touched: DataFrame) -> DataFrame:
    """Points of the touched cells and of all cells that 100 m can reach from
    them, whichever of a pair's cells proposes the other."""
    x = F.floor(F.col("cell") / F.lit(sp.Y_SPAN)) - F.lit(sp.X_OFF)
    y = F.col("cell") % F.lit(sp.Y_SPAN) - F.lit(sp.Y_OFF)
    lat = lambda c: c * F.lit(sp.CELL_DEG)
    far = sp.REACH_LAT + 1
    near = (touched.withColumn("x", x).withColumn("y", y)
            .withColumn("reach", sp._lon_reach(lat(F.col("x") - far), lat(F.col("x") + far)))
            .withColumn("dx", F.explode(F.sequence(F.lit(-sp.REACH_LAT), F.lit(sp.REACH_LAT))))
            .withColumn("dy", F.explode(F.sequence(-F.col("reach"), F.col("reach"))))
            .select("vendor", sp.cell_id(F.col("x") + F.col("dx"), F.col("y") + F.col("dy")).alias("cell")).distinct())
    return points.join(materialize(near, "cluster-near"), CELL, "left_semi")


def _next_labels(old: DataFrame, points: DataFrame, edges: DataFrame, touched: DataFrame,
                 lost: DataFrame, gained: DataFrame) -> DataFrame:
    ends = lambda e: (e.select("vendor", F.col("a_cell").alias("cell"))
                      .unionByName(e.select("vendor", F.col("b_cell").alias("cell"))).distinct())
    cut = materialize(old.join(ends(lost), CELL, "left_semi")
                      .select("vendor", "label").distinct(), "cluster-cut")
    loose = materialize(old.join(cut, ["vendor", "label"], "left_semi").select(*CELL), "cluster-loose")

    # An old edge has both ends in one component, so its first end tells.
    inside = edges.join(loose.withColumnRenamed("cell", "a_cell"), ["vendor", "a_cell"], "left_semi")
    links = materialize(inside.select(*sp.PAIR_KEYS).unionByName(gained).distinct(), "cluster-links")
    tops = (old.join(ends(links), CELL, "left_semi")
            .join(cut.withColumn("cut", F.lit(True)), ["vendor", "label"], "left")
            .where("cut IS NULL").select(*CELL, F.col("label").alias("top")))
    tops = materialize(tops, "cluster-tops")
    for end in ("a_cell", "b_cell"):
        links = (links.join(tops.withColumnRenamed("cell", end), ["vendor", end], "left")
                 .withColumn(end, F.coalesce("top", end)).drop("top"))
    comp = sp.connected_components(links)

    alive = materialize(points.join(touched, CELL, "left_semi").select(*CELL).distinct(), "cluster-alive")
    dead = touched.join(alive, CELL, "left_anti")
    top = F.when(F.col("cut").isNull(), F.col("label")).otherwise(F.col("cell"))
    stay = (old.join(dead, CELL, "left_anti")
            .join(cut.withColumn("cut", F.lit(True)), ["vendor", "label"], "left").select(*CELL, top.alias("node")))
    seen = materialize(old.join(touched, CELL, "left_semi").select(*CELL), "cluster-seen")
    come = alive.join(seen, CELL, "left_anti").select(*CELL, F.col("cell").alias("node"))
    return (stay.unionByName(come).join(comp, ["vendor", "node"], "left")
            .select(*CELL, F.coalesce("label", "node").alias("label")))


def clustered_sessions(sessions: DataFrame, labels: DataFrame) -> DataFrame:
    """``spatial.charging_clusters`` of the sessions that the labels are of."""
    named = labels.select(*CELL, F.col("label").alias("cluster"))
    return sp.with_anchors(_cells(sessions).join(named, CELL, "left").drop("cell"))
