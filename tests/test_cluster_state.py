import datetime as dt
import math
import random
import tempfile

import pytest
from helpers import ms, row, telemetry

from nightjar.functions.exprs import MS_PER_DAY
from nightjar.operators import cluster_state as cs
from nightjar.operators import spatial as sp
from nightjar.operators.lineage import release_written, written_mark
from nightjar.plans.daily import JobConfig, add_sessions, kept_clusters, run
from nightjar.sources.vendors import VendorSpec
from test_spatial import brute_components

SCHEMA = "vendor string, vin string, session_start_time long, latitude double, longitude double"
STEP = 0.08 / 111.195   # ~80 m of latitude


def cell(lat, lon):
    # Not //, which differs from the quotient's floor on a cell's border.
    return (math.floor(lat / sp.CELL_DEG) + sp.X_OFF) * sp.Y_SPAN + math.floor(lon / sp.CELL_DEG) + sp.Y_OFF


def brute_labels(sessions, since):
    points = {(v, la, lo) for v, _, t, la, lo in sessions if t >= since}
    out = {}
    for group in brute_components(points):
        label = min(cell(la, lo) for _, la, lo in group)
        out.update({(v, cell(la, lo)): label for v, la, lo in group})
    return out


def labels(state):
    rows = state.labels.collect()
    assert len({(r.vendor, r.cell) for r in rows}) == len(rows)
    return {(r.vendor, r.cell): r.label for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_days_equal_the_clusters_of_all_sessions(spark):
    r, history = random.Random(11), 3
    # Sites of some hundred metres, so chains form, join and fall apart.
    sites = [(12.0, 77.0), (12.02, 77.0), (60.0, 25.0), (-33.9, 18.4)]
    state, seen, split, joined = None, [], 0, 0
    before = {}
    for day in range(8):
        mark = written_mark()
        new = []
        for i in range(0 if day == 5 else r.randrange(6, 12)):
            la, lo = r.choice(sites)
            place = (round(la + r.uniform(-0.0025, 0.0025), 5), round(lo + r.uniform(-0.0025, 0.0025), 5))
            if seen and r.random() < 0.3:
                place = r.choice(seen)[3:]
            new.append((r.choice("vw"), str(i), day * MS_PER_DAY + r.randrange(MS_PER_DAY), *place))
        seen += new
        since = (day - history) * MS_PER_DAY
        added = frame(spark, new)
        state = cs.first_clusters(added, since) if state is None else cs.next_clusters(state, added, since)
        got, want = labels(state), brute_labels(seen, since)
        assert got == want, day
        both = before.keys() & want.keys()
        joined += sum(before[c] != want[c] for c in both)
        split += len({want[c] for c in both}) - len({before[c] for c in both})
        before = want
        state = cs.Clusters(*(spark.createDataFrame(t.collect(), t.schema) for t in (state.points, state.edges, state.labels)))
        release_written(mark)
    assert joined > 2 and split != 0


def test_a_lost_bridge_splits_and_a_new_one_joins(spark):
    chain = [("v", "a", i, 12.0 + i * STEP, 77.0) for i in (10, 11, 12, 13)]
    state = cs.first_clusters(frame(spark, chain), 0)
    assert len(set(labels(state).values())) == 1
    # The second place leaves the history, the others have later sessions.
    later = [(v, "b", t + 10, la, lo) for v, _, t, la, lo in chain if t != 11]
    state = cs.next_clusters(state, frame(spark, later), 15)
    assert labels(state) == brute_labels(chain + later, 15) and len(set(labels(state).values())) == 2
    again = [("v", "c", 30, *chain[1][3:]), ("w", "c", 31, *chain[1][3:])]
    state = cs.next_clusters(state, frame(spark, again), 15)
    assert labels(state) == brute_labels(chain + later + again, 15) and len(set(labels(state).values())) == 2
    # All but one point go, then all.
    state = cs.next_clusters(state, frame(spark, []), 31)
    assert len(labels(state)) == 1
    state = cs.next_clusters(state, frame(spark, []), 32)
    assert labels(state) == {} and state.points.isEmpty() and state.edges.isEmpty()
    state = cs.next_clusters(state, frame(spark, [("v", "d", 40, 12.0, 77.0), ("v", "d", 41, None, None)]), 32)
    assert len(labels(state)) == 1


def test_work_follows_the_day(spark, monkeypatch):
    """With a long history of places, a day's run decides only pairs around its own."""
    old = [("v", str(i), 100, 10.0 + (i // 20) * 0.01 + (i % 2) * STEP, 77.0 + (i % 20) // 2 * 0.01) for i in range(600)]
    state = cs.first_clusters(frame(spark, old), 0)
    wrote, plain = {}, cs.materialize

    def counted(df, tag, after=None):
        out = plain(df, tag, after)
        wrote[tag] = wrote.get(tag, 0) + out.count()
        return out

    monkeypatch.setattr(cs, "materialize", counted)
    monkeypatch.setattr(sp, "materialize", counted)
    day = [("v", "x", 200, 10.0 + 2 * STEP, 77.0), ("v", "y", 200, 50.0, 77.0)]
    state = cs.next_clusters(state, frame(spark, day), 0)
    monkeypatch.undo()
    assert labels(state) == brute_labels(old + day, 0)
    assert max(wrote.values()) <= 80 and wrote["points"] <= 5 and wrote["pairs0"] <= 4, wrote


def config(root, tel, **more):
    return JobConfig(telemetry=tel, specs=(VendorSpec("a", use_dte=False),), state_root=f"{root}/state",
                     master_root=f"{root}/master", report_root=f"{root}/report", state_buckets=4, **more)


def charges(spark, days):
    r, rows = random.Random(5), []
    for d in range(days):
        for v in range(4):
            la, lo = 12.0 + r.randrange(5) * STEP, 77.0 + r.randrange(2)
            for k in range(4):
                rows.append(row("a", str(v), ms(dt.date(2024, 1, 1) + dt.timedelta(days=d), 8, 10 * k), lat=la, lon=lo,
                                odo=100.0, soc=20.0 + 5 * k))
    return telemetry(spark, rows).repartition(2)


def test_job_with_reruns_and_gaps_equals_clusters_of_its_state(spark):
    tel = charges(spark, 9).cache()
    cfg = config(tempfile.mkdtemp(prefix="nightjar-clusters-"), tel, cluster_state=True, history_days=3)
    day = lambda d: dt.date(2024, 1, d)
    for d in (4, 6, 5, 8):   # a gap, an earlier day again, and a gap over the run that this made void
        state = add_sessions(spark, day(d), cfg)
        kept = kept_clusters(spark, day(d), cfg, state)
        got = {str(r) for r in kept.collect()}
        assert got and got == {str(r) for r in sp.charging_clusters(state).select(*kept.columns).collect()}, d


def test_cluster_state_without_a_log_is_refused(spark):
    cfg = config(tempfile.mkdtemp(prefix="nightjar-clusters-"), charges(spark, 1), cluster_state=True, carry_sessions=True)
    with pytest.raises(ValueError, match="open sessions"):
        run(spark, dt.date(2024, 1, 2), cfg)
