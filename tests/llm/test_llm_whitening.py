import collections
import math

import numpy as np
import pytest

from nightjar.llm import queries
from nightjar.llm.embedding_whitening import whiten

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, weights="one", components=16):
    """{vec_id: (deviation, whitened up to sign)}, n, explained."""
    whole = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows]
    count = collections.Counter(x for _, x in whole)
    fit = list(count)
    w = [count[x] if weights == "count" else 1 for x in fit]
    n = sum(w)
    sums = [sum(k * v for k, v in zip(w, col)) for col in zip(*fit)]
    off = {x: [n * v - s for v, s in zip(x, sums)] for x in fit}
    c = np.array([off[x] for x in fit], dtype=float) / n
    cov = (c * np.array(w, dtype=float)[:, None]).T @ c / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    z = {x: np.array(off[x], dtype=float) / n @ vector / np.sqrt(value) for x in fit}
    return {i: (sum(v * v for v in off[x]), z[x]) for i, x in whole}, n, value / np.trace(cov)


def compare(got, rows, **options):
    want, n, explained = plain(rows, **options)
    assert collections.Counter(r.vec_id for r in got) == collections.Counter(i for i, _ in rows)
    signs = None
    for r in got:
        deviation, z = want[r.vec_id]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert np.allclose(r.explained, explained[:len(r.z)], rtol=1e-9) and r.identity_error < 1e-9
        if signs is None and np.abs(z).min() > 1e-3:
            signs = np.sign(z * np.array(r.z))
    for r in got:
        assert np.allclose(np.array(r.z) * signs, want[r.vec_id][1], atol=1e-8)


def vectors(n, d, seed=0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, d)) * np.linspace(1, 3, d) @ r.normal(size=(d, d))).astype(np.float32).tolist()


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_a_plain_version_with_a_hot_vector(spark, weights):
    v = vectors(2500, 5)
    rows = [(i, v[i]) for i in range(2500)] + [(3000 + i, v[7]) for i in range(1500)] + [(5000 + i, v[i % 9]) for i in range(20)]
    got = whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), weights=weights).collect()
    assert len(got[0].z) == 5
    compare(got, rows, weights=weights)


def test_query_equals_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, n, explained = plain(rows)
    got = queries.op12_embedding_whitening(spark, sf).collect()
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    signs = {}
    for r in got:
        z = want[r.vec_id][1][r.component - 1]
        assert r.deviation == want[r.vec_id][0] and r.explained == pytest.approx(explained[r.component - 1])
        signs.setdefault(r.component, set()).add(0 if abs(z) < 1e-6 else round(r.whitened / z, 6))
    assert all(x in ({1}, {-1}, {0, 1}, {0, -1}) for x in signs.values())


def test_odd_rows(spark):
    v = vectors(40, 4, 3)
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 0.0, 0.0, 0.0]),
           (104, [0.0, float("-inf"), 0.0, 0.0]), (105, [1.0, 2.0])]
    good = [(i, x) for i, x in enumerate(v)] + [(None, v[0]), (3, v[3]), (None, v[0])]
    df = spark.createDataFrame(bad + good, SCHEMA).selectExpr("*", "1 AS x", "2 AS n", "'a' AS z", "3 AS dim", "4 AS w")
    got = whiten(df).collect()
    assert all(np.isfinite(r.z).all() for r in got)
    named = [r for r in got if r.vec_id is not None]
    compare(named, [(i, x) for i, x in good if i is not None])
    assert len(got) == len(good)
    assert whiten(df.limit(0)).collect() == []
    alone = whiten(spark.createDataFrame([(1, v[0]), (2, v[0])], SCHEMA)).collect()
    assert [(r.n, int(r.deviation), r.z) for r in alone] == [(1, 0, [])] * 2


def test_large_entries_stay_exact_and_flat_dimensions_have_no_component(spark):
    rows = [(1, [1e6, 0.5, 2.0]), (2, [-1e9, 0.25, 2.0]), (3, [3e15, -4.0, 2.0]), (4, [1e30, 4.0, 2.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    whole = {i: [math.floor(max(-2.0**56, min(2.0**56, 64 * c))) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*whole.values())]
    for r in got:
        assert int(r.deviation) == sum((4 * x - s) ** 2 for x, s in zip(whole[r.vec_id], sums))
        assert len(r.z) == 1 and r.identity_error < 1e-6
