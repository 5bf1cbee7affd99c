"""Centroid clustering against plain integers."""

import random
from hashlib import sha256

import numpy as np
import pytest

from clickflow.llm import centroid

INF, NAN = float("inf"), float("nan")


def brute(rows, k, rounds, dims, scale=1024):
    """[(vec_id, cluster, distance, cluster inertia, inertia, centroid)]."""
    kept = [(v, x) for v, x in rows if x is not None and len(x) == dims
            and all(c is not None and np.isfinite(c) for c in x)]
    points = [[int(np.floor(scale * c)) for c in x] for _, x in kept]
    order = sorted(range(len(kept)), key=lambda i: (
        kept[i][0] is None, sha256(f"3:{kept[i][0]}".encode()).hexdigest(), kept[i][1]))
    cents = [points[i] for i in order[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        mine = [nearest(p)[1] for p in points]
        cents = [[sum(col) // mine.count(j) for col in zip(*(p for p, m in zip(points, mine) if m == j))]
                 if j in mine else c for j, c in enumerate(cents)]
    found = [nearest(p) for p in points]
    per = {j: sum(d for d, i in found if i == j) for _, j in found}
    return [(v, j, d, per[j], sum(per.values()), cents[j]) for (v, _), (d, j) in zip(kept, found)]


def got(df, **kw):
    return [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid))
            for r in centroid.centroid_clusters(df, **kw).collect()]


@pytest.mark.parametrize("spread", [0.01, 1.0, 900.0])
def test_equals_plain_integers(spark, spread):
    r = random.Random(2)
    rows = [(i, [round(r.gauss(0, spread), 3) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[i - 400][1]) for i in range(400, 460)]           # equal vectors
    rows += [(0, rows[0][1]), (None, [1.0] * 6), (None, [1.0] * 6), (600, None), (601, []),
             (602, [1.0] * 5), (603, [1.0] * 7), (604, [NAN] * 6), (605, [1.0] * 5 + [INF]),
             (606, [1.0] * 5 + [None])]
    df = spark.createDataFrame([(v, x, "c", 1) for v, x in rows],
                               "vec_id long, embedding array<double>, cluster string, rest int")
    for k in (1, 4, 9):
        want = brute(rows, k, 4, 6)
        assert sorted(got(df.repartition(3), k=k, rounds=4, dims=6, leading=2), key=repr) == sorted(want, key=repr)


def test_ties_and_few_vectors(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    assert sorted(got(df, k=8, dims=2)) == sorted(brute(rows, 8, 10, 2))
    assert got(df.limit(0), k=3, dims=2) == []
    one = spark.createDataFrame([("only", [0.5, -0.25])], "vec_id string, embedding array<double>")
    assert got(one, dims=2) == [("only", 0, 0, 0, 0, [512, -256])]


def test_bound_spares_comparisons():
    r = np.random.default_rng(0)
    centers = r.normal(size=(12, 64)) * 300
    points = np.floor(centers[r.integers(0, 12, 4000)] + r.normal(size=(4000, 64)) * 20).astype(np.int64)
    cents = np.floor(centers).astype(np.int64)
    x = points - points.mean(0)
    _, axes = np.linalg.eigh(x.T @ x)
    rotation = centroid.Rotation(points.mean(0), axes[:, ::-1][:, :8].copy())
    best, dist, compared = centroid.nearest(points, *rotation.of(points), cents, rotation)
    full = ((points[:, None] - cents[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (dist == full.min(1)).all()
    assert compared < 1.5 * len(points)


def test_equally_near_goes_to_the_smaller_number():
    rotation = centroid.Rotation(np.zeros(2), np.eye(2)[:, :1].copy())
    p = np.array([[0, 0], [0, 5]])
    c = np.array([[3, 0], [-3, 0], [0, 3], [3, 0]])
    best, dist, _ = centroid.nearest(p, *rotation.of(p), c, rotation)
    assert best.tolist() == [0, 2] and dist.tolist() == [9, 4]


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroid.centroid_clusters(df, dims=2).collect()
    assert centroid.most(64) ** 2 * 4 * 64 < 1 << 63
