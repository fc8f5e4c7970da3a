"""Centroid clustering against plain scans in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from duetto.llm import centroids as cc

VEC = "vec_id long, embedding array<double>, cluster string, inertia int, row int, x string"


def plain(rows, clusters, rounds, dim):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim
            and all(x is not None and math.isfinite(x) for x in v)]
    scaled = [[math.floor(256 * int(x)) if abs(x) > 1e15 else math.floor(256 * x) for x in v] for _, v in kept]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v, k)
                   for k, (i, v) in enumerate(kept) if i is not None)
    now = [scaled[k] for _, _, k in order[:clusters]]
    if not now:
        return []
    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(now)) for x in scaled]
    for _ in range(rounds):
        best = nearest()
        for n in range(len(now)):
            own = [x for x, (_, c) in zip(scaled, best) if c == n]
            if own:
                now[n] = [sum(col) // len(own) for col in zip(*own)]
    best = nearest()
    long = lambda v: v if v < 2 ** 63 else None     # noqa: E731
    sums = [sum(d for d, c in best if c == n) for n in range(len(now))]
    out = [(i, c, long(d), long(sums[c]), long(sum(sums)),
            hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest())
           for (i, _), (d, c) in zip(kept, best)]
    return sorted(out, key=repr)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "c", 1, 2, "x") for i, v in rows], VEC).repartition(3)
    got = cc.cluster_vectors(df, **how)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows_of(scale, seed, dim=4, n=300):
    rng = random.Random(seed)
    rows = [(k, [scale * rng.gauss(0, 1) + 3 * scale * (k % 5) for _ in range(dim)]) for k in range(n)]
    rows += [(1000 + k, [float(k % 2)] * dim) for k in range(40)]               # ties and copies
    rows += [rows[0], (0, [1.0] * dim), (0, [-1.0] * dim), (None, rows[1][1]), (None, rows[2][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (dim - 1)), (2003, [1.0] * (dim + 1)),
             (2004, [None] + [0.0] * (dim - 1)), (2005, [math.nan] + [0.0] * (dim - 1)),
             (2006, [math.inf] + [0.0] * (dim - 1)), (2007, [-0.0] * dim)]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e5, 1e37])
def test_equals_plain_scans(spark, scale):
    rows = rows_of(scale, 3)
    if scale > 1e30:
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows if i != 3]
    want = plain(rows, 6, 3, 4)
    assert run(spark, rows, clusters=6, rounds=3, dim=4) == want
    if scale > 1e30:
        assert any(r[2] is None for r in want)


def test_few_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [9.0, 9.0])]
    assert run(spark, rows, clusters=40, rounds=2, dim=2) == plain(rows, 40, 2, 2)
    assert run(spark, rows[:1], clusters=40, rounds=2, dim=2) == plain(rows[:1], 40, 2, 2)
    assert run(spark, [(None, [1.0, 1.0])], dim=2) == []
    assert run(spark, [(1, None)], dim=2) == []


def test_bounds_loosen_by_less_than_the_drift_and_hold():
    rng = np.random.default_rng(1)
    tighter = 0
    for trial in range(200):
        k, dim = 5, int(rng.integers(2, 6))
        old = rng.normal(size=(k, dim)) * 10
        new = old + rng.normal(size=(k, dim)) * (0.1 if trial % 2 else 5)
        radius = rng.uniform(0, 6, size=k)
        got = cc.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))
        for i in range(k):
            others = [j for j in range(k) if j != i]
            assert got[i] <= drift[others].max() * (1 + 1e-5)
            tighter += got[i] < 0.9 * drift[others].max()
            p = rng.normal(size=(2000, dim))
            p = old[i] + p / np.sqrt((p ** 2).sum(axis=1))[:, None] * radius[i] * rng.uniform(0, 1, 2000)[:, None]
            for j in others:
                shrunk = np.sqrt(((p - old[j]) ** 2).sum(axis=1)) - np.sqrt(((p - new[j]) ** 2).sum(axis=1))
                assert shrunk.max() <= got[i] + 1e-9
    assert tighter > 100


def test_vectors_within_their_bounds_are_not_scanned():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 8)) + 40 * k for k in range(4)]).round() * 16
    points = [[int(v) for v in x[200 * k]] for k in range(4)]
    first = cc.Centroids(points, [0.0] * 4, "float64")
    own, _, low, n = cc.assign(x, np.full(800, -1), np.zeros(800), first)
    assert n == 800
    moved = [[int(v) for v in x[own == c].sum(axis=0) // (own == c).sum()] for c in range(4)]
    reach = np.array([np.sqrt(((x[own == c] - points[c]) ** 2).sum(axis=1)).max() for c in range(4)])
    loosen = cc.loosening(np.array(points, float), np.array(moved, float), reach).tolist()
    again, dist, _, n = cc.assign(x, own, low, cc.Centroids(moved, loosen, "float64"))
    full, want, _, _ = cc.assign(x, np.full(800, -1), np.zeros(800), cc.Centroids(moved, [0.0] * 4, "float64"))
    assert n < 40 and (again == full).all() and (dist == want).all()
