"""Centroid clustering of integer vectors, with bounds that loosen by geometry.

Every vector keeps its cluster and a lower bound on its distance to all other
centroids.  When centroids move, the vectors of a cluster lie in a sphere about
its old centroid.  Take the midpoint of another centroid's move: by the triangle
inequality, no point seen from there at an angle of ``a`` to the move comes nearer
than by ``drift * cos(a)``, and not at all beyond a right angle.  The least such
angle over the sphere is a matter of the plane through the move and the sphere's
centre.  So the bound of a cluster loosens by the largest of these amounts, mostly
much less than the largest drift.  A vector whose exact distance to its own moved
centroid stays below its bound keeps its cluster; all others are scanned exactly.

Distances, sums and centroids are whole numbers, computed exactly: in floating
point or 64 bits as long as the largest component proves that nothing is lost, and
in Python's integers beyond.  The vectors are laid out once by row number and stay
there; a round shuffles the small state alone.  Each task returns one row of exact
sums for each cluster; the centroids are the only thing that the driver computes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut
from duetto.session import cut_lineage

SCALE = 256
DIM = 64                # components of a vector that takes part
CLUSTERS, ROUNDS = 40, 5
ROWS_PER_PARTITION = 100_000
#: Largest components for exact sums of 64 squares in floating point, and in 64 bits.
FLOAT_EXACT, LONG_EXACT = 1 << 22, 1 << 27
_SLACK = 1e-6           # relative, for bounds in floating point
_LONG = (1 << 63) - 1

_STATE = ("row bigint, vec_id bigint, cluster int, low double, distance bigint, n bigint, "
          "sums array<string>, reach double, inertia string")


class Centroids(NamedTuple):
    """What a round's tasks know: centroids, by how much the lower bounds of each
    cluster's vectors loosen, and the type that keeps numbers exact."""
    points: list[list[int]]
    loosen: list[float]
    kind: str               # float64, int64 or object


def usable(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """``vec_id, x array<double>`` of the vectors with ``dim`` components, none of
    them null or non-finite, before they are scaled."""
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.filter(F.size("embedding") == dim)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
            .filter(~bad))


def whole(x: np.ndarray, kind: str) -> np.ndarray:
    """floor(256 * component): exact, since scaling by 256 only moves the exponent."""
    if kind != "object":
        return np.floor(x * SCALE).astype(kind)
    out = np.empty(x.shape, dtype=object)
    out.ravel()[:] = [math.floor(v) * SCALE if abs(v) >= 1e300 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    return out


def _floats(points: list[list[int]]) -> np.ndarray:
    """Integers as floats; infinite ones make a bound of NaN, which proves nothing."""
    def one(v: int) -> float:
        try:
            return float(v)
        except OverflowError:
            return math.inf
    return np.array([[one(v) for v in p] for p in points], dtype=float)


def _root(squares: np.ndarray, up: bool) -> np.ndarray:
    """Square roots as floats, rounded to the safe side."""
    if squares.dtype != object:
        return np.sqrt(squares.astype(float)) * (1 + _SLACK if up else 1 - _SLACK)
    out = []
    for v in squares.tolist():
        try:
            out.append(float(math.isqrt(v)) * (1 + _SLACK) + 1 if up else float(math.isqrt(v)) * (1 - _SLACK))
        except OverflowError:
            out.append(math.inf if up else 0.0)
    return np.array(out, dtype=float)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much the distance of any point of each sphere (``old[i]``,
    ``radius[i]``) to any other centroid can have shrunk by its move."""
    move = new - old
    drift = np.sqrt((move ** 2).sum(axis=1))
    out = np.zeros(len(old))
    for i in range(len(old)):
        seen = old[i] - (old + new) / 2                     # the sphere's centre from each midpoint
        far = np.sqrt((seen ** 2).sum(axis=1))
        with np.errstate(all="ignore"):
            angle = np.arccos(np.clip((seen * move).sum(axis=1) / (far * drift), -1.0, 1.0))
            half = np.arcsin(np.minimum(radius[i] / far, 1.0))
        outside = (far > radius[i]) & (drift > 0)
        least = np.where(outside, np.clip(angle - half, 0.0, np.pi / 2), 0.0)
        amount = drift * (np.cos(least) + _SLACK)
        amount[i] = 0.0
        out[i] = amount.max()
    return out


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c``."""
    return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)


def assign(x: np.ndarray, own: np.ndarray, low: np.ndarray, model: Centroids
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New clusters, exact squared distances, lower bounds on the distance to the
    other centroids, and how many vectors were scanned.  ``own`` is -1 for vectors
    that have no cluster yet; equal distances go to the smaller number."""
    c = np.array(model.points, dtype=model.kind).reshape(len(model.points), -1)
    at = _floats(model.points)
    known = own >= 0
    mine = np.where(known, own, 0)
    diff = x - c[mine]
    dist = (diff * diff).sum(axis=1)
    # No other centroid is nearer than half the way to the nearest of them.
    with np.errstate(all="ignore"):
        gaps = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(axis=2))
        gaps[np.arange(len(c)), np.arange(len(c))] = np.inf
        half = gaps.min(axis=1) / 2 * (1 - _SLACK)
        low = low - np.array(model.loosen)[mine]
        safe = known & (_root(dist, True) < np.fmax(low, half[mine]))
    todo = np.flatnonzero(~safe)
    cluster = mine.astype(np.int32)
    if len(todo):
        d = squares(x[todo], c)
        best = d.argmin(axis=1)
        rows = np.arange(len(todo))
        dist[todo], cluster[todo] = d[rows, best], best
        if len(c) > 1:
            others = np.where(np.arange(len(c))[None, :] == best[:, None], d.max(axis=1)[:, None], d)
            low[todo] = _root(others.min(axis=1), False)
        else:
            low[todo] = np.inf
    return cluster, dist, low, len(todo)


def _long(v: int) -> int | None:
    return int(v) if abs(v) <= _LONG else None


def _round(laid: DataFrame, state: DataFrame | None, model: Centroids, sums: bool = True) -> DataFrame:
    """One assignment of all vectors: a row of ``_STATE`` for each vector, and one
    without ``row`` for each partition and cluster that has a vector there."""
    shared = laid.sparkSession.sparkContext.broadcast(tuple(model))
    dim, first = len(model.points[0]), state is None
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("cluster", pa.int32()), ("low", pa.float64()),
                        ("distance", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())),
                        ("reach", pa.float64()), ("inertia", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Centroids(*shared.value)
        k = len(m.points)
        total = [[0] * dim for _ in range(k)]
        count, reach, inertia = [0] * k, [0.0] * k, [0] * k
        for b in batches:
            if not b.num_rows:
                continue
            x = whole(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), m.kind)
            if first:
                own, low = np.full(len(x), -1), np.zeros(len(x))
            else:
                own, low = b.column("cluster").to_numpy(), b.column("low").to_numpy()
            cluster, dist, low, _ = assign(x, own, low, m)
            far = _root(dist, True)
            for c in np.unique(cluster).tolist():
                at = cluster == c
                count[c] += int(at.sum())
                reach[c] = max(reach[c], float(far[at].max()))
                inertia[c] += sum(int(v) for v in dist[at].tolist())
                if sums:
                    total[c] = [s + int(v) for s, v in zip(total[c], x[at].sum(axis=0).tolist())]
            none = [None] * len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(low, pa.float64()),
                 pa.array([_long(int(v)) for v in dist.tolist()], pa.int64()), pa.array(none, pa.int64()),
                 pa.array(none, pa.list_(pa.string())), pa.array(none, pa.float64()), pa.array(none, pa.string())],
                schema=schema)
        rows = [c for c in range(k) if count[c]]
        if rows:
            none = [None] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(rows, pa.int32()),
                 pa.array(none, pa.float64()), pa.array(none, pa.int64()), pa.array([count[c] for c in rows], pa.int64()),
                 pa.array([[str(v) for v in total[c]] for c in rows], pa.list_(pa.string())),
                 pa.array([reach[c] for c in rows], pa.float64()), pa.array([str(inertia[c]) for c in rows], pa.string())],
                schema=schema)

    rows = laid if first else laid.join(state.select("row", "cluster", "low"), "row")
    return rows.mapInArrow(task, _STATE)


def _totals(found: DataFrame) -> dict[int, tuple[int, list[int], float, int]]:
    """By cluster: size, exact sums, radius and inertia; one row of a partition's
    sums each goes in, one row a cluster comes out."""
    def add(part):
        rows = list(part.itertuples(index=False))
        sums = [sum(int(r.sums[j]) for r in rows) for j in range(len(rows[0].sums))]
        return type(part)([(rows[0].cluster, sum(r.n for r in rows), [str(v) for v in sums],
                            max(r.reach for r in rows), str(sum(int(r.inertia) for r in rows)))],
                          columns=["cluster", "n", "sums", "reach", "inertia"])

    got = (found.filter("row is null").select("cluster", "n", "sums", "reach", "inertia").groupBy("cluster")
           .applyInPandas(add, "cluster int, n bigint, sums array<string>, reach double, inertia string").collect())
    return {r["cluster"]: (r["n"], [int(v) for v in r["sums"]], r["reach"], int(r["inertia"])) for r in got}


def first_centroids(points: DataFrame, clusters: int) -> DataFrame:
    """The rows with the smallest digests of their ids, in that order."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return (points.filter("vec_id is not null").withColumn("digest", digest)
            .orderBy("digest", "x").limit(clusters))


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for
    every vector of ``vectors`` (``vec_id, embedding``) that takes part.

    Vectors that are null, have another number of components, or hold a null or
    non-finite one take no part.  Those without an id are clustered, but never
    start a centroid.  Rows that repeat an id are vectors of their own; as
    starts they follow in order of their vectors.  Fewer vectors with an id than
    ``clusters`` start fewer centroids; without any, or of an empty table, the
    result is empty.  Equal distances go to the smaller number.  A distance or
    inertia beyond 64 bits is null; clusters are exact all the same.  Further
    columns are ignored.
    """
    points = cut(usable(vectors, dim).withColumn("row", F.monotonically_increasing_id()))
    spark = points.sparkSession
    size = points.agg(F.count(F.lit(1)).alias("n"),
                      F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("top")).first()
    starts = [r["x"] for r in first_centroids(points, clusters).collect()]
    empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], empty)
    top = (size["top"] + 1) * SCALE
    kind = "float64" if top <= FLOAT_EXACT else "int64" if top <= LONG_EXACT else "object"
    now = [[int(v) for v in row] for row in whole(np.array(starts, dtype=float), "object").tolist()]
    parts = max(spark.sparkContext.defaultParallelism, -(-size["n"] // ROWS_PER_PARTITION))
    laid = cut_lineage(points.repartition(parts, "row").sortWithinPartitions("row"), keep_layout=True)
    loosen = [0.0] * len(now)
    state = None
    for _ in range(rounds):
        state = cut(_round(laid, state, Centroids(now, loosen, kind)))
        totals = _totals(state)
        moved = [[s // totals[c][0] for s in totals[c][1]] if c in totals else p for c, p in enumerate(now)]
        radius = np.array([totals[c][2] if c in totals else 0.0 for c in range(len(now))])
        with np.errstate(all="ignore"):
            loosen = loosening(_floats(now), _floats(moved), radius).tolist()
        now, state = moved, state.filter("row is not null")
    final = cut(_round(laid, state, Centroids(now, loosen, kind)))
    totals = _totals(final)
    inertia = _long(sum(t[3] for t in totals.values()))
    model = spark.createDataFrame(
        [(c, _long(t[3]), inertia, hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest())
         for c, t in sorted(totals.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row a cluster: the broadcast side is as small as the number asked for.
    return (final.filter("row is not null").select("vec_id", "cluster", "distance").join(F.broadcast(model), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
