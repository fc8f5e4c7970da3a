"""Exact top-k search by inner product over a paged M-tree.

Vectors of integers are placed in a metric space by one further coordinate that
makes all their norms equal: there, the largest inner product with a query is
the smallest Euclidean distance to it.  The tree has three levels:

* pivots, a bounded sample of the vectors, are the routing objects of the top;
  every vector belongs to its nearest pivot;
* the vectors of a pivot are cut into pages of bounded size, nodes with a
  routing object, a covering radius and the distance to their pivot;
* a page holds its vectors with their distances to its routing object.

A query visits pages best first, by their lower bounds.  Stored distances bound
a distance by the triangle inequality before it is computed: a page by its
distance to the pivot, a vector by its distance to the page's routing object.
Scores are integers, computed exactly: in floating point or 64 bits where the
largest component proves that nothing is lost, and in Python's integers beyond.
Bounds are computed on vectors scaled by a power of two, so that no norm overflows.

Pages are dealt to shards of bounded size and queries to blocks; every block
meets every shard as a bounded piece of work.  A bound on each query's k-th
score, from the shard of its nearest pivot, goes along to prune the others.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut

SCALE = 256
PIVOTS = 64             # bound of the sample of routing objects at the top
PAGE = 64               # vectors of a page
SHARD_VECTORS = 16_384  # vectors of a shard, about
QUERY_BLOCK = 4_096     # queries of a block, about
_SLACK = 1e-6           # relative slack of bounds in floating point
_LONG = (1 << 63) - 1


class Space(NamedTuple):
    """What all tasks know: dimension, largest squared norm and pivots (both of
    vectors scaled by 2^-shift), and the type in which scores are exact."""
    dim: int
    top: float
    pivots: np.ndarray
    shift: int = 0
    kind: str = "int64"     # float64, int64 or object


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, x array<double>``: floor(256 * component) of every valid vector, a
    whole number that a double holds exactly.

    Null vectors and those with a null or non-finite component take no part, nor
    rows without vec_id; a component whose 256-fold exceeds all doubles counts as
    non-finite.  Of rows that share a vec_id, the smallest vector stands.
    """
    scaled = F.transform("embedding", lambda v: SCALE * v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # From 2^53 on, all doubles are whole.
    whole = F.transform("x", lambda v: F.when(F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v))
    return (vectors.filter("vec_id is not null and embedding is not null and size(embedding) > 0")
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("x"))
            .filter(~bad).select("vec_id", whole.alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))


def _matrix(rows, dim: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with zeros."""
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _exact(x: np.ndarray, kind: str) -> np.ndarray:
    """``x`` in a type whose scalar products are exact."""
    if kind != "object":
        return x.astype(kind)
    out = np.empty(x.shape, dtype=object)
    out.ravel()[:] = [int(v) for v in x.ravel().tolist()]
    return out


def _lifted(x: np.ndarray, top: float, shift: int = 0) -> np.ndarray:
    """Scaled vectors with the coordinate that gives all of them the norm sqrt(top)."""
    x = np.ldexp(x.astype(float), -shift)
    norm = (x ** 2).sum(axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(top - norm, 0.0))[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(sq, 0.0))


class Page(NamedTuple):
    pivot: int
    to_pivot: float         # distance of the routing object to its pivot
    centre: np.ndarray      # routing object
    radius: float
    ids: np.ndarray
    vectors: np.ndarray     # in the type that keeps scores exact
    dist: np.ndarray        # of each vector to the routing object


def build_pages(ids: np.ndarray, x: np.ndarray, space: Space) -> list[Page]:
    """Pages of a shard: each pivot's vectors are halved between two far apart
    ones until they fit a page."""
    at, x = _lifted(x, space.top, space.shift), _exact(x, space.kind)
    to = _distances(at, space.pivots)
    home = to.argmin(axis=1)
    pages: list[Page] = []
    for p in np.unique(home):
        todo = [np.flatnonzero(home == p)]
        while todo:
            own = todo.pop()
            if len(own) > PAGE:
                a = own[_distances(at[own], at[own[:1]])[:, 0].argmax()]
                d = _distances(at[own], at[[a]])[:, 0]
                b = own[d.argmax()]
                lead = d - _distances(at[own], at[[b]])[:, 0]
                rank = np.argsort(lead, kind="stable")      # halves: ties and copies split as well
                todo += [own[rank[:len(own) // 2]], own[rank[len(own) // 2:]]]
                continue
            mean = at[own].mean(axis=0, keepdims=True)
            c = own[_distances(at[own], mean)[:, 0].argmin()]
            dist = np.sqrt(((at[own] - at[c]) ** 2).sum(axis=1))
            pages.append(Page(int(p), float(to[c, p]), at[c], float(dist.max()), ids[own], x[own], dist))
    return pages


class Tree:
    """Pages of one shard, ready for best-first search."""

    def __init__(self, pages: list[Page], space: Space):
        self.pages, self.space = pages, space
        self.pivot = np.array([p.pivot for p in pages], dtype=np.int64)
        self.to_pivot = np.array([p.to_pivot for p in pages])
        self.radius = np.array([p.radius for p in pages])
        self.centre = np.array([p.centre for p in pages]).reshape(len(pages), -1)

    def search(self, qid: int, q: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, -vec_id)`` of the shard, largest first, without
        the query's own; those below the score ``least`` may be left out."""
        top, unit = self.space.top, 1 << 2 * self.space.shift
        at = np.append(np.ldexp(q.astype(float), -self.space.shift), 0.0)
        square = float((at ** 2).sum())
        slack = _SLACK * (np.sqrt(square) + np.sqrt(top))
        reach = lambda s: np.sqrt(max(square + top - 2.0 * (s / unit), 0.0)) + slack     # noqa: E731
        q = _exact(q, self.space.kind)
        limit = np.inf if least is None else reach(least)
        to_pivot = np.sqrt(((self.space.pivots - at) ** 2).sum(axis=1))
        # Without a distance computed: the page's routing object is at least so far.
        rough = np.maximum(np.abs(to_pivot[self.pivot] - self.to_pivot) - self.radius, 0.0)
        heap = [(float(b), 0, i, 0.0) for i, b in enumerate(rough.tolist()) if b <= limit]
        heapq.heapify(heap)
        best: list[tuple[int, int]] = []        # a heap; its smallest is the k-th
        while heap:
            bound, exact, i, d = heapq.heappop(heap)
            if bound > limit:
                break
            page = self.pages[i]
            if not exact:       # now the distance to the routing object is worth it
                d = float(np.sqrt(((page.centre - at) ** 2).sum()))
                bound = max(bound, d - page.radius)
                if bound <= limit:
                    heapq.heappush(heap, (bound, 1, i, d))
                continue
            near = np.abs(d - page.dist) <= limit + slack
            scores = page.vectors[near] @ q
            for s, v in zip(scores.tolist(), page.ids[near].tolist()):
                if v == qid:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -v))
                elif (s, -v) > best[0]:
                    heapq.heapreplace(best, (s, -v))
                else:
                    continue
                if len(best) == k:
                    limit = min(limit, reach(best[0][0]))
        return sorted(best, reverse=True)


def space_of(points: DataFrame) -> Space | None:
    """Dimension and largest squared norm of all vectors, and a sample of pivots."""
    size = F.greatest(F.array_max("x"), -F.array_min("x"))
    whole = points.agg(F.max(F.size("x")).alias("dim"), F.max(size).alias("most"),
                       F.count(F.lit(1)).alias("n")).first()
    if not whole["n"]:
        return None
    dim, most = whole["dim"], whole["most"]
    shift = max(0, math.frexp(most)[1])
    bound = dim * int(most) ** 2        # of a score, exactly
    kind = "float64" if bound < 1 << 53 else "int64" if bound <= _LONG else "object"
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + (v * 2.0 ** -shift) * (v * 2.0 ** -shift))
    top = points.agg(F.max(square).alias("top")).first()["top"]
    share = min(1.0, 4.0 * PIVOTS / whole["n"])
    h = F.pmod(F.xxhash64(F.lit("pivots"), "vec_id"), F.lit(1_000_000))
    rows = (points.filter(h <= int(share * 1_000_000)).select("vec_id", "x")
            .orderBy(F.xxhash64(F.lit("order"), "vec_id")).limit(4 * PIVOTS).collect())
    at = _lifted(_matrix([r["x"] for r in rows], dim), top, shift)
    # Pivots far from one another, out of the sample.
    chosen, far = [0], _distances(at, at[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(at)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(at, at[chosen[-1:]])[:, 0])
    return Space(dim, top, at[chosen], shift, kind)


def _homes(points: DataFrame, space: Space) -> DataFrame:
    """``points`` with the number of the nearest pivot and the distance to it."""
    shared = points.sparkSession.sparkContext.broadcast(tuple(space))

    @F.pandas_udf("pivot int, dist double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = Space(*shared.value)
        for xs in batches:
            d = _distances(_lifted(_matrix(xs.tolist(), s.dim), s.top, s.shift), s.pivots)
            p = d.argmin(axis=1)
            yield pd.DataFrame({"pivot": p.astype(np.int32), "dist": d[np.arange(len(p)), p]})

    return points.withColumn("home", nearest("x")).select("vec_id", "x", "home.pivot", "home.dist")


def _search(shards: DataFrame, queries: DataFrame, space: Space, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of every (shard, block) pair; scores that
    may not fit 64 bits are decimal strings.

    ``shards(shard, block, vec_id, x)``, ``queries(shard, block, query_id, q, least)``.
    """
    shared = shards.sparkSession.sparkContext.broadcast(tuple(space))
    wide = space.kind == "object"

    def one(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            s = Space(*shared.value)
            tree = Tree(build_pages(rows["vec_id"].to_numpy(), _matrix(rows["x"].tolist(), s.dim), s), s)
            qs = _matrix(asked["q"].tolist(), s.dim)
            for qid, q, least in zip(asked["query_id"].tolist(), qs, asked["least"].tolist()):
                got = tree.search(qid, q, k, None if pd.isna(least) else int(least))
                out += [(qid, -v, str(score) if wide else int(score)) for score, v in got]
        found = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
        return found.astype({"query_id": "int64", "vec_id": "int64", "score": "str" if wide else "int64"})

    return (shards.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
            .applyInPandas(one, f"query_id bigint, vec_id bigint, score {'string' if wide else 'bigint'}"))


def _ranked_wide(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query where scores are decimal strings: at most ``k``
    rows of each shard come together.  A score beyond 64 bits is null."""
    def best(rows: pd.DataFrame) -> pd.DataFrame:
        order = sorted((-int(s), v) for s, v in zip(rows["score"], rows["vec_id"].tolist()))[:k]
        return pd.DataFrame({"query_id": rows["query_id"].iloc[:len(order)].to_numpy(),
                             "rank": np.arange(1, len(order) + 1, dtype="int32"),
                             "vec_id": [v for _, v in order],
                             "score": pd.array([-s if abs(s) <= _LONG else None for s, _ in order], dtype="Int64")})

    return found.groupBy("query_id").applyInPandas(
        best, "query_id bigint, rank int, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, asked, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every valid vector for whose vec_id
    the condition ``asked`` holds, its ``k`` largest inner products with the other
    valid vectors; ties go to the smaller vec_id.

    ``vectors`` has ``vec_id`` and ``embedding``; further columns are ignored.
    See :func:`quantised` for rows that take no part and for repeated vec_ids.
    Ranks are exact for components of any size; a score beyond 64 bits is null.
    Shorter vectors count as filled with zeros.  Without another vector, a query
    has no result; an empty table gives an empty result.
    """
    from pyspark.sql import Window

    points = cut(quantised(vectors))
    spark = points.sparkSession
    space = space_of(points)
    if space is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    homes = cut(_homes(points, space))
    # Shards: the vectors of neighbouring pivots in order of the distance to
    # them, cut every SHARD_VECTORS; a large pivot is split, whatever its keys.
    n = homes.count()
    shards = max(1, -(-n // SHARD_VECTORS))
    dealt = cut(homes.repartitionByRange(shards, "pivot", "dist", F.xxhash64("vec_id"))
                .withColumn("shard", F.spark_partition_id()))
    shards = dealt.agg(F.max("shard")).first()[0] + 1       # as many as were dealt
    queries = dealt.filter(asked).select(F.col("vec_id").alias("query_id"), F.col("x").alias("q"),
                                         F.col("shard").alias("home"))
    queries = cut(queries)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    queries = queries.withColumn("block", block)
    rows = dealt.select("shard", "vec_id", "x").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    null = F.lit(None).cast("bigint")
    first = cut(_search(rows, queries.select(F.col("home").alias("shard"), "block", "query_id", "q",
                                             null.alias("least")), space, k))
    # Scores as strings give no bound; such searches are exact without.
    worst = null if space.kind == "object" else F.when(F.count(F.lit(1)) >= k, F.min("score"))
    kth = first.groupBy("query_id").agg(worst.alias("least"))
    rest = (queries.join(kth, "query_id", "left")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .filter("shard <> home").select("shard", "block", "query_id", "q", "least"))
    found = first.unionByName(_search(rows, rest, space, k)) if shards > 1 else first
    if space.kind == "object":
        return _ranked_wide(found, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
