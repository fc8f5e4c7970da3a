"""Deferred acceptance that runs to a fixpoint inside each partition first.

The order of proposals does not change the outcome of deferred acceptance.  So a
partition that holds all edges of its proposers may let them propose, be rejected
and propose again among themselves, before anything is exchanged.  A round is

1. one pass over the laid-out live edges, in which every partition brings its own
   proposers to rest against the proposals that the other partitions' proposers
   hold, as of the last exchange;
2. the exchange: every receiver keeps its best proposals of all partitions
   (top-n, trimmed on each map task), and edges that a full receiver ranks below
   them are dead for good.

When the exchange rejects nothing, the held proposals are the stable matching that
is best for the proposers.

A chain of rejections costs a round only where it crosses partitions.  Therefore
the edges are laid out in as few partitions as ``LOCAL_EDGES`` allows, and again in
fewer whenever most of them are dead.  The held proposals (places x hospitals at
most) go to every task and have to fit the broadcast budget; a partition has to fit
a task.  Otherwise, and beyond ``SETTLE_EDGES``, :func:`settle` returns None and the
caller runs global rounds.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators.ranking import top_n_per_group
from duetto.plans import common
from duetto.plans.common import NotConverged, observed_count, round_numbers, with_row_count
from duetto.session import broadcast_budget, compacted, cut_lineage, pin_layout

#: Live edges of one partition, about (40 MB as they are laid out).
LOCAL_EDGES = 1_500_000
#: A partition may be larger than that by this factor, by a large proposer.
MOST = 2
#: Edges up to which these rounds are worth it.  They use a core for each partition,
#: so few partitions leave most cores idle, and more of them save few rounds.
SETTLE_EDGES = 3_000_000

# The task function travels by value: workers need numpy and pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def come_to_rest(proposer: np.ndarray, receiver: np.ndarray, rank: np.ndarray, give: np.ndarray,
                 take: np.ndarray, held: dict[int, list[int]]) -> list[int]:
    """The edges (positions) at which these proposers rest.

    Edges are sorted by proposer and by its preference.  ``rank`` is the receiver's
    rank of the proposer, ``give`` and ``take`` how many partners either side has
    at most, ``held`` the ranks of the others' proposals by receiver.
    """
    if not len(proposer):
        return []
    first = np.flatnonzero(np.append(True, proposer[1:] != proposer[:-1]))
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(proposer)))).tolist()
    end = np.append(first[1:], len(proposer)).tolist()
    at, free = first.tolist(), give[first].tolist()
    receiver, rank, take = receiver.tolist(), rank.tolist(), take.tolist()
    heaps = {r: [(-x, -1) for x in ranks] for r, ranks in held.items()}     # the worst one on top
    for heap in heaps.values():
        heapq.heapify(heap)
    todo = list(range(len(first)))
    while todo:
        i = todo.pop()
        while free[i] and at[i] < end[i]:
            k = at[i]
            at[i] += 1
            heap = heaps.setdefault(receiver[k], [])
            if len(heap) < take[k]:
                heapq.heappush(heap, (-rank[k], k))
            elif rank[k] < -heap[0][0]:
                loser = heapq.heapreplace(heap, (-rank[k], k))[1]
                if loser >= 0:
                    free[owner[loser]] += 1
                    todo.append(owner[loser])
            else:
                continue
            free[i] -= 1
    return sorted(k for heap in heaps.values() for _, k in heap if k >= 0)


def _lay_out(e: DataFrame, by: str, order: str, size: int) -> DataFrame:
    return e.repartition(max(1, -(-size // LOCAL_EDGES)), by).sortWithinPartitions(by, order)


def _largest_partition(e: DataFrame) -> int:
    row = e.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    return int(row[0] or 0)


def settle(edges: DataFrame, n: int | str, max_n: int, by: str, size: int,
           max_iter: int | None = None) -> tuple[DataFrame, int] | None:
    """The matching that is best for the side ``by`` (DOCTOR or HOSPITAL), and the
    number of rounds, or None where the edges are too many or the state too large for a task.

    ``n`` is the hospitals' number of places or the name of its column, ``max_n`` its
    bound, ``size`` the number of edges.
    """
    if size > SETTLE_EDGES:
        return None
    spark = edges.sparkSession
    doctors = by == DOCTOR
    other, own_rank, rank = ((HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK) if doctors
                             else (DOCTOR, HOSPITAL_RANK, DOCTOR_RANK))
    places = F.lit(n) if isinstance(n, int) else F.col(n)
    e = edges.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK, places.cast("int").alias("_places"))
    # What receivers hold: places a hospital, or one a doctor that has an offer.
    bound = max_n * e.select(HOSPITAL).distinct().count()
    if bound * 32 > broadcast_budget(spark):
        return None
    e = pin_layout(_lay_out(e, by, own_rank, size))
    held = None
    try:
        if _largest_partition(e) > MOST * LOCAL_EDGES:
            return None
        for rounds in round_numbers(max_iter):
            left = e if held is None else e.join(F.broadcast(_worst(held, other, rank, doctors)),
                                                 (F.col(other) == F.col("_o")) & (F.col(rank) > F.col("_cut")),
                                                 "left_anti")
            live, seen = with_row_count(left)
            rested = cut_lineage(_rest(live, held, by, other, rank))
            live_edges = observed_count(seen)
            most, limit = ("_places", max_n) if doctors else (1, None)
            held = cut_lineage(top_n_per_group(rested, other, rank, most, max_n=limit))
            if rested.count() == held.count():      # nobody was rejected
                return held.drop("_places"), rounds
            if live_edges and live_edges < common.COMPACT_BELOW * size:
                e, size = compacted(_lay_out(left, by, own_rank, live_edges), e), live_edges
        raise NotConverged(f"proposals are still rejected after {max_iter} rounds")
    finally:
        e.unpersist()


def _worst(held: DataFrame, other: str, rank: str, doctors: bool) -> DataFrame:
    """The receivers that are full, and the rank of their worst proposal."""
    full = held.groupBy(F.col(other).alias("_o")).agg(
        F.max(rank).alias("_cut"), F.count(F.lit(1)).alias("_n"), F.max("_places").alias("_places"))
    return full.where(F.col("_n") >= (F.col("_places") if doctors else F.lit(1))).select("_o", "_cut")


def _rest(live: DataFrame, held: DataFrame | None, by: str, other: str, rank: str) -> DataFrame:
    """The proposals at which the proposers of each partition rest."""
    state = None
    if held is not None:        # within the broadcast budget, see settle
        state = live.sparkSession.sparkContext.broadcast(
            held.select(by, other, rank).toPandas().to_numpy(dtype=np.int64))
    doctors = by == DOCTOR

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        mine = rows[by].to_numpy()
        theirs: dict[int, list[int]] = {}
        if state is not None:
            foreign = state.value[~np.isin(state.value[:, 0], mine)]
            for _, o, x in foreign.tolist():
                theirs.setdefault(o, []).append(x)
        places, one = rows["_places"].to_numpy(), np.ones(len(rows), dtype=np.int64)
        give, take = (one, places) if doctors else (places, one)
        yield rows.iloc[come_to_rest(mine, rows[other].to_numpy(), rows[rank].to_numpy(), give, take, theirs)]

    return live.mapInPandas(task, live.schema)
