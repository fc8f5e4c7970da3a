"""Doctor-optimal stable matching (I1): doctor-proposing deferred acceptance.

Round on the remaining edges ``e``:

1. proposals: every doctor proposes to its best remaining edge;
2. every hospital holds its ``quota`` best proposals (top-n by
   ``hospital_rank``);
3. deletion.  Plain: the rejected proposals' edges are deleted (the doctor
   moves on to its next choice).  Accelerated: a hospital that holds a full
   quota deletes *every* edge it ranks below its ``quota``-th proposal -- it
   will never accept such a doctor again -- so doctors skip hopeless choices
   in one round instead of one choice per round.

Stop when a round deletes nothing; the proposals then are the matching.

Physical layout: the edges are written once in cells of doctor ranks, and the rounds
lay out the cells in which every doctor still has an edge: hash-partitioned by doctor
and sorted by (doctor, doctor_rank), checkpointed and cached, so step 1 is a streaming
pass with no exchange and no sort.  Where a list reaches ``LIST_BLOCK`` ranks, the
edges are partitioned by (doctor, block of ranks); step 1 then exchanges one row for
each doctor and block.  Step 2 works on at most one row per
doctor, trimmed to ``quota`` rows per hospital on every map task before its
shuffle.  Accelerated mode never rewrites the edges: its state is the held
proposals, and step 3 is an anti join with one cut per full hospital
(broadcast below the session's threshold).  Plain rounds read only the edges at
the cursors of rejected doctors (``plans.frontier``).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, EDGE_COLUMNS, HOSPITAL, HOSPITAL_RANK
from duetto.operators.ranking import top_n_per_group
from duetto.plans import common
from duetto.plans.common import (MatchResult, NotConverged, attach_quota, changes_frame,
                                 observed_count, round_numbers, with_row_count, write_cells)
from duetto.plans.frontier import plain_rounds
from duetto.plans.local import settle
from duetto.session import (Tables, bounded_broadcast, compacted, cut_lineage, fits_broadcast,
                            layout_partitions, pin_layout)


#: Doctor ranks that stay together in one partition where lists are longer.
LIST_BLOCK = 1 << 20


def _layout(e: DataFrame, n_parts: int, blocks: bool = False) -> DataFrame:
    """The edges as the rounds read them: by doctor, or with ``blocks`` by doctor and
    block of ranks, so that a doctor's long list is in several partitions and its best
    remaining edge is the best one of its blocks."""
    keys = [F.col(DOCTOR)] + [F.floor(F.col(DOCTOR_RANK) / LIST_BLOCK)] * blocks
    return e.repartition(n_parts, *keys).sortWithinPartitions(DOCTOR, DOCTOR_RANK)


def proposals(e: DataFrame) -> DataFrame:
    """Each doctor's best remaining edge (B6 in edge form)."""
    return top_n_per_group(e, DOCTOR, DOCTOR_RANK, 1)


def held_proposals(prop: DataFrame, n, max_n: int) -> DataFrame:
    """The proposals each hospital keeps, with their position ``_pos``."""
    return top_n_per_group(prop, HOSPITAL, HOSPITAL_RANK, n, max_n=max_n,
                           keep_position="_pos")


def _cuts(held: DataFrame, n) -> DataFrame:
    """Per full hospital: the rank of its worst held proposal (``_h, _cut``)."""
    full = F.col("_np") >= (F.lit(n) if isinstance(n, int) else F.col("_q"))
    agg = [F.max(HOSPITAL_RANK).alias("_cut"), F.max("_pos").alias("_np")]
    if not isinstance(n, int):
        agg.append(F.max(n).alias("_q"))
    return (held.groupBy(HOSPITAL).agg(*agg).where(full)
            .select(F.col(HOSPITAL).alias("_h"), "_cut"))


def _round_summary(held: DataFrame, prev: DataFrame | None, n, worst_h: DataFrame,
                   bound: int, trace: bool) -> tuple[bool, int]:
    """(whether this round's cuts delete an edge, changed matches) in one job.

    Cuts only move up.  A hospital whose cut moved up deletes at least the
    edge at its old cut; a hospital full for the first time deletes
    something iff it ranks a doctor below the new cut.
    """
    cur = _cuts(held, n).select(F.col("_h").alias(HOSPITAL), "_cut")
    if prev is None:
        j = cur.withColumn("_prev", F.lit(None).cast("int"))
    else:
        old = _cuts(prev, n).select(F.col("_h").alias(HOSPITAL), F.col("_cut").alias("_prev"))
        j = cur.join(old, HOSPITAL, "left")
    j = bounded_broadcast(j, bound, row_bytes=24).join(worst_h, HOSPITAL)
    out = j.agg(F.sum(F.when(F.col("_cut") < F.coalesce(F.col("_prev"), F.col("_worst")), 1)
                      .otherwise(0)).cast("bigint").alias("v")).select(F.lit("deleting").alias("k"), "v")
    if trace:
        out = out.unionByName(changes_frame(held, prev, count_lost=True).select(
            F.lit("changes").alias("k"), F.col("n_changes").cast("bigint").alias("v")))
    got = {r["k"]: r["v"] for r in out.collect()}      # one or two rows, one job
    return bool(got["deleting"]), int(got.get("changes") or 0)


def _moved_cuts(new: DataFrame, old: DataFrame | None, n) -> DataFrame:
    """Cuts that are new or moved up this round (``_h, _cut``)."""
    cur = _cuts(new, n)
    if old is None:
        return cur
    return cur.join(_cuts(old, n), ["_h", "_cut"], "left_anti")


def _accelerated_rewrite(e: DataFrame, n, max_n: int, max_iter: int | None, trace: bool,
                         worst_h: DataFrame, bound: int, lay):
    """Accelerated rounds when the cut table is too big to broadcast.

    Edges below an unchanged cut were deleted when that cut was set, so each
    round deletes only below the cuts that moved -- usually far fewer rows,
    broadcast when they fit -- and rewrites the laid-out edges without them.
    Only when even the moved cuts exceed the budget does a round shuffle the
    edges (by hospital, then back to the doctor layout).
    """
    spark = e.sparkSession
    changes: list[int] = []
    held = None
    cur = e
    for rounds in round_numbers(max_iter):
        new = cut_lineage(held_proposals(proposals(cur), n, max_n))
        deleting, changed = _round_summary(new, held, n, worst_h, bound, trace)
        if trace:
            changes.append(changed)
        if not deleting:
            return new, rounds, True, changes
        moved = cut_lineage(_moved_cuts(new, held, n))
        n_moved = moved.count()
        below = (F.col(HOSPITAL) == F.col("_h")) & (F.col(HOSPITAL_RANK) > F.col("_cut"))
        if fits_broadcast(spark, n_moved, 24):
            nxt = cur.join(F.broadcast(moved), below, "left_anti")
        else:
            nxt = lay(cur.join(moved.hint("shuffle_hash"), below, "left_anti"))
        cur = cut_lineage(nxt, keep_layout=True)
        held = new
    raise NotConverged(f"edges are still deleted after {max_iter} rounds")


def _without(e: DataFrame, held: DataFrame | None, n, bound: int) -> DataFrame:
    """``e`` without the edges below the cuts of the held proposals."""
    if held is None:
        return e
    return e.join(bounded_broadcast(_cuts(held, n), bound, row_bytes=24),
                  (F.col(HOSPITAL) == F.col("_h")) & (F.col(HOSPITAL_RANK) > F.col("_cut")), "left_anti")


def _accelerated(lists: DataFrame, last: int, n, max_n: int, max_iter: int | None, trace: bool, lay):
    """Accelerated rounds.  Cuts only move up (a hospital's held proposals
    keep proposing to it), so the remaining edges are always "original edges
    minus those below their hospital's current cut": the state is the held
    proposals (at most quota x hospitals rows).  The edges are written anew,
    without the dead ones, only when most of them are dead.

    The rounds run on the first cells of the doctors' ``lists``.  When some doctor has
    no live edge there though its list goes on, the live edges of the next cell are
    added for all, before the round counts.

    The live edges only shrink, so round k-1 deleted nothing iff round k sees
    as many live edges as round k-1.  That count is observed inside the
    round's one job; only when it repeats does an exact small-table check
    run to confirm the fixpoint.  With ``trace`` every round runs the exact
    check together with the change count instead.
    """
    worst_h = cut_lineage(lists.groupBy(HOSPITAL).agg(F.max(HOSPITAL_RANK).alias("_worst")))
    bound = worst_h.count()              # one cut per hospital at most
    if not fits_broadcast(lists.sparkSession, bound, 24):
        e = pin_layout(lay(lists.drop("_cell")))
        try:
            return _accelerated_rewrite(e, n, max_n, max_iter, trace, worst_h, bound, lay)
        finally:
            e.unpersist()
    ends = cut_lineage(lists.where("_cell > 0").groupBy(DOCTOR).agg(F.max("_cell").alias("_last")))
    changes: list[int] = []
    held = older = None
    n_live_prev = size = None
    cell = 0
    e = pin_layout(lay(lists.where(F.col("_cell") == cell).drop("_cell")))
    for rounds in round_numbers(max_iter):
        left = _without(e, held, n, bound)
        while cell < last and not (ends.where(F.col("_last") > cell)
                                   .join(left.select(DOCTOR), DOCTOR, "left_anti").isEmpty()):
            cell += 1
            more = _without(lists.where(F.col("_cell") == cell).drop("_cell"), held, n, bound)
            e = compacted(lay(left.unionByName(more)), e)
            n_live_prev = size = None
            left = _without(e, held, n, bound)
        live, obs = with_row_count(left)
        new = cut_lineage(held_proposals(proposals(live), n, max_n))
        n_live = observed_count(obs)
        size = size or n_live
        if trace:
            deleting, changed = _round_summary(new, held, n, worst_h, bound, True)
            changes.append(changed)
            if not deleting:
                e.unpersist()
                return new, rounds, True, changes
        else:
            if (n_live is None or n_live == n_live_prev) and held is not None \
                    and not _round_summary(held, older, n, worst_h, bound, False)[0]:
                # Round rounds-1 deleted nothing: its proposals are the answer
                # (this round recomputed the same ones).
                e.unpersist()
                return held, rounds - 1, True, changes
            n_live_prev = n_live
        if n_live and n_live < common.COMPACT_BELOW * size:
            e, size = compacted(left, e), n_live
        older, held = held, new
    e.unpersist()
    if not trace and not _round_summary(held, older, n, worst_h, bound, False)[0]:
        return held, max_iter, True, changes
    raise NotConverged(f"edges are still deleted after {max_iter} rounds")


def match_doctor_optimal(edges: DataFrame, quota=6, max_iter: int | None = None,
                         accelerate: bool = True,
                         trace: bool = False, local: bool = False,
                         journal: str | None = None) -> MatchResult:
    """Doctor-optimal stable matching of ``edges`` with ``quota`` places.

    ``quota``: int or DataFrame ``(hospital_id, quota)``.  ``accelerate``
    drops every edge below a full hospital's worst held proposal each round
    (same matching, far fewer rounds).  Every round but the last deletes an
    edge, so the loop ends; a ``max_iter`` that ends it earlier raises
    :class:`NotConverged`.  ``local`` brings every partition to rest before each
    exchange (``plans.local``): the same matching in fewer rounds, where the edges
    fit few partitions; it has no trace.  Without ``accelerate`` the rounds are the
    classic ones, by a frontier (``plans.frontier``): with a ``journal``, a name in
    the checkpoint folder, a loop whose driver was lost is resumed by the same call.
    """
    spark = edges.sparkSession
    e, n, max_n = attach_quota(edges.select(*EDGE_COLUMNS), quota)
    measured = e.agg(F.count(F.lit(1)).alias("n"), F.max(DOCTOR_RANK).alias("rank")).first()
    size, blocks = measured["n"], (measured["rank"] or 0) >= LIST_BLOCK
    if not accelerate:
        held, rounds, changes = plain_rounds(e, n, max_n, size, max_iter, journal)
        return MatchResult(held.select(*EDGE_COLUMNS), rounds, True, changes if trace else [])
    if journal:
        raise ValueError("only the classic rounds keep a journal")
    if local and not trace:
        settled = settle(e, n, max_n, DOCTOR, size, max_iter)
        if settled is not None:
            return MatchResult(settled[0].select(*EDGE_COLUMNS), settled[1], True)
    lay = partial(_layout, n_parts=layout_partitions(spark, size), blocks=blocks)
    tables = Tables(spark, "lists")
    try:
        held, rounds, converged, changes = _accelerated(*write_cells(e, DOCTOR_RANK, tables),
                                                        n, max_n, max_iter, trace, lay)
    finally:
        tables.drop("cells")
    return MatchResult(matching=held.select(*EDGE_COLUMNS), rounds=rounds,
                       converged=converged, changes=changes)
