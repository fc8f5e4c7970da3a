"""Hospital-optimal stable matching (I2): the "propose everywhere" loop.

Round on the remaining edges ``E``:

1. offers: every hospital offers its ``quota`` best remaining doctors
   (top-n per hospital by ``hospital_rank``);
2. every doctor keeps the best offer it got (min ``doctor_rank``);
3. edges a doctor ranks below its best offer are deleted for good (its offers
   only improve from now on).

Stop when a round deletes nothing; the matching is that round's kept offers.
This is hospital-proposing deferred acceptance run in parallel rounds, so the
fixpoint is the hospital-optimal stable matching.

State.  A doctor's best offer never gets worse, so after round k the remaining
edges are exactly "the original edges minus those a doctor ranks below its
current best offer".  The loop therefore needs no edge table of its own: the
only state is the round's offers (at most quota x hospitals rows), and each
round reads the laid-out edges through an anti join with them; these are
written anew, without the dead ones, whenever most of them are dead ("some offer
ranks better" is the same test as "below the best offer", so the offers need
no per-doctor reduction and the round has a single shuffle: the trimmed
top-n rows).

Stop rule without counting edges: round k deletes something iff some doctor's
best offer is now better than its previous one, or a doctor got its first
offer and still lists a hospital below it.

Head: a hospital offers to its best remaining doctors, so the rounds need no edge
far down its list.  The edges are written once in cells of hospital ranks, each four
times as wide as all before.  The rounds run on the first cell; when a hospital makes
fewer offers than it has places there though its list goes on, the live edges of the
next cell are added for all, before the round counts.  So the edges are read once for
every cell that is needed, and not in every round.

Physical layout: the head is hash-partitioned by (hospital, block of
``RANK_BLOCK`` hospital ranks) and sorted by (hospital, hospital_rank) inside
each partition.  Each round is then one pass: broadcast anti join (keeps the
layout) -> partial ``WindowGroupLimit`` that trims every partition to ``quota``
rows per hospital with no sort -> shuffle of those rows only -> final top-n,
checkpointed as the state.  A hospital is in as many partitions as it has
blocks, however many partitions there are, so a round shuffles at most quota
rows for each block; a hot hospital and a hot doctor are both spread.

The state is broadcast only below the session's broadcast threshold, by its
proven bound (quota x hospitals).  Beyond it the edges are hash-partitioned by
doctor instead: the planner then shuffles the state to that partitioning and
leaves the edges where they are, at the price of a weaker trim (quota rows for
each hospital and partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, EDGE_COLUMNS, HOSPITAL, HOSPITAL_RANK
from duetto.operators.ranking import top_n_per_group
from duetto.plans import common
from duetto.plans.common import (MatchResult, NotConverged, attach_quota, observed_count,
                                 round_numbers, with_row_count, write_cells)
from duetto.plans.local import settle
from duetto.session import (Tables, bounded_broadcast, compacted, cut_lineage, fits_broadcast,
                            layout_partitions, pin_layout)

#: Hospital ranks that stay together in one partition.
RANK_BLOCK = 4096


def round_offers(e: DataFrame, n, max_n: int) -> DataFrame:
    """One round's offers: every hospital's ``n`` best remaining doctors."""
    return top_n_per_group(e, HOSPITAL, HOSPITAL_RANK, n, max_n=max_n).select(
        DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK)


def best_of(offers: DataFrame) -> DataFrame:
    """Each doctor's best offer: the round's matching (small input)."""
    best = offers.groupBy(DOCTOR).agg(
        F.min(F.struct(DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK)).alias("_b"))
    return best.select(DOCTOR, F.col("_b." + HOSPITAL).alias(HOSPITAL),
                       F.col("_b." + DOCTOR_RANK).alias(DOCTOR_RANK),
                       F.col("_b." + HOSPITAL_RANK).alias(HOSPITAL_RANK))


def best_offers(e: DataFrame, n, max_n: int) -> DataFrame:
    """One round's offers reduced to each doctor's best: the round matching."""
    return best_of(round_offers(e, n, max_n))


def remaining_edges(e: DataFrame, offers: DataFrame | None, bound: int) -> DataFrame:
    """Edges no doctor has ranked below an offer it holds.

    An edge goes as soon as *some* offer to its doctor ranks better -- the
    same as "below the doctor's best offer" -- so the raw offers serve as
    the state and need no per-doctor reduction (no shuffle by doctor).
    ``bound``: proven upper bound on the rows of ``offers``.
    """
    if offers is None:
        return e
    cap = bounded_broadcast(
        offers.select(F.col(DOCTOR).alias("_d"), F.col(DOCTOR_RANK).alias("_cap")),
        bound, row_bytes=24)
    return e.join(cap, (F.col(DOCTOR) == F.col("_d")) & (F.col(DOCTOR_RANK) > F.col("_cap")),
                  "left_anti")


def _round_summary(match: DataFrame, prev: DataFrame | None, edges: list[DataFrame],
                   bound: int) -> tuple[int, int, bool]:
    """(rows in match, doctors whose match changed, whether edges were deleted).

    One small job: the new matching against the previous one.  An offer that is better
    than the one before deletes that one's edge.  Only where there is none are doctors
    with their first offer looked up in ``edges``, the head first.
    """
    cur = match.select(DOCTOR, HOSPITAL, DOCTOR_RANK)
    if prev is None:
        j = cur.withColumn("_ph", F.lit(None).cast("bigint")).withColumn(
            "_pr", F.lit(None).cast("int"))
    else:
        p = prev.select(DOCTOR, F.col(HOSPITAL).alias("_ph"), F.col(DOCTOR_RANK).alias("_pr"))
        j = cur.join(p, DOCTOR, "left")
    j = j.where(F.col(DOCTOR).isNotNull())
    row = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col(HOSPITAL).eqNullSafe(F.col("_ph")), 1)).alias("changed"),
        F.count(F.when(F.col(DOCTOR_RANK) < F.col("_pr"), 1)).alias("better"),
        F.count(F.when(F.col("_pr").isNull(), 1)).alias("first"),
    ).first()
    deleting = bool(row["better"])
    if row["first"] and not deleting:
        first = bounded_broadcast(j.where(F.col("_pr").isNull()).select(
            F.col(DOCTOR).alias("_d"), F.col(DOCTOR_RANK).alias("_cap")), bound, row_bytes=24)
        below = (F.col(DOCTOR) == F.col("_d")) & (F.col(DOCTOR_RANK) > F.col("_cap"))
        deleting = any(not e.join(first, below, "left_semi").isEmpty() for e in edges)
    return row["n"], row["changed"], deleting


def _runs_out(offers: DataFrame, ends: DataFrame, places: int, cell: int) -> bool:
    """Whether a hospital makes fewer offers than it has places although its list goes
    on behind ``cell``.  All have ``places`` places."""
    if offers.count() == places:
        return False
    made = offers.select(HOSPITAL, F.lit(1).alias("_made"), F.lit(None).cast("int").alias("_last"),
                         F.lit(None).cast("int").alias("_cap"))
    listed = ends.select(HOSPITAL, F.lit(0).alias("_made"), "_last", "_cap")
    per = made.unionByName(listed).groupBy(HOSPITAL).agg(
        F.sum("_made").alias("_made"), F.max("_last").alias("_last"), F.max("_cap").alias("_cap"))
    return not per.where((F.col("_last") > cell) & (F.col("_made") < F.col("_cap"))).isEmpty()


def layout(e: DataFrame, n_parts: int, by_doctor: bool = False) -> DataFrame:
    """The edges as the rounds read them (see the module's docstring)."""
    keys = [F.col(DOCTOR)] if by_doctor else [
        F.col(HOSPITAL), F.floor(F.col(HOSPITAL_RANK) / RANK_BLOCK)]
    return e.repartition(n_parts, *keys).sortWithinPartitions(HOSPITAL, HOSPITAL_RANK)


def match_hospital_optimal(edges: DataFrame, quota=6, max_iter: int | None = None,
                           trace: bool = False, n_parts: int | None = None,
                           local: bool = False) -> MatchResult:
    """Hospital-optimal stable matching of ``edges`` with ``quota`` places.

    ``quota`` is an int for all hospitals or a DataFrame
    ``(hospital_id, quota)``.  Returns the matching of the fixpoint, the
    number of rounds and, with ``trace``, the match changes per round
    (``changes``).  Every round but the last deletes an edge, so the loop ends;
    a ``max_iter`` that ends it earlier raises :class:`NotConverged`.
    ``n_parts`` overrides the number of partitions of the layout.  ``local`` brings
    every partition to rest before each exchange (``plans.local``): the same matching
    in fewer rounds, where the edges fit few partitions; it has no trace.
    """
    spark = edges.sparkSession
    e, n, max_n = attach_quota(edges.select(*EDGE_COLUMNS), quota)
    if local and not trace:
        settled = settle(e, n, max_n, HOSPITAL, e.count(), max_iter)
        if settled is not None:
            return MatchResult(settled[0].select(*EDGE_COLUMNS), settled[1], True)
    tables = Tables(spark, "lists")
    lists, last = write_cells(e, HOSPITAL_RANK, tables)
    # Every hospital's last cell and places.
    ends = cut_lineage(lists.groupBy(HOSPITAL).agg(
        F.max("_cell").alias("_last"), F.max(F.lit(n) if isinstance(n, int) else F.col(n)).cast("int").alias("_cap")))
    # Proven bound on the matching: at most max_n offers per hospital.
    total = ends.agg(F.count(F.lit(1)).alias("hospitals"), F.sum("_cap").alias("places")).first()
    bound = max_n * total["hospitals"]
    by_doctor = not fits_broadcast(spark, bound, 24)

    def lay(head: DataFrame) -> DataFrame:
        return layout(head, n_parts or layout_partitions(spark, head.count()), by_doctor)

    try:
        match, rounds, changes = _rounds(lists, last, ends, total["places"], n, max_n, max_iter, trace, bound, lay)
    finally:
        tables.drop("cells")
    return MatchResult(matching=match.select(*EDGE_COLUMNS), rounds=rounds,
                       converged=True, changes=changes)


def _rounds(lists, last, ends, places, n, max_n, max_iter, trace, bound, lay):
    """The loop, on the cells of the ``lists`` in which all offers are found.  The live edges only shrink, so round k-1 deleted nothing iff
    round k sees as many live edges; that count is observed inside the
    round's one job, and only a repeated count triggers the exact check.
    With ``trace`` every round runs the exact check and the change count
    (one small job)."""
    changes: list[int] = []
    offers = older = None       # this round's and the previous round's offers
    n_live_prev = size = None
    cell = 0
    e = pin_layout(lay(lists.where(F.col("_cell") == cell).drop("_cell")))

    def summary(cur, prev):
        return _round_summary(best_of(cur), None if prev is None else best_of(prev),
                              [e, lists], bound)

    for rounds in round_numbers(max_iter):
        while True:
            left = remaining_edges(e, offers, bound)
            live, obs = with_row_count(left)
            new = cut_lineage(round_offers(live, n, max_n))
            if cell == last or not _runs_out(new, ends, places, cell):
                break
            cell += 1
            more = remaining_edges(lists.where(F.col("_cell") == cell).drop("_cell"), offers, bound)
            e = compacted(lay(left.unionByName(more)), e)
            n_live_prev = size = None
        n_live = observed_count(obs)
        size = size or n_live
        if trace:
            _, changed, deleting = summary(new, offers)
            changes.append(changed)
            if not deleting:
                e.unpersist()
                return cut_lineage(best_of(new)), rounds, changes
        else:
            if (n_live is None or n_live == n_live_prev) and offers is not None \
                    and not summary(offers, older)[2]:
                e.unpersist()
                return cut_lineage(best_of(offers)), rounds - 1, changes
            n_live_prev = n_live
        if n_live and n_live < common.COMPACT_BELOW * size:
            e, size = compacted(left, e), n_live
        older, offers = offers, new
    e.unpersist()
    if not trace and not summary(offers, older)[2]:
        return cut_lineage(best_of(offers)), max_iter, changes
    raise NotConverged(f"edges are still deleted after {max_iter} rounds")
