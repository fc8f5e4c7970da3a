"""Matching with contracts (I3): the propose-everywhere loop with a budgeted
choice rule.

Round: every doctor applies to all hospitals at least as good as its current
match (everywhere if unmatched); every hospital picks the applicants of
maximal total utility it can pay for (I4); every doctor takes its best
acceptance.  It stops when the number of changed matches is at most
``tolerance``.  The knapsack is not a substitutes choice rule, so that need not
happen: a round depends on the matching only, so a matching that comes again comes
for ever.  The loop keeps a checksum of every round's matching until one repeats;
without ``max_iter`` that is an error, with it the result names the cycle.  A
``max_iter`` that is reached ends the loop with ``converged`` false.  No stability
claim is made.

Physical shape: contract terms are computed once on the edges, which are laid
out once by doctor and block of ranks (checkpointed and cached), so that a long
list is in several partitions.  Each round anti-joins them with the
previous round's acceptances (broadcast when their observed size is small),
trims applicants per (hospital, price) on the map side, and solves the
bounded groups in pandas; the per-doctor best acceptance is computed only on
the small acceptance tables (change count, final matching).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.functions.terms import contract_terms
from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators.knapsack import affordable, knapsack_select
from duetto.plans.common import (MatchResult, NotConverged, count_changes, observed_count,
                                 round_numbers, with_row_count)
from duetto.plans.doctor_optimal import LIST_BLOCK
from duetto.session import (bounded_broadcast, counted_broadcast, cut_lineage, layout_partitions,
                            pin_layout)


def _best(accepted: DataFrame) -> DataFrame:
    """Each doctor's best acceptance (its match)."""
    b = accepted.groupBy(DOCTOR).agg(
        F.min(F.struct(DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK, "utility", "price")).alias("_b"))
    return b.select(DOCTOR, "_b.*")


def _by_block(accepted: DataFrame, long: DataFrame | None) -> DataFrame:
    """The acceptances' ranks ``_d, _b, _mr``, for each block of their doctor's list;
    ``long`` has the last block of the lists with more than one."""
    st = accepted.select(F.col(DOCTOR).alias("_d"), F.col(DOCTOR_RANK).alias("_mr"))
    if long is None:
        return st.withColumn("_b", F.lit(0))
    last = F.coalesce("_last", F.lit(0))
    return st.join(counted_broadcast(long, row_bytes=24), "_d", "left").select(
        "_d", "_mr", F.explode(F.sequence(F.lit(0), last)).alias("_b"))


def _digest(matching: DataFrame) -> tuple[int, int]:
    """Size and order-free checksum of a matching."""
    row = matching.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64(DOCTOR, HOSPITAL).cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def match_contracts(edges: DataFrame, max_iter: int | None = None, tolerance: int = 0,
                    terms: DataFrame | None = None) -> MatchResult:
    """Budgeted matching on ``edges``.

    ``terms``: optional (doctor_id, hospital_id, utility, price, budget), the
    budget constant within a hospital; defaults to :func:`contract_terms`.  The
    result's ``changes`` holds the changed matches per round.  Without
    ``max_iter``, raises :class:`NotConverged` if a matching comes again; with it, the
    result's ``cycle`` is the round at which the matching first came and after how
    many rounds it comes again.
    """
    if max_iter is not None and max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    spark = edges.sparkSession
    measured = edges.agg(F.count(F.lit(1)).alias("n"), F.max(DOCTOR_RANK).alias("rank")).first()
    n_parts = layout_partitions(spark, measured["n"])
    e = edges.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK)
    if terms is None:
        e = contract_terms(e)
    else:
        e = e.join(terms.select(DOCTOR, HOSPITAL, "utility", "price", "budget"),
                   [DOCTOR, HOSPITAL])
    # A block of a list's ranks stays together; most lists have one.
    e = e.withColumn("_block", F.floor(F.col(DOCTOR_RANK) / LIST_BLOCK).cast("int"))
    e = pin_layout(e.repartition(n_parts, DOCTOR, "_block"))
    most = affordable(e)
    long = None
    if (measured["rank"] or 0) >= LIST_BLOCK:       # at most one row for each LIST_BLOCK edges
        long = cut_lineage(e.groupBy(F.col(DOCTOR).alias("_d")).agg(F.max("_block").alias("_last"))
                           .where("_last > 0"))
    n_blocks = (measured["rank"] or 0) // LIST_BLOCK + 1
    seen: dict[tuple[int, int], int] = {}
    cycle = None
    accepted, n_acc = None, 0    # the state: this round's acceptances
    changes: list[int] = []
    converged = False
    rounds = 0
    for rounds in round_numbers(max_iter):
        if accepted is None:
            apps = e
        else:
            # Applications at or above the current match: an edge goes if
            # some acceptance of its doctor ranks better (= below the best
            # one), so the raw acceptances are the state and need no
            # per-doctor shuffle.  Anti join: size estimate = left side.
            # Their size was observed while they were written; observed
            # counts can only over-count, so the check errs towards not
            # broadcasting.
            apps = e.join(bounded_broadcast(_by_block(accepted, long), n_acc * (1 if long is None else n_blocks),
                                            row_bytes=20),
                          (F.col(DOCTOR) == F.col("_d")) & (F.col("_block") == F.col("_b"))
                          & (F.col(DOCTOR_RANK) > F.col("_mr")), "left_anti")
        chosen, obs = with_row_count(knapsack_select(
            apps, keep=(DOCTOR_RANK, HOSPITAL_RANK), most=most))
        new = cut_lineage(chosen)
        n_acc = observed_count(obs)
        if n_acc is None:
            n_acc = new.count()
        n_changed = count_changes(_best(new), None if accepted is None else _best(accepted),
                                  count_lost=True)
        changes.append(n_changed)
        accepted = new
        if n_changed <= tolerance:
            converged = n_changed == 0
            break
        if cycle is None:
            digest = _digest(_best(new))
            if digest in seen:
                cycle = (seen[digest], rounds - seen[digest])
                if max_iter is None:
                    e.unpersist()
                    raise NotConverged(f"the matching of round {rounds} came before, {cycle[1]} rounds ago")
            seen[digest] = rounds
    state = cut_lineage(_best(accepted))
    e.unpersist()
    return MatchResult(
        matching=state.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK,
                              "utility", "price"),
        rounds=rounds, converged=converged, changes=changes, cycle=cycle)
