"""Shared pieces of the iterative matching plans.

Every plan is a driver loop that holds only counters; each round is a few
Spark jobs over the (shrinking) edge table, which is cut from its lineage with
a reliable checkpoint every round.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duetto.names import DOCTOR, HOSPITAL
from duetto.session import Tables, counted_broadcast, cut_lineage

class NotConverged(RuntimeError):
    """A caller's round limit ended a loop, or the loop can never end."""


#: The edges are written anew when fewer than this share of them is left.  Dead
#: edges then cost no more than the live ones, and all the copies together are
#: smaller than the first.
COMPACT_BELOW = 0.5
#: Ranks of the first cell of the proposers' lists; the lists up to a cell's end are
#: four times as long as up to the one before.
HEAD_RANKS = 8


def write_cells(e: DataFrame, rank: str, tables: Tables) -> tuple[DataFrame, int]:
    """The edges, written in cells ``_cell`` of the proposers' ``rank``, and the last cell.

    A proposer needs no edge below those that it proposes, so the rounds lay out the
    first cells alone and take in the next one when some list's live edges there run
    out.  Cells are at most 15.
    """
    cell = F.expr(f"(length(bin(({rank} - 1) div {HEAD_RANKS})) + 1) div 2")
    cell = F.when(F.col(rank) > HEAD_RANKS, cell).otherwise(0)
    out = e.withColumn("_cell", cell.cast("int"))
    path = f"{tables.folder}/cells"
    out.write.partitionBy("_cell").parquet(path)
    tables.paths["cells"] = path
    lists = e.sparkSession.read.schema(out.schema).parquet(path)
    return lists, lists.agg(F.max("_cell")).first()[0] or 0


def round_numbers(max_iter: int | None):
    """1, 2, ... up to ``max_iter``; without end if it is None."""
    return itertools.count(1) if max_iter is None else range(1, max_iter + 1)


TRACE_SCHEMA = T.StructType([
    T.StructField("iteration", T.IntegerType(), False),
    T.StructField("n_changes", T.LongType(), False),
])


@dataclass
class MatchResult:
    """Outcome of an iterative matching plan.

    ``matching`` has one row per matched doctor.  ``changes`` holds the number
    of doctors whose match changed in each round (round 1 counts everyone
    matched in it); it is filled only when the plan ran with ``trace=True``.
    ``cycle`` is the first round and the length of a cycle of matchings in which a
    loop was caught.
    """

    matching: DataFrame
    rounds: int
    converged: bool
    changes: list[int] = field(default_factory=list)
    cycle: tuple[int, int] | None = None

    def trace(self, spark: SparkSession | None = None) -> DataFrame:
        """Changes per round as ``(iteration, n_changes)``.

        If the last computed round still changed something, a final
        ``(rounds + 1, 0)`` row marks the round that confirms the fixpoint,
        as the reference's stop rule ("no match changed") would see it.
        """
        spark = spark or self.matching.sparkSession
        rows = [(i + 1, int(n)) for i, n in enumerate(self.changes)]
        if rows and rows[-1][1] > 0 and self.converged:
            rows.append((len(rows) + 1, 0))
        return spark.createDataFrame(rows, TRACE_SCHEMA)


def changes_frame(new: DataFrame, old: DataFrame | None,
                  count_lost: bool) -> DataFrame:
    """One row ``n_changes``: doctors whose hospital differs between two
    small matchings.

    ``count_lost`` also counts doctors that were matched before and are not
    now (possible in doctor-proposing rounds, impossible in
    hospital-proposing ones).
    """
    cur = new.select(DOCTOR, F.col(HOSPITAL).alias("_h_new"))
    if old is None:
        return cur.agg(F.count(F.lit(1)).alias("n_changes"))
    prev = old.select(DOCTOR, F.col(HOSPITAL).alias("_h_old"))
    how = "full" if count_lost else "left"
    return (cur.join(prev, DOCTOR, how)
            .where(~F.col("_h_new").eqNullSafe(F.col("_h_old")))
            .agg(F.count(F.lit(1)).alias("n_changes")))


def count_changes(new: DataFrame, old: DataFrame | None, count_lost: bool) -> int:
    """Number of doctors whose hospital differs (see :func:`changes_frame`)."""
    return int(changes_frame(new, old, count_lost).first()["n_changes"])


def attach_quota(edges: DataFrame, quota) -> tuple[DataFrame, int | str, int]:
    """Normalise ``quota`` (an int, or a DataFrame ``hospital_id, quota``).

    Returns the edges (with a ``_quota`` column in the per-hospital case),
    the value to use as n in the top-n step, and a literal upper bound.
    Hospitals missing from a quota table, or whose quota is null or below 1, have
    no places, and so no edges.  A hospital with two quotas is an error.
    """
    if isinstance(quota, int):
        return (edges if quota >= 1 else edges.where(F.lit(False))), quota, max(quota, 1)
    q = cut_lineage(quota_table(quota).where("_cap >= 1")
                    .withColumnRenamed("_cap", "_quota"))
    row = q.agg(F.max("_quota").alias("top"), F.count(F.lit(1)).alias("n"),
                F.countDistinct(HOSPITAL).alias("hospitals")).first()
    if row["n"] != row["hospitals"]:
        raise ValueError("a hospital has more than one quota")
    max_q = row["top"] or 1
    # One row per hospital: broadcast when measured small.
    return edges.join(counted_broadcast(q, row_bytes=16), HOSPITAL, "inner"), "_quota", int(max_q)


def quota_table(quota: DataFrame) -> DataFrame:
    """A quota table as ``hospital_id, _cap``; null and negative quotas are 0."""
    return quota.select(HOSPITAL, F.greatest(F.coalesce(F.col("quota").cast("int"), F.lit(0)),
                                             F.lit(0)).alias("_cap"))


def with_row_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric to ``df``.

    The count is collected by whichever job computes ``df`` (no extra job);
    read it with :func:`observed_count` after that job.  Re-executed tasks can make
    observed metrics inexact, so callers use it only to decide when to run an
    exact check, never as the final word.
    """
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def observed_count(obs: Observation) -> int | None:
    """The observed row count, or None when no metric was collected.

    Spark drops a subtree it proves empty (statically or, with AQE, at run
    time), and the metric node with it; callers then fall back to an exact
    computation.
    """
    try:
        return int(obs.get["n"])
    except Py4JJavaError:       # Spark has no metric: the observed plan was pruned away
        return None
