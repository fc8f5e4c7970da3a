"""Verification operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.plans.common import quota_table
from duetto.session import counted_broadcast


def blocking_pairs(edges: DataFrame, matching: DataFrame, quota=6) -> DataFrame:
    """Pairs that both prefer each other to what they have.

    A doctor prefers ``h`` if unmatched or ``h`` ranks above its match; a
    hospital prefers ``d`` if it has a free place or ranks ``d`` above the
    worst doctor it holds.  Empty result = stable.  ``quota`` is an int or a
    DataFrame ``(hospital_id, quota)``; missing hospitals and those with a null
    or negative quota have no places.
    """
    m_d = matching.select(DOCTOR, F.col(DOCTOR_RANK).alias("_mdr"))
    m_h = matching.groupBy(HOSPITAL).agg(F.count(F.lit(1)).alias("_fill"),
                                         F.max(HOSPITAL_RANK).alias("_worst"))
    # One row per matched doctor / per hospital: broadcast when measured
    # small, so the edges are scanned once without a shuffle.
    e = (edges.join(counted_broadcast(m_d, row_bytes=16), DOCTOR, "left")
         .join(counted_broadcast(m_h, row_bytes=24), HOSPITAL, "left"))
    if isinstance(quota, int):
        cap = F.lit(quota)
    else:
        e = e.join(counted_broadcast(quota_table(quota), row_bytes=16), HOSPITAL, "left")
        cap = F.coalesce(F.col("_cap"), F.lit(0))
    doctor_wants = F.col("_mdr").isNull() | (F.col(DOCTOR_RANK) < F.col("_mdr"))
    hospital_wants = (cap > 0) & ((F.coalesce(F.col("_fill"), F.lit(0)) < cap)
                                  | (F.col(HOSPITAL_RANK) < F.col("_worst")))
    return (e.where(doctor_wants & hospital_wants)
            .select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK))


def stability_check(edges: DataFrame, matching: DataFrame, quota=6) -> DataFrame:
    """One summary row: number of blocking pairs and whether it is stable."""
    return blocking_pairs(edges, matching, quota).agg(
        F.count(F.lit(1)).alias("n_blocking")).select(
        "n_blocking", (F.col("n_blocking") == 0).alias("is_stable"))


def assert_stable(edges: DataFrame, matching: DataFrame, quota=6) -> None:
    """Raise if the matching has a blocking pair."""
    if not blocking_pairs(edges, matching, quota).isEmpty():
        raise AssertionError("matching is not stable: blocking pairs exist")


def matching_consistency(edges: DataFrame, matching: DataFrame, quota=6) -> DataFrame:
    """One row of consistency counts.

    matched doctors = filled places; no doctor twice; no hospital over its
    quota (an int, or a DataFrame as in :func:`blocking_pairs`); every matched
    pair is an edge.
    """
    # One aggregation over tagged rows: per-hospital fills, per-doctor
    # counts and matched pairs that are not edges.
    fill = matching.groupBy(HOSPITAL).agg(F.count(F.lit(1)).alias("c"))
    if isinstance(quota, int):
        over = F.col("c") > quota
    else:
        fill = fill.join(quota_table(quota), HOSPITAL, "left")
        over = F.col("c") > F.coalesce(F.col("_cap"), F.lit(0))
    per_h = fill.select(F.lit("h").alias("kind"), "c", over.alias("over"))
    per_d = matching.groupBy(DOCTOR).agg(F.count(F.lit(1)).alias("c")).select(
        F.lit("d").alias("kind"), "c", F.lit(False).alias("over"))
    stray = (matching.select(DOCTOR, HOSPITAL)
             .join(edges.select(DOCTOR, HOSPITAL), [DOCTOR, HOSPITAL], "left_anti")
             .select(F.lit("s").alias("kind"), F.lit(1).cast("bigint").alias("c"),
                     F.lit(False).alias("over")))
    rows = per_h.unionByName(per_d).unionByName(stray)
    is_h, is_d, is_s = (F.col("kind") == "h"), (F.col("kind") == "d"), (F.col("kind") == "s")
    out = rows.agg(
        F.coalesce(F.sum(F.when(is_h, F.col("c"))), F.lit(0)).cast("bigint").alias("n_filled"),
        F.coalesce(F.max(F.when(is_h, F.col("c"))), F.lit(0)).cast("bigint").alias("max_fill"),
        F.coalesce(F.sum(F.when(F.col("over"), 1).otherwise(0)), F.lit(0)).cast("bigint")
        .alias("n_over_quota"),
        F.sum(F.when(is_d, 1).otherwise(0)).cast("bigint").alias("n_matched_doctors"),
        F.coalesce(F.max(F.when(is_d, F.col("c"))), F.lit(0)).cast("bigint").alias("max_per_doctor"),
        F.sum(F.when(is_s, 1).otherwise(0)).cast("bigint").alias("n_not_edges"))
    return out.withColumn(
        "consistent",
        (F.col("n_matched_doctors") == F.col("n_filled"))
        & (F.col("max_per_doctor") <= 1) & (F.col("n_over_quota") == 0)
        & (F.col("n_not_edges") == 0))


def contiguous_ids(df: DataFrame, id_col: str) -> DataFrame:
    """One row: min, max, distinct count and whether ids are 0..n-1."""
    return df.agg(F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id"),
                  F.countDistinct(id_col).alias("n_distinct")).withColumn(
        "contiguous",
        (F.col("min_id") == 0) & (F.col("max_id") == F.col("n_distinct") - 1))
