"""Aggregations (E1-E6) and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL
from duetto.plans.common import quota_table


def group_proposals(proposals: DataFrame) -> DataFrame:
    """Proposals per hospital (E1) as count / min / max doctor id.

    Partial aggregation before the shuffle, so hot hospitals cost nothing
    extra; a list is never built.
    """
    return proposals.groupBy(HOSPITAL).agg(
        F.count(F.lit(1)).alias("n_proposals"),
        F.min(DOCTOR).alias("min_doctor_id"),
        F.max(DOCTOR).alias("max_doctor_id"))


def fill_report(hospitals: DataFrame, matching: DataFrame, quota) -> DataFrame:
    """One row: hospitals, filled places, capacity, full and empty.

    ``quota`` is an int or a DataFrame ``(hospital_id, quota)``; missing
    hospitals have no places and count as full.
    """
    fill = matching.groupBy(HOSPITAL).agg(F.count(F.lit(1)).alias("_fill"))
    per = hospitals.select(HOSPITAL).join(fill, HOSPITAL, "left")
    if isinstance(quota, int):
        per = per.withColumn("_cap", F.lit(quota))
    else:
        per = per.join(quota_table(quota), HOSPITAL, "left")
    per = per.select(F.coalesce("_fill", F.lit(0)).alias("_fill"),
                     F.coalesce("_cap", F.lit(0)).alias("_cap"))
    return per.agg(
        F.count(F.lit(1)).alias("n_hospitals"),
        F.sum("_fill").cast("bigint").alias("filled"),
        F.sum("_cap").cast("bigint").alias("capacity"),
        F.sum(F.when(F.col("_fill") >= F.col("_cap"), 1).otherwise(0)).cast("bigint").alias("n_full"),
        F.sum(F.when(F.col("_fill") == 0, 1).otherwise(0)).cast("bigint").alias("n_empty"))


def best_offer(offers: DataFrame) -> DataFrame:
    """Each doctor's best offer (E5): argmin of doctor_rank."""
    b = offers.groupBy(DOCTOR).agg(F.min(F.struct(DOCTOR_RANK, HOSPITAL)).alias("_b"))
    return b.select(DOCTOR, F.col("_b." + HOSPITAL).alias(HOSPITAL),
                    F.col("_b." + DOCTOR_RANK).alias(DOCTOR_RANK))


def union_options(new: DataFrame, held: DataFrame) -> DataFrame:
    """Distinct union of new applicants and held doctors per hospital (G1)."""
    return (new.select(HOSPITAL, DOCTOR).unionByName(held.select(HOSPITAL, DOCTOR))
            .distinct())


def pair_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs present in both tables."""
    return a.select(DOCTOR, HOSPITAL).intersect(b.select(DOCTOR, HOSPITAL))


def better_not_held(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates above the worst held doctor that are not held."""
    return candidates.select(HOSPITAL, DOCTOR).join(
        held.select(HOSPITAL, DOCTOR), [HOSPITAL, DOCTOR], "left_anti")
