"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, HOSPITAL


def matched_only(state: DataFrame) -> DataFrame:
    """Matched doctors only."""
    return state.where(F.col(HOSPITAL).isNotNull())


def active_proposers(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Doctors that are unmatched and still have a choice left."""
    matched = matched_only(state).select(DOCTOR)
    return edges.select(DOCTOR).distinct().join(matched, DOCTOR, "left_anti")


def changed_matches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Doctors whose match differs between two states.

    Unmatched on both sides (NULL / missing) counts as equal.
    """
    o = old.select(DOCTOR, F.col(HOSPITAL).alias("old_hospital_id"))
    n = new.select(DOCTOR, F.col(HOSPITAL).alias("new_hospital_id"))
    return (o.join(n, DOCTOR, "full")
            .where(~F.col("old_hospital_id").eqNullSafe(F.col("new_hospital_id"))))


def one_sided_pairs(doctor_side: DataFrame, hospital_side: DataFrame) -> DataFrame:
    """Pairs listed by one side only (C4), with ``side`` saying which.

    Both inputs are (doctor_id, hospital_id) pair tables; duplicates ignored.  A
    pair with a missing id equals no other side's pair, so each side lists it alone.

    One aggregation of both sides: a task holds one table of pairs, not the sorted
    sides of two joins.
    """
    rows = (doctor_side.select(DOCTOR, HOSPITAL, F.lit(1).alias("_side"))
            .unionByName(hospital_side.select(DOCTOR, HOSPITAL, F.lit(2).alias("_side"))))
    pairs = rows.groupBy(DOCTOR, HOSPITAL).agg(F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    no_id = F.col(DOCTOR).isNull() | F.col(HOSPITAL).isNull()
    sides = F.explode(F.array_distinct(F.array("_first", "_last")))
    return (pairs.where((F.col("_first") == F.col("_last")) | no_id).select(DOCTOR, HOSPITAL, sides.alias("_side"))
            .select(DOCTOR, HOSPITAL, F.when(F.col("_side") == 1, "doctor").otherwise("hospital").alias("side")))
