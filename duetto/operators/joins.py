"""Joins (D1-D3): all equi-joins on the integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, HOSPITAL, HOSPITAL_RANK
from duetto.operators.reshape import list_text


def mutual_edges(doctor_side: DataFrame, hospital_side: DataFrame) -> DataFrame:
    """Pairs both sides list (D1): doctor side carries ``doctor_rank``,
    hospital side ``hospital_rank``; one-sided pairs drop out."""
    return doctor_side.join(hospital_side, [DOCTOR, HOSPITAL], "inner")


def hospital_rosters(hospitals: DataFrame, matching: DataFrame) -> DataFrame:
    """Every hospital with its matched doctors, best first.

    Hospitals without a match keep a row with an empty roster.  A roster is
    bounded by the hospital's quota.
    """
    rost = matching.groupBy(HOSPITAL).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(HOSPITAL_RANK, DOCTOR))),
                    lambda x: x[DOCTOR]).alias("roster"))
    return (hospitals.select(HOSPITAL).join(rost, HOSPITAL, "left")
            .select(HOSPITAL,
                    F.coalesce(F.size("roster"), F.lit(0)).cast("int").alias("n_matched"),
                    F.coalesce(list_text("roster"), F.lit("")).alias("roster_text")))


def matching_with_unmatched(doctors: DataFrame, matching: DataFrame,
                            unmatched=-1) -> DataFrame:
    """Every doctor with its hospital, ``unmatched`` where none (D3 + B12).

    NULL is the engine's 'unmatched'; -1 is used only at this output edge.
    """
    m = matching.select(DOCTOR, HOSPITAL)
    return (doctors.select(DOCTOR).join(m, DOCTOR, "left")
            .select(DOCTOR, F.coalesce(F.col(HOSPITAL), F.lit(unmatched)
                                       .cast("bigint")).alias(HOSPITAL)))
