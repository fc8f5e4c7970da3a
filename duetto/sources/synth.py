"""Synthetic markets (A2).

Every doctor draws ``k`` hospitals, with replacement (its list may repeat a
hospital; the first position counts) or without, and every hospital orders the
doctors that applied to it.  Randomness comes from a fixed integer hash of the ids and
the seed, not from ``rand()``: a re-run task, or a re-evaluated plan, gets the
same market.  The hash uses only bigint arithmetic modulo a 31-bit prime, so
any SQL engine can reproduce it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators.ranking import rank_within
from duetto.session import cut_lineage, row_partitions

PRIME = 2147483647          # 2**31 - 1; every product below stays < 2**62
STRIDE = 1000003            # separates draw numbers, and hospitals in pairs


def mix(x: Column, salt: int) -> Column:
    """Integer hash in [0, PRIME): two multiplicative steps and a square."""
    p = F.lit(PRIME).cast("bigint")
    a = F.pmod(x.cast("bigint"), p)
    b = F.pmod(a * F.lit(48271).cast("bigint") + F.lit(salt).cast("bigint"), p)
    c = F.pmod(b * b + F.lit(12345).cast("bigint"), p)
    return F.pmod(c * F.lit(16807).cast("bigint") + F.lit(salt).cast("bigint"), p)


def pair_mix(a: Column, b: Column, salt: int) -> Column:
    """Hash of two ids in which neither shifts the other."""
    p = F.lit(PRIME).cast("bigint")
    return mix(mix(a, salt) + F.lit(STRIDE).cast("bigint") * F.pmod(b.cast("bigint"), p), salt)


def next_prime(n: int) -> int:
    """The smallest prime that is at least ``n``."""
    n = max(2, n)
    while any(n % q == 0 for q in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def _draws(doctors: DataFrame, n_hospitals: int, k: int, seed: int, replace: bool) -> DataFrame:
    """``doctor_id, _i, hospital_id``: the doctors' lists.

    Without replacement, a doctor's list walks through all numbers below the
    next prime in steps of its own, which repeats none, and leaves out those that
    are no hospital.
    """
    d, i = F.col(DOCTOR), F.col("_i")
    if replace:
        return (doctors.select(DOCTOR, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"))
                .withColumn(HOSPITAL, F.pmod(pair_mix(d, i, seed), F.lit(n_hospitals)).cast("bigint")))
    if k > n_hospitals:
        raise ValueError("more choices than hospitals")
    prime = next_prime(n_hospitals)
    step = F.pmod(mix(d, seed + 2), F.lit(max(1, prime - 1))) + 1
    first = F.pmod(mix(d, seed), F.lit(prime))
    walk = F.transform(F.sequence(F.lit(0), F.lit(k + prime - n_hospitals - 1)),
                       lambda j: F.pmod(first + step * j, F.lit(prime)).cast("bigint"))
    own = F.slice(F.filter(walk, lambda h: h < n_hospitals), 1, k)
    return doctors.select(DOCTOR, F.posexplode(own).alias("_i", HOSPITAL))


def generate_preferences(doctors: DataFrame | int, n_hospitals: int, k: int,
                         seed: int = 42, spark=None, replace: bool = True) -> DataFrame:
    """Edges of a random market over the doctor ids in ``doctors`` (a
    DataFrame with ``doctor_id``, or a count n for ids 0..n-1; then pass
    ``spark``).

    ``doctor_rank`` is the first 0-based position of the hospital in the
    doctor's list; ``hospital_rank`` the 0-based position of the doctor in
    the hospital's list.  Hospitals without applicants have no edges.  Without
    ``replace`` every list holds ``k`` different hospitals.
    """
    if isinstance(doctors, int):
        doctors = spark.range(doctors).select(F.col("id").alias(DOCTOR))
    d, doctors = F.col(DOCTOR), doctors.select(DOCTOR)
    # A small file of doctors is one task's, the draws of all of them would be too.
    n_parts = row_partitions(doctors.sparkSession, k * doctors.count())
    draws = _draws(doctors.repartition(n_parts), n_hospitals, k, seed, replace)
    pairs = draws.groupBy(DOCTOR, HOSPITAL).agg(F.min("_i").cast("int").alias(DOCTOR_RANK))
    pairs = cut_lineage(pairs.withColumn("_key", pair_mix(d, F.col(HOSPITAL), seed + 1)))
    ranked = rank_within(pairs, HOSPITAL, [F.col("_key"), d], HOSPITAL_RANK)
    return ranked.select(DOCTOR, HOSPITAL, DOCTOR_RANK,
                         (F.col(HOSPITAL_RANK) - 1).cast("int").alias(HOSPITAL_RANK))
