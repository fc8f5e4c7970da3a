"""Ranked two-sided markets built from interaction tables (A5).

Any table of (applicant, program, measures...) rows becomes ``edges``: one row
per pair, each side ranking the pairs it took part in.  Hospitals rank only
those who applied, as in the reference's generator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators.ranking import MAX_GROUP_ROWS, largest_groups, rank_within
from duetto.session import cut_lineage, row_partitions


def market_from_interactions(pairs: DataFrame,
                             doctor_order: Sequence[Column],
                             hospital_order: Sequence[Column]) -> DataFrame:
    """Rank every pair on both sides.

    ``pairs`` has one row per (doctor_id, hospital_id) plus whatever columns
    the orders refer to.  Both orders get the counterpart id as the last
    tie-break, so ranks are total and deterministic.  Ranks are 1-based.
    The pairs are materialised once; the largest group of each side decides
    between a plain window and the range-split ranking.
    """
    pairs = cut_lineage(pairs)
    # Each side is ranked by a plain window unless one of its groups is too
    # big for one task; then that side is ranked over range partitions.
    big = largest_groups(pairs, [DOCTOR, HOSPITAL])
    ranked = rank_within(pairs, DOCTOR, list(doctor_order) + [F.col(HOSPITAL)],
                         DOCTOR_RANK, split=big[DOCTOR] > MAX_GROUP_ROWS)
    ranked = rank_within(ranked, HOSPITAL,
                         list(hospital_order) + [F.col(DOCTOR)], HOSPITAL_RANK,
                         split=big[HOSPITAL] > MAX_GROUP_ROWS)
    return ranked.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order's customer: the interaction table.

    Only the columns the markets use are read (column pruning reaches the
    parquet scans).  Both sides are dealt out by the number of lines, so a
    task joins and groups no more of them in a larger table.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n_parts = row_partitions(spark, li.count())
    li, od = li.repartition(n_parts, "l_orderkey"), od.repartition(n_parts, "o_orderkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias(DOCTOR), F.col("l_suppkey").alias(HOSPITAL),
        "l_quantity", "l_extendedprice", "l_returnflag", "l_orderkey")


def pair_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, supplier) pair with the ranking measures.

    Partial aggregation runs before the shuffle, so a hot pair or customer
    is pre-summed on every map task.
    """
    return order_lines(spark, sf_dir).groupBy(DOCTOR, HOSPITAL).agg(
        F.sum("l_quantity").alias("qty"),
        F.max("l_extendedprice").alias("top_price"))


# Market variants on the driver tables.  Doctors (customers) always rank
# suppliers by total quantity bought, most first.  Hospitals (suppliers) rank
# customers by their largest line price ("price", variant A) or by total
# quantity, least first ("contested", variant B, where the doctor-optimal
# and hospital-optimal matchings differ).
HOSPITAL_ORDERS = {
    "price": lambda: [F.col("top_price").desc()],
    "contested": lambda: [F.col("qty").asc()],
}


def tpch_market(spark: SparkSession, sf_dir: str,
                variant: str = "price") -> DataFrame:
    """Edges of the customer x supplier market on the driver tables."""
    return market_from_interactions(
        pair_measures(spark, sf_dir),
        doctor_order=[F.col("qty").desc()],
        hospital_order=HOSPITAL_ORDERS[variant]())
