"""Ranking and top-k per group (F1, F2) plus a skew-safe row numbering.

``rank_within`` gives every row its 1-based position inside its group under a
total order.  A plain ``row_number() OVER (PARTITION BY g ...)`` sends a whole
group to one task; if one group holds a third of all rows that task does a
third of the work alone.  So the size of the largest group is measured first
(one cheap aggregation).  Small groups use the plain window; above
``MAX_GROUP_ROWS`` the rows are range-partitioned on the full sort key
instead, so a hot group is split over many partitions; each partition numbers
its rows locally and a tiny per-(partition, group) count table supplies the
offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duetto.session import counted_broadcast, cut_lineage, layout_partitions


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


# Largest group a single task may rank with a plain window (rows).  A group
# this size sorts in well under a second in one task; anything larger is
# split across range partitions.
MAX_GROUP_ROWS = 2_000_000


def largest_groups(df: DataFrame, groups: Sequence[str]) -> dict[str, int]:
    """Row count of the largest group for each grouping column (one job;
    partial aggregation before the shuffle, so hot keys cost nothing)."""
    sizes = None
    for g in groups:
        f = df.groupBy(g).agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(g).alias("_g"), "_n")
        sizes = f if sizes is None else sizes.unionByName(f)
    got = {r["_g"]: int(r["_m"]) for r in
           sizes.groupBy("_g").agg(F.max("_n").alias("_m")).collect()}   # one row per column
    return {g: got.get(g, 0) for g in groups}


def rank_within(df: DataFrame, group: str, order: Sequence[str | Column],
                out: str, num_partitions: int | None = None,
                split: bool | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number of each row inside ``group``.

    ``order`` must make the order total inside a group (end it with a unique
    id column).  ``split``: rank by range partitions (hot groups are spread
    over many tasks) or by a plain window (one task per group).  ``None``
    measures the largest group first and splits only above
    ``MAX_GROUP_ROWS``; pass a materialised ``df`` then, since it is read
    twice.
    """
    if split is None:
        split = largest_groups(df, [group])[group] > MAX_GROUP_ROWS
    if not split:
        w = Window.partitionBy(group).orderBy(*_as_cols(order))
        return df.withColumn(out, F.row_number().over(w))
    n = num_partitions or layout_partitions(df.sparkSession, df.count())
    key = [F.col(group)] + _as_cols(order)
    laid = (
        df.repartitionByRange(n, *key)
        .sortWithinPartitions(*key)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Partition ids and row ids must not change between the two reads below,
    # also when a task is re-run after an executor loss: materialise once.
    laid = cut_lineage(laid)
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("_pid", group)
        .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
        .select("_pid", group, "_first", "_off")
    )
    offsets = cut_lineage(offsets)
    return (
        laid.join(counted_broadcast(offsets, row_bytes=40), ["_pid", group])
        .withColumn(out, (F.col("_mid") - F.col("_first") + F.col("_off") + 1)
                    .cast("int"))
        .drop("_pid", "_mid", "_first", "_off")
    )


def top_n_per_group(df: DataFrame, group: str | Sequence[str],
                    rank: str | Column | Sequence[str | Column], n: int | str,
                    max_n: int | None = None, tiebreak: str | None = None,
                    keep_position: str | None = None) -> DataFrame:
    """Rows whose position inside ``group`` (ordered by ``rank``) is <= n.

    ``n`` is an int or the name of a per-group column (then ``max_n`` bounds
    it, so the literal bound still lets Spark plan a partial
    ``WindowGroupLimit`` that trims every map partition to the top rows
    before the shuffle -- hot groups never move whole).
    """
    ranks = [rank] if isinstance(rank, (str, Column)) else list(rank)
    order = _as_cols(ranks) + ([F.col(tiebreak)] if tiebreak else [])
    groups = [group] if isinstance(group, str) else list(group)
    pos = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    pos_name = keep_position or "_pos"
    ranked = df.withColumn(pos_name, pos)
    if isinstance(n, int):
        kept = ranked.where(F.col(pos_name) <= F.lit(n))
    else:
        if max_n is None:
            raise ValueError("a per-group n needs max_n (a literal bound)")
        kept = ranked.where((F.col(pos_name) <= F.lit(int(max_n)))
                            & (F.col(pos_name) <= F.col(n)))
    return kept if keep_position else kept.drop(pos_name)


def rejected_applicants(df: DataFrame, group: str | Sequence[str], rank: str,
                        n: int | str,
                        key: Sequence[str], max_n: int | None = None,
                        tiebreak: str | None = None) -> DataFrame:
    """Complement of :func:`top_n_per_group` (F2): those beyond the n best.

    Written as an anti join against the kept rows (at most n per group), so
    the big side is never gathered per group.
    """
    kept = top_n_per_group(df, group, rank, n, max_n=max_n, tiebreak=tiebreak)
    # At most n rows per group: materialise and measure before broadcasting.
    kept = counted_broadcast(cut_lineage(kept.select(*key)),
                             row_bytes=8 * len(key) + 16)
    return df.join(kept, list(key), "left_anti")
