"""Connected components over an edge table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free checksum: equal states, equal edges."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = (both.groupBy("u").agg(F.min("v").alias("m"))
           .select("u", F.least("u", "m").alias("m")))
    return (both.join(low, "u").filter("v > u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is
    its smallest node.  Nodes may be of any type that compares.

    Alternates large-star and small-star rewiring until the edges stop
    changing; then each edge points from a node to the root of its star.  Every
    step is two groupings and two joins on the edges.  Minima combine before the
    shuffle; the joins bring the edges of a hub together, which adaptive execution
    splits where it is skewed.  The number of rounds grows with the logarithm of the
    longest path.
    Edges with a null end and self-loops are ignored; an empty table gives an
    empty result.
    """
    now = cut(edges.select("u", "v").filter("u is not null and v is not null and u <> v")
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .distinct())
    before = _state(now)
    while before[0]:
        now = cut(_small_star(_large_star(now)))
        state = _state(now)
        if state == before:
            break
        before = state
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"),
                                    F.col("v").alias("component")).distinct()))
