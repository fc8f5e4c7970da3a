"""Projections and reshaping between list form and edge form.

List form: one row per entity with an ordered ``array<bigint>`` of
counterparts (best first), as in text preference files.  Edge form: one row
per pair with a rank column.  Edge form is what the plans run on; list form
is for exchange.  A list is bounded by the number of counterparts of one
entity, never by the table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK


def invert(edges: DataFrame) -> DataFrame:
    """The hospital-side view of the edges (B2): keyed by hospital."""
    return edges.select(HOSPITAL, DOCTOR, HOSPITAL_RANK, DOCTOR_RANK)


def explode_preferences(lists: DataFrame, id_col: str, prefs_col: str,
                        item_col: str, rank_col: str) -> DataFrame:
    """List form -> edge form.

    One row per distinct (id, item); rank = first 0-based position of the
    item in the list (lists may repeat ids).  Empty lists give no rows.
    """
    return (lists.select(id_col, F.posexplode(prefs_col).alias("_pos", item_col))
            .groupBy(id_col, item_col)
            .agg(F.min("_pos").cast("int").alias(rank_col)))


def collapse_preferences(edges: DataFrame, id_col: str, item_col: str,
                         rank_col: str, out: str = "prefs") -> DataFrame:
    """Edge form -> list form (B4): items ordered by rank, best first."""
    ordered = F.array_sort(F.collect_list(F.struct(rank_col, item_col)))
    return edges.groupBy(id_col).agg(
        F.transform(ordered, lambda x: x[item_col]).alias(out))


def list_text(prefs: Column | str, pad: int | None = None) -> Column:
    """Space-separated text of an id list (the text file line format).

    ``pad`` right-aligns every id in a field of that width (``%5d``-style).
    """
    c = F.col(prefs) if isinstance(prefs, str) else prefs
    if pad:
        return F.array_join(F.transform(c, lambda x: F.lpad(x.cast("string"), pad, " ")), " ")
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


def initial_state(entities: DataFrame, id_col: str = DOCTOR) -> DataFrame:
    """Everybody unmatched (B5): ``hospital_id`` NULL."""
    return entities.select(id_col, F.lit(None).cast("bigint").alias(HOSPITAL))


def next_choice(edges: DataFrame) -> DataFrame:
    """Each doctor's best remaining choice (B6): ``min_by`` on doctor_rank."""
    best = edges.groupBy(DOCTOR).agg(
        F.min(F.struct(DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK)).alias("_b"))
    return best.select(DOCTOR, "_b.*").select(DOCTOR, HOSPITAL, DOCTOR_RANK,
                                               HOSPITAL_RANK)


def drop_first_choice(lists: DataFrame, state: DataFrame,
                      prefs_col: str = "prefs") -> DataFrame:
    """Array form of B7: unmatched doctors lose their first listed choice.

    ``state`` is ``(doctor_id, hospital_id NULL=unmatched)``; doctors missing
    from it count as unmatched.
    """
    st = state.select(DOCTOR, F.col(HOSPITAL).alias("_match"))
    p = F.col(prefs_col)
    tail = F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0)))
    return (lists.join(st, DOCTOR, "left")
            .withColumn(prefs_col, F.when(F.col("_match").isNull() & (F.size(p) > 0),
                                          tail).otherwise(p))
            .drop("_match"))


def _with_match_rank(edges: DataFrame, state: DataFrame) -> DataFrame:
    m = state.where(F.col(HOSPITAL).isNotNull()).select(
        DOCTOR, F.col(DOCTOR_RANK).alias("_mr"))
    return edges.join(m, DOCTOR, "left")


def choices_at_or_above(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Choices up to and including the current match; all if unmatched.

    ``state`` is a matching with ``doctor_rank`` of the matched pair.
    """
    return (_with_match_rank(edges, state)
            .where(F.col("_mr").isNull() | (F.col(DOCTOR_RANK) <= F.col("_mr")))
            .drop("_mr"))


def choices_strictly_above(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Choices the doctor prefers to its match; all if unmatched."""
    return (_with_match_rank(edges, state)
            .where(F.col("_mr").isNull() | (F.col(DOCTOR_RANK) < F.col("_mr")))
            .drop("_mr"))


def worst_held(matching: DataFrame) -> DataFrame:
    """Per hospital: worst held rank and number held."""
    return matching.groupBy(HOSPITAL).agg(
        F.max(HOSPITAL_RANK).alias("worst_rank"),
        F.count(F.lit(1)).alias("n_held"))


def candidates_above_worst(edges: DataFrame, matching: DataFrame) -> DataFrame:
    """Doctors a hospital ranks before the worst one it holds.

    Hospitals holding nobody have no candidates, as in the reference check.
    """
    w = worst_held(matching).select(HOSPITAL, "worst_rank")
    return (edges.join(w, HOSPITAL)
            .where(F.col(HOSPITAL_RANK) < F.col("worst_rank"))
            .select(HOSPITAL, DOCTOR, HOSPITAL_RANK))


def rank_lookup(prefs: Column | str, item: Column | str) -> Column:
    """0-based position of ``item`` in a list, -1 if absent."""
    p = F.col(prefs) if isinstance(prefs, str) else prefs
    x = F.col(item) if isinstance(item, str) else item
    return (F.array_position(p, x) - 1).cast("int")
