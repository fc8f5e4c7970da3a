"""Classic rounds of doctor-proposing deferred acceptance, by a frontier.

In a plain round only the doctors that were rejected in the last one propose, each
to the next hospital of its list.  So a round needs the held proposals, the frontier
(rejected doctors, each with a cursor into its list) and the edges at those cursors.

Lists are written once, in cells: the powers of two between which a place on the
list lies, and a bucket of doctors.  There are at most 31 cells for each
``EDGES_PER_PARTITION`` edges, so a long list is in several of them, and a hot
doctor is no single partition.  A cell's files are sorted by place.

A cursor moves by one place a round at most.  So every ``AHEAD`` rounds the lists
are read once, for the next ``AHEAD`` places of all doctors that hold or make a
proposal, and these are cached; the rounds until then read them alone, and of these
the cells and places of their cursors.

A full hospital's cut, the rank of its worst held proposal, only moves up.  So a
proposal below it is refused whenever it is made, and changes nothing else.  The places
ahead leave such edges out, and are written anew without those below later cuts behind
the first, the second and every fourth round.  A rejected doctor without an edge at its cursor
is refused there, in that round, up to the last place ``_len`` of its list: rounds,
changes and numbers of rejected doctors stay those of the classic rounds.  As soon as the
places ahead, the held proposals and the rejected doctors that have places ahead are few
enough for a task, it runs the rounds up to the next reading of the lists
(``plans.task_rounds``).

The state of a round is one small table of held and rejected proposals.  With a
``journal`` it is written, together with the counters, under that name in the
checkpoint folder; a new driver that calls the loop with the same name goes on
behind the last round that is noted there.  Then every round is a table of its own,
with all the proposals made in it.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators import ranking
from duetto.operators.ranking import largest_groups, rank_within, top_n_per_group
from duetto.plans.common import NotConverged, round_numbers
from duetto.plans.task_rounds import rounds_task
from duetto.session import EDGES_PER_PARTITION, Tables, bounded_broadcast, counted_broadcast, few_partitions

_EDGE = [DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK, "_places"]
#: A filter lists so many places at most; more are a range.
LISTED_PLACES = 200
#: Rounds whose edges are taken from the lists at once.
AHEAD = 32
#: Places ahead and doctors, in units of ``EDGES_PER_PARTITION``, of which one task
#: runs the rounds.
TASK_PARTITIONS = 8


def _cell(at: Column, buckets: int) -> Column:
    power = F.length(F.bin(at)) - 1
    return (power * buckets + F.pmod(F.xxhash64(DOCTOR), F.lit(buckets))).cast("int")


def write_lists(edges: DataFrame, tables: Tables, buckets: int) -> str:
    """The edges with their places ``_at`` on the doctors' lists and the lists' last
    places ``_len``, in cells; the path."""
    split = largest_groups(edges, [DOCTOR])[DOCTOR] > ranking.MAX_GROUP_ROWS
    placed = rank_within(edges, DOCTOR, [DOCTOR_RANK], "_at", split=split)
    if split:
        ends = placed.groupBy(F.col(DOCTOR).alias("_d")).agg(F.max("_at").alias("_len"))
        placed = placed.join(ends, F.col(DOCTOR) == F.col("_d"), "left").drop("_d")
    else:
        placed = placed.withColumn("_len", F.max("_at").over(Window.partitionBy(DOCTOR)))
    # No cursor finds a doctor without an id again.
    placed = placed.withColumn("_len", F.when(F.col(DOCTOR).isNull(), 1).otherwise(F.col("_len")).cast("int"))
    path = f"{tables.folder}/lists"
    (placed.withColumn("_cell", _cell(F.col("_at"), buckets))
     .repartition("_cell").sortWithinPartitions("_cell", "_at", DOCTOR)
     .write.mode("overwrite").partitionBy("_cell").parquet(path))
    return path


def _open_edges(edges: DataFrame, judged: DataFrame, tables: Tables, name: str) -> DataFrame:
    """``edges`` without those below the cuts of the hospitals that are full; the cuts
    are the table ``name``."""
    cuts = (judged.where("_held").groupBy(F.col(HOSPITAL).alias("_h"))
            .agg(F.max(HOSPITAL_RANK).alias("_cut"), F.count(F.lit(1)).alias("_n"), F.max("_places").alias("_most"))
            .where(F.col("_n") >= F.col("_most")).select("_h", "_cut"))
    cuts = tables.put(name, cuts)
    return edges.join(counted_broadcast(cuts, row_bytes=24),
                      (F.col(HOSPITAL) == F.col("_h")) & (F.col(HOSPITAL_RANK) > F.col("_cut")), "left_anti")


def places_ahead(lists: DataFrame, judged: DataFrame, state: dict, buckets: int,
                 tables: Tables | None = None) -> DataFrame:
    """The next ``AHEAD`` places on the lists of all doctors in ``judged``, cached: all
    edges that can be proposed in as many rounds; with ``tables`` without those that
    are sure to be refused."""
    rows, first, last = state["held"] + state["rejected"], state["first"] + 1, state["last"] + AHEAD
    cells = F.col("_cell").between((first.bit_length() - 1) * buckets, last.bit_length() * buckets - 1)
    now = bounded_broadcast(judged.select(F.col(DOCTOR).alias("_d"), F.col("_at").alias("_now")), rows, row_bytes=24)
    # No list has more than last - first places here, so none is hot.
    near = lists.where(cells & F.col("_at").between(first, last))
    near = near if tables is None else _open_edges(near, judged, tables, "cuts")
    near = (near.join(now, (F.col(DOCTOR) == F.col("_d"))
                      & F.col("_at").between(F.col("_now") + 1, F.col("_now") + AHEAD))
            .drop("_d", "_now"))
    return few_partitions(near, rows * AHEAD).persist(StorageLevel.MEMORY_AND_DISK)


def next_proposals(lists: DataFrame, frontier: DataFrame | None, state: dict, buckets: int,
                   refused: bool = False) -> DataFrame:
    """The edges at the cursors ``_at`` of the frontier; without one, at the first place.
    With ``refused`` also the cursors that have no edge: then ``_edge`` is null."""
    if frontier is None:
        return lists.where((F.col("_cell") < buckets) & (F.col("_at") == 1)).drop("_cell")
    places = state["places"]
    at = (F.col("_at").isin(places) if len(places) <= LISTED_PLACES
          else F.col("_at").between(min(places), max(places)))
    here = lists.where(F.col("_cell").isin(state["cells"]) & at).drop("_cell")
    # A doctor has one cursor.  Written as a range, the place is no part of the join's
    # key, which then is one long.
    match = (F.col(DOCTOR) == F.col("_d")) & F.col("_at").between(F.col("_next"), F.col("_next"))
    cursors = frontier.withColumnsRenamed({DOCTOR: "_d", "_at": "_next", "_len": "_last"})
    if not refused:
        cursors = bounded_broadcast(cursors, state["rejected"], row_bytes=24)
        return here.join(cursors, match).drop("_d", "_next", "_last")
    found = cursors.hint("shuffle_hash").join(here.withColumn("_edge", F.lit(True)), match, "left")
    return (found.withColumns({DOCTOR: F.col("_d"), "_at": F.col("_next"), "_len": F.col("_last")})
            .drop("_d", "_next", "_last"))


def _judged(proposals: DataFrame, rows: int, n, max_n: int) -> DataFrame:
    """Proposals with ``_held``: whether the hospital has a place for them."""
    places = F.lit(n) if isinstance(n, int) else F.col("_places")
    if rows <= ranking.MAX_GROUP_ROWS:      # no hospital has more than rows
        order = Window.partitionBy(HOSPITAL).orderBy(HOSPITAL_RANK)
        return proposals.withColumn("_held", F.row_number().over(order) <= places)
    kept = top_n_per_group(proposals, HOSPITAL, HOSPITAL_RANK, "_places", max_n=max_n)
    return (proposals.join(kept.select(DOCTOR, F.lit(True).alias("_held")), DOCTOR, "left")
            .withColumn("_held", F.coalesce("_held", F.lit(False))))


def _summary(judged: DataFrame, buckets: int) -> dict:
    """Counters of a round.  Cells and places of the cursors are few: at most 31 cells
    for each bucket, and as many places as rounds so far."""
    cursor = F.when(~F.col("_held"), F.col("_at") + 1)
    row = judged.agg(
        F.count(F.when(F.col("_held"), 1)).alias("held"), F.count(cursor).alias("rejected"),
        F.count(F.when(F.col("_held") == F.col("_new"), 1)).alias("changed"),
        F.min("_at").alias("first"), F.max("_at").alias("last"),
        F.collect_set(cursor).alias("places"), F.collect_set(_cell(cursor, buckets)).alias("cells")).first()
    return {**row.asDict(), "places": sorted(row["places"]), "cells": sorted(row["cells"])}


def _measured(near: DataFrame) -> tuple[int, int]:
    """The rows, and those of the hospital that has most."""
    row = near.groupBy(HOSPITAL).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    return row[0] or 0, row[1] or 0


def _waiting(near: DataFrame, judged: DataFrame, how: str) -> DataFrame:
    """The rejected doctors with (``left_semi``) or without (``left_anti``) places ahead."""
    return judged.where(~F.col("_held")).join(near.select(DOCTOR).distinct(), DOCTOR, how)


def _room(state: dict, ahead: int) -> int:
    """The rejected doctors that a task can take besides the places ahead and the held proposals."""
    return TASK_PARTITIONS * EDGES_PER_PARTITION - state["held"] - ahead


def _fit_a_task(near: DataFrame, judged: DataFrame, state: dict, ahead: int) -> bool:
    room = _room(state, ahead)
    return room >= state["rejected"] or (room >= 0 and _waiting(near, judged, "left_semi").count() <= room)


def _in_a_task(near: DataFrame, judged: DataFrame, first: int, last: int, tables: Tables,
               aside: bool) -> tuple[DataFrame, list[int]]:
    """The state behind the rounds ``first`` to ``last``, or behind the first of them in
    which nobody is rejected, and the changes in each.  With ``aside`` the task is not
    given the rejected doctors without a place ahead, which only go on along their lists."""
    columns = [*_EDGE, "_at", "_len"]
    rows, until = judged.select(*columns, "_held"), 0
    if aside:
        others = _waiting(near, judged, "left_anti").select(*columns, "_held")
        until = first - 1 + (others.agg(F.max(F.col("_len") - F.col("_at"))).first()[0] or 0)
        rows = rows.where("_held").unionByName(_waiting(near, judged, "left_semi").select(*columns, "_held"))
    rows = rows.unionByName(near.select(*columns, F.lit(None).cast("boolean").alias("_held")))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]
                          + [T.StructField("_changed", T.LongType())])
    task = rounds_task(first, last, until, to_arrow_schema(schema))
    out = tables.put("task" if aside else f"round{last}", rows.repartition(1).mapInArrow(task, schema))
    noted = out.where(F.col("_changed").isNotNull()).select("_at", "_changed").collect()     # one row a round
    judged = out.where(F.col("_changed").isNull()).drop("_changed").withColumn("_new", F.lit(False))
    if aside:
        at = F.col("_at") + len(noted)
        others = others.where(at <= F.col("_len")).withColumn("_at", at).withColumn("_new", F.lit(False))
        judged = tables.put(f"round{last}", judged.unionByName(others))
    return judged, [r["_changed"] for r in sorted(noted)]


def plain_rounds(edges: DataFrame, n, max_n: int, size: int, max_iter: int | None = None,
                 journal: str | None = None) -> tuple[DataFrame, int, list[int]]:
    """The doctor-optimal matching of ``edges``, the rounds and the changes in each.

    ``n`` is the hospitals' number of places or the name of its column.
    """
    spark = edges.sparkSession
    tables = Tables(spark, "rounds", journal)
    buckets = -(-size // EDGES_PER_PARTITION) or 1
    places = F.lit(n) if isinstance(n, int) else F.col(n)
    e = edges.select(*_EDGE[:-1], places.cast("int").alias("_places"))
    schema = e.withColumns({"_at": F.lit(0), "_len": F.lit(0), "_cell": F.lit(0)}).schema
    noted = tables.last_note() if journal else None
    if noted:
        state = json.loads(noted)
        if state["size"] != size:
            raise ValueError(f"the journal {journal} belongs to another market")
        path, judged = state["lists"], spark.read.parquet(state["table"])
    else:
        path = write_lists(e, tables, buckets)
        state, judged = {"round": 0, "changes": [], "held": 0, "rejected": 0, "lists": path, "size": size}, None
    lists = spark.read.schema(schema).parquet(path)
    if judged is not None and "last" not in state:      # a note of an older version
        state = {**state, **_summary(judged, buckets)}
    columns = [*_EDGE, "_at"] if journal else [*_EDGE, "_at", "_len"]
    near, base = None, (0, None)     # the places ahead, and the round and table they were taken from
    ahead = most = 0                 # their rows, and those of the hospital that has most
    try:
        for rounds in round_numbers(max_iter):
            if rounds <= state["round"]:
                continue
            if judged is not None and not state["rejected"]:
                break
            old = state
            if judged is not None:
                if near is None or rounds > base[0] + AHEAD:
                    if near is not None:
                        near.unpersist()
                        tables.forget(base[1])
                    near = places_ahead(lists, judged, state, buckets, None if journal else tables)
                    base = (state["round"], state["table"])
                    ahead, most = (0, 0) if journal else _measured(near)
                elif not journal and (rounds - base[0] - 1 in (1, 2) or (rounds - base[0] - 1) % 4 == 0):
                    wide = near
                    near = tables.put("near", _open_edges(wide, judged, tables, "later-cuts"))
                    ahead, most = _measured(near)
                    wide.unpersist()
            if judged is not None and not journal and _fit_a_task(near, judged, state, ahead):
                last = min(base[0] + AHEAD, max_iter or base[0] + AHEAD)
                judged, changes = _in_a_task(near, judged, rounds, last, tables,
                                             state["rejected"] > _room(state, ahead))
                table, rounds = tables.paths[f"round{last}"], state["round"] + len(changes)
                state = {**old, **_summary(judged, buckets), "round": rounds, "table": table}
                state["changes"] = [*old["changes"], *changes]
            else:
                if judged is None:
                    new, refused = next_proposals(lists, None, state, buckets), None
                elif journal:
                    new, refused = next_proposals(near, judged.where(~F.col("_held"))
                                                  .select(DOCTOR, (F.col("_at") + 1).alias("_at")), state, buckets), None
                else:
                    front = (judged.where(~F.col("_held") & (F.col("_at") < F.col("_len")))
                             .select(DOCTOR, (F.col("_at") + 1).alias("_at"), "_len"))
                    new = next_proposals(near, front, state, buckets, True)
                    refused = (new.where(F.col("_edge").isNull())
                               .select(*columns, F.lit(True).alias("_new"), F.lit(False).alias("_held")))
                    new = new.where("_edge")
                now = new.select(*columns, F.lit(True).alias("_new"))
                if judged is None:
                    rows = now.count()
                else:
                    now = now.unionByName(judged.where("_held").select(*columns, F.lit(False).alias("_new")))
                    rows = state["held"] + state["rejected"]
                now = _judged(now, rows if refused is None else min(rows, most + max_n), n, max_n)
                judged = tables.put(f"round{rounds}", now if refused is None else now.unionByName(refused), rows)
                state = {**old, **_summary(judged, buckets), "round": rounds, "table": tables.paths[f"round{rounds}"]}
                state["changes"] = [*old["changes"], state["changed"]]
            if journal:
                tables.note(rounds, json.dumps(state))
            # Only now is the round before not needed any more; lost blocks of the places
            # ahead would be made anew from theirs.
            if "table" in old and old["table"] != base[1]:
                tables.forget(old["table"])
    finally:
        if near is not None:
            near.unpersist()
    tables.drop("near", "cuts", "later-cuts", "task")
    if judged is None or state["rejected"]:
        raise NotConverged(f"proposals are still rejected after {max_iter} rounds")
    if base[1] not in (None, state["table"]):
        tables.forget(base[1])
    return judged.where("_held"), state["round"], state["changes"]
