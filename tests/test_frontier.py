"""Classic rounds by a frontier: the serial loop, any cells, resumption, hot doctors."""

import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators import ranking
from duetto.plans import frontier
from duetto.plans.common import NotConverged
from duetto.plans.doctor_optimal import match_doctor_optimal
from duetto.session import Tables
from duetto.sources.synth import generate_preferences


def market(spark, n_d, n_h, k, seed):
    e = generate_preferences(spark.range(n_d).select(F.col("id").alias(DOCTOR)), n_h, k, seed).cache()
    return e, [tuple(r) for r in e.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK).collect()]


def pairs(result):
    return {r[DOCTOR]: r[HOSPITAL] for r in result.matching.collect()}


def classic_changes(rows, quota):
    """Changes of each round, one choice of a rejected doctor a round."""
    lists = {}
    for d, h, dr, hr in sorted(rows, key=lambda r: (r[0], r[2])):
        lists.setdefault(d, []).append((h, hr))
    at, held, changes = dict.fromkeys(lists, 0), {}, []
    while True:
        by = {}
        for d, i in at.items():
            if i < len(lists[d]):
                by.setdefault(lists[d][i][0], []).append((lists[d][i][1], d))
        now = {d: h for h, x in by.items() for _, d in sorted(x)[:quota]}
        changes.append(sum(held.get(d) != now.get(d) for d in set(held) | set(now)))
        held, lost = now, [d for x in by.values() for _, d in sorted(x)[quota:]]
        if not lost:
            return changes
        for d in lost:
            at[d] += 1


@pytest.mark.parametrize("small", [False, True])
def test_rounds_of_the_serial_loop(spark, monkeypatch, small):
    if small:       # several buckets, split ranking, no window over all proposals, a range of places
        monkeypatch.setattr(frontier, "EDGES_PER_PARTITION", 60)
        monkeypatch.setattr(frontier, "LISTED_PLACES", 0)
        monkeypatch.setattr(ranking, "MAX_GROUP_ROWS", 3)
    e, rows = market(spark, 30, 10, 6, 5)
    got = match_doctor_optimal(e, 2, accelerate=False, trace=True)
    assert pairs(got) == bf.doctor_proposing(rows, 2)
    assert got.changes == classic_changes(rows, 2) and got.rounds == len(got.changes)


@pytest.mark.parametrize("ahead", [1, 3])
def test_the_lists_are_read_once_for_several_rounds(spark, monkeypatch, ahead):
    monkeypatch.setattr(frontier, "AHEAD", ahead)
    read = []
    real = frontier.places_ahead
    monkeypatch.setattr(frontier, "places_ahead", lambda *a: read.append(1) or real(*a))
    e, rows = market(spark, 30, 30, 6, 3)
    got = match_doctor_optimal(e, 1, accelerate=False, trace=True)
    assert pairs(got) == bf.doctor_proposing(rows, 1) and got.changes == classic_changes(rows, 1)
    assert got.rounds > 4 and len(read) == -(-(got.rounds - 1) // ahead)


def test_a_loop_goes_on_where_its_driver_was_lost(spark, monkeypatch):
    e, rows = market(spark, 30, 30, 6, 3)
    want = match_doctor_optimal(e, 1, accelerate=False, trace=True)
    assert want.rounds > 4
    read = []
    real = frontier.next_proposals
    monkeypatch.setattr(frontier, "next_proposals", lambda *a: read.append(1) or real(*a))
    with pytest.raises(NotConverged):       # ends behind round 3, which is noted
        match_doctor_optimal(e, 1, accelerate=False, max_iter=3, journal="lost-driver")
    assert len(read) == 3
    got = match_doctor_optimal(e, 1, accelerate=False, trace=True, journal="lost-driver")
    assert pairs(got) == pairs(want) and got.changes == want.changes and got.rounds == want.rounds
    assert len(read) == want.rounds         # none was run twice
    again = match_doctor_optimal(e, 1, accelerate=False, trace=True, journal="lost-driver")
    assert pairs(again) == pairs(want) and len(read) == want.rounds
    with pytest.raises(ValueError):
        match_doctor_optimal(e.where("doctor_id > 3"), 1, accelerate=False, journal="lost-driver")
    with pytest.raises(ValueError):
        match_doctor_optimal(e, 1, journal="lost-driver")


def test_a_draft_of_a_note_is_not_read(spark):
    tables = Tables(spark, "x", "notes-test")
    assert tables.last_note() is None
    tables.note(2, '{"a": 2}')
    tables.note(10, '{"a": 10}')
    tables.note(10, '{"a": 11}')
    fs, path = tables._file_system(f"{tables.folder}/note-000000011.tmp")
    fs.create(path, True).close()
    assert Tables(spark, "x", "notes-test").last_note() == '{"a": 11}'


def test_a_round_reads_the_cells_of_its_cursors_and_a_hot_doctor_is_in_several(spark):
    rows = [(0, h, h + 1, 1 + h % 50) for h in range(900)]
    rows += [(d, h, 1 + k, 60 + d) for d in range(1, 300) for k, h in enumerate((d, d + 1, d + 2))]
    e = spark.createDataFrame(rows, "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    tables = Tables(spark, "cells")
    path = frontier.write_lists(e.withColumn("_places", F.lit(1)), tables, 1)
    lists = spark.read.parquet(path)
    hot = lists.where("doctor_id = 0").groupBy("_cell").count().collect()
    assert len(hot) == 10 and max(r["count"] for r in hot) < 600
    front = spark.createDataFrame([(0, 5)], "doctor_id long, _at int")
    state = {"places": [5], "cells": [2], "rejected": 1}
    new = frontier.next_proposals(lists, front, state, 1)
    assert [(r[DOCTOR], r[HOSPITAL]) for r in new.collect()] == [(0, 4)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_cell" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters" in plan and "_at" in plan.split("PushedFilters")[1]
