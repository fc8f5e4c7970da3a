"""Classic rounds by a frontier: edges that are sure to be refused, and rounds in a task."""

import random

import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators import ranking
from duetto.plans import frontier
from duetto.plans.common import NotConverged
from duetto.plans.doctor_optimal import match_doctor_optimal
from test_frontier import classic_changes, market, pairs

SCHEMA = "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int"


def ragged(n_d, n_h, seed):
    """A market whose lists have one to all hospitals, the first ones most
    liked."""
    rng = random.Random(seed)
    lists = {d: rng.sample(range(n_h), rng.randint(1, n_h)) for d in range(n_d)}
    for chosen in lists.values():
        chosen.sort(key=lambda h: h + rng.random() * 4)
    by = {}
    for d, chosen in lists.items():
        for h in chosen:
            by.setdefault(h, []).append(d)
    rank = {(d, h): i + 1 for h, ds in by.items() for i, d in enumerate(rng.sample(ds, len(ds)))}
    return [(d, h, i + 1, rank[d, h]) for d, chosen in lists.items() for i, h in enumerate(chosen)]


def run(e, quota, **kw):
    return match_doctor_optimal(e, quota, accelerate=False, trace=True, **kw)


@pytest.mark.parametrize("partitions", [0, 4])
@pytest.mark.parametrize("ahead", [3, 32])
def test_rounds_and_changes_of_the_serial_loop(spark, monkeypatch, partitions, ahead):
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", partitions)
    monkeypatch.setattr(frontier, "AHEAD", ahead)
    rows = ragged(24, 9, 10 + ahead)
    got = run(spark.createDataFrame(rows, SCHEMA).cache(), 2)
    assert pairs(got) == bf.doctor_proposing(rows, 2)
    assert got.changes == classic_changes(rows, 2) and got.rounds == len(got.changes) > 4
    assert [r[DOCTOR_RANK] for r in got.matching.collect()]     # whole edges come back
    assert {tuple(r) for r in got.matching.collect()} <= set(rows)


@pytest.mark.parametrize("partitions", [0, 4])
def test_buckets_split_ranking_and_large_groups(spark, monkeypatch, partitions):
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", partitions)
    monkeypatch.setattr(frontier, "EDGES_PER_PARTITION", 60)
    monkeypatch.setattr(frontier, "LISTED_PLACES", 0)
    monkeypatch.setattr(ranking, "MAX_GROUP_ROWS", 3)
    rows = ragged(20, 8, 3)
    got = run(spark.createDataFrame(rows, SCHEMA).cache(), 1)
    assert pairs(got) == bf.doctor_proposing(rows, 1) and got.changes == classic_changes(rows, 1)


def test_a_table_of_places_that_ends_in_the_middle_of_a_block(spark, monkeypatch):
    """Two rounds on the tables, then a task up to the block's end, and so on."""
    tasks = []
    real = frontier._in_a_task
    monkeypatch.setattr(frontier, "_in_a_task",     # as where the rejected doctors are too many for a task
                        lambda *a: tasks.append(a[2:4]) or real(*a[:5], True))
    monkeypatch.setattr(frontier, "AHEAD", 6)
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", 1)
    rows = ragged(40, 8, 5)
    e = spark.createDataFrame(rows, SCHEMA).cache()
    want = classic_changes(rows, 2)
    monkeypatch.setattr(frontier, "EDGES_PER_PARTITION", 90)
    got = run(e, 2)
    assert pairs(got) == bf.doctor_proposing(rows, 2) and got.changes == want
    assert tasks and tasks[0][0] > 2 and (tasks[0][1] - 1) % 6 == 0


@pytest.mark.parametrize("partitions", [0, 4])
def test_quotas_by_hospital_and_a_limit_of_rounds(spark, monkeypatch, partitions):
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", partitions)
    e, rows = market(spark, 30, 10, 6, 5)
    places = {h: h % 4 for h in range(10)}
    quota = spark.createDataFrame(list(places.items()), "hospital_id long, quota int")
    got = run(e, quota)
    journaled = run(e, quota, journal=f"quotas-{partitions}")      # every proposal, round by round
    assert pairs(got) == pairs(journaled) and got.changes == journaled.changes and got.rounds == journaled.rounds
    with pytest.raises(NotConverged):
        run(e, quota, max_iter=2)


@pytest.mark.parametrize("partitions", [0, 4])
def test_a_doctor_and_a_hospital_without_an_id(spark, monkeypatch, partitions):
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", partitions)
    rows = [(None, 1, 1, 3), (None, 2, 2, 1), (1, None, 1, 2), (2, None, 1, 1), (1, 1, 2, 1), (3, 1, 1, 2),
            (3, 2, 2, 2), (2, 2, 2, 3)]
    e = spark.createDataFrame(rows, SCHEMA).cache()
    got, journaled = run(e, 1), run(e, 1, journal=f"nulls-{partitions}")
    assert sorted(map(tuple, got.matching.collect()), key=str) == sorted(map(tuple, journaled.matching.collect()), key=str)
    assert got.changes == journaled.changes == [2, 2, 1, 0][:len(got.changes)]


def test_few_edges_are_run_by_a_task(spark, monkeypatch):
    """The loop judged every round in jobs of its own."""
    judged = []
    real = frontier._judged
    monkeypatch.setattr(frontier, "_judged", lambda *a: judged.append(1) or real(*a))
    e, rows = market(spark, 30, 30, 6, 3)
    got = run(e, 1)
    assert got.changes == classic_changes(rows, 1) and got.rounds > 4
    assert len(judged) == 1


def test_places_ahead_leave_out_what_is_sure_to_be_refused(spark, monkeypatch):
    """Hospital 0 is full with its best doctor: nobody else's edge there is read again,
    though each is a proposal of its round."""
    monkeypatch.setattr(frontier, "TASK_PARTITIONS", 0)
    seen = []
    real = frontier.places_ahead
    monkeypatch.setattr(frontier, "places_ahead",
                        lambda *a: seen.append(real(*a)) or seen.append(seen[-1].count()) or seen[-2])
    rows = [(d, 0, 1, d + 1) for d in range(10)] + [(d, d, 2, 1) for d in range(1, 9)] + [(9, 8, 2, 2)]
    rows += [(d, 20, 3, d) for d in range(1, 10)]
    got = run(spark.createDataFrame(rows, SCHEMA).cache(), 1)
    assert got.changes == classic_changes(rows, 1) and pairs(got) == bf.doctor_proposing(rows, 1)
    assert seen[1] == 18
    e = spark.createDataFrame(rows[:10] + [(d, 0, 2, d + 20) for d in range(10)], SCHEMA)
    seen.clear()
    got = run(e, 1)
    assert seen[1] == 0 and got.changes == [1, 0, 0] and got.rounds == 3
