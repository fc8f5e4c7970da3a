"""Partition-local deferred acceptance against the serial loop and the global rounds."""

import os

import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from duetto import catalog
from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.plans import local
from duetto.plans.common import NotConverged
from duetto.plans.doctor_optimal import match_doctor_optimal
from duetto.plans.hospital_optimal import match_hospital_optimal
from duetto.sources.synth import generate_preferences

SF = "/root/testdata/sf0.001"


def market(spark, n_d, n_h, k, seed):
    e = generate_preferences(spark.range(n_d).select(F.col("id").alias(DOCTOR)), n_h, k, seed).cache()
    return e, [tuple(r) for r in e.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK).collect()]


def pairs(result):
    return {r[DOCTOR]: r[HOSPITAL] for r in result.matching.collect()}


@pytest.mark.parametrize("edges_each,n_d,n_h,k,quota,seed", [
    (60, 60, 8, 4, 6, 1), (40, 40, 40, 6, 1, 3), (10_000, 30, 12, 5, 6, 2)])
def test_equals_the_serial_loop_in_any_partitions(spark, monkeypatch, edges_each, n_d, n_h, k, quota, seed):
    monkeypatch.setattr(local, "LOCAL_EDGES", edges_each)
    monkeypatch.setattr(local, "MOST", 10)
    e, rows = market(spark, n_d, n_h, k, seed)
    one, two = match_doctor_optimal(e, quota, local=True), match_hospital_optimal(e, quota, local=True)
    assert pairs(one) == bf.doctor_proposing(rows, quota)
    assert pairs(two) == bf.hospital_proposing(rows, quota)
    assert one.converged and not one.changes
    if edges_each > len(rows):
        assert one.rounds == two.rounds == 1


def test_quota_tables_and_empty_markets(spark, monkeypatch):
    monkeypatch.setattr(local, "LOCAL_EDGES", 40)
    monkeypatch.setattr(local, "MOST", 10)
    e, _ = market(spark, 40, 6, 4, 11)
    quotas = spark.createDataFrame([(h, h % 4) for h in range(5)] + [(5, None)], "hospital_id long, quota int")
    for match in (match_doctor_optimal, match_hospital_optimal):
        assert pairs(match(e, quotas, local=True)) == pairs(match(e, quotas))
        assert match(e.limit(0), 3, local=True).matching.count() == 0
        assert match(e, 0, local=True).matching.count() == 0


def test_what_does_not_fit_a_task_runs_in_global_rounds(spark, monkeypatch):
    e, rows = market(spark, 40, 6, 4, 12)
    want = bf.doctor_proposing(rows, 3)
    monkeypatch.setattr(local, "LOCAL_EDGES", 1)        # every partition is too large
    monkeypatch.setattr(local, "MOST", 0)
    assert local.settle(e, 3, 3, DOCTOR, len(rows)) is None
    assert pairs(match_doctor_optimal(e, 3, local=True)) == want
    monkeypatch.undo()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        assert local.settle(e, 3, 3, DOCTOR, len(rows)) is None
        assert pairs(match_doctor_optimal(e, 3, local=True)) == want
    finally:
        spark.conf.set(key, before)


def test_round_limits(spark, monkeypatch):
    monkeypatch.setattr(local, "LOCAL_EDGES", 10)
    monkeypatch.setattr(local, "MOST", 50)
    e, _ = market(spark, 40, 40, 6, 3)
    rounds = match_doctor_optimal(e, 1, local=True).rounds
    assert rounds > 2
    with pytest.raises(NotConverged):
        match_doctor_optimal(e, 1, max_iter=rounds - 1, local=True)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")
def test_the_contested_market_takes_less_than_a_third_of_the_rounds(spark):
    e = catalog.market(spark, SF, "contested")
    for match in (match_doctor_optimal, match_hospital_optimal):
        slow, fast = match(e, catalog.QUOTA), match(e, catalog.QUOTA, local=True)
        assert pairs(slow) == pairs(fast)
        assert 3 * fast.rounds < slow.rounds
